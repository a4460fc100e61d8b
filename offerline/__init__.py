"""Offer mailing on Spark: typed campaign bases, cheapest offers, folded
message loads, board loads, daily opportunity ids and the mailing table."""

__version__ = "0.1.0"

"""DataFrame -> DataFrame operators of the campaign pipeline."""

from offerline.operators.contacts import (
    assign_channels,
    campaign_base,
    dis_rows,
    normalize_contacts,
    overwrite_contact,
    whatsapp_rows,
)
from offerline.operators.enrich import enrich_base, fill_from_group, left_enrich, stack_bases, suffix_overlap
from offerline.operators.ingest import authorised_contacts, clean_base, exclude_value, round_prices, split_invalid_ids
from offerline.operators.loads import board_loads, dedupe_rows, display_columns
from offerline.operators.messages import message_load, offer_bucket
from offerline.operators.offers import cheapest_offer, fold_offers, with_address
from offerline.operators.publish import add_missing_columns, attach_ids, conform, publish_mailing
from offerline.operators.quality import (
    encoding_loss,
    invalid_number_profile,
    key_multiplicity,
    nonnull_profile,
    null_columns,
    schema_mismatches,
)
from offerline.operators.registry import issue_ids, new_codes, number_in_order, registry_of_day

__all__ = [
    "add_missing_columns", "assign_channels", "attach_ids", "authorised_contacts", "board_loads",
    "campaign_base", "cheapest_offer", "clean_base", "conform", "dedupe_rows", "dis_rows",
    "display_columns", "encoding_loss", "enrich_base", "exclude_value", "fill_from_group",
    "fold_offers", "invalid_number_profile", "issue_ids", "key_multiplicity", "left_enrich",
    "message_load", "new_codes", "nonnull_profile", "normalize_contacts", "null_columns",
    "number_in_order", "offer_bucket", "overwrite_contact", "publish_mailing", "registry_of_day",
    "round_prices", "schema_mismatches", "split_invalid_ids", "stack_bases", "suffix_overlap",
    "whatsapp_rows", "with_address",
]

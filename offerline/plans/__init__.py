"""Composed jobs and the driver-table queries with their SQL oracles."""

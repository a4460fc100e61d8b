"""Cleaning and typing of the landed inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerline import schemas as S
from offerline.functions.numbers import (
    id_is_valid,
    lenient_number,
    round_half_even,
    strict_id,
    to_sale_date,
)


def authorised_contacts(df: DataFrame, column: str = S.AUTHORISED, value: str = "Sim") -> DataFrame:
    """Contacts the sales rep authorised (``column == value``; NULL drops)."""
    return df.filter(F.col(column) == value)


def exclude_value(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` differs from ``value``; NULL rows are kept."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def clean_base(
    df: DataFrame,
    id_columns=S.ID_COLUMNS,
    date_column: str = S.SALE_DATE,
    distance_column: str = S.DISTANCE,
    digits: int = 4,
) -> DataFrame:
    """Type the priced base: strict integer ids (a NULL or non-integral id
    fails the job), the sale date as DATE (serial day numbers converted),
    the distance as a lenient number rounded to ``digits``."""
    cols = {}
    for c in id_columns:
        if c in df.columns:
            cols[c] = strict_id(c, c, df.schema[c].dataType)
    if date_column in df.columns:
        cols[date_column] = to_sale_date(df, date_column)
    if distance_column in df.columns:
        cols[distance_column] = round_half_even(lenient_number(distance_column, df.schema[distance_column].dataType), digits)
    return df.withColumns(cols)


def split_invalid_ids(df: DataFrame, id_columns=S.ID_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(rows with valid ids, rejected rows with a ``reject_reason``) instead of
    failing the job; run ``clean_base`` on the first."""
    present = [c for c in id_columns if c in df.columns]
    checks = [(c, id_is_valid(c, df.schema[c].dataType)) for c in present]
    ok = F.lit(True)
    for _, check in checks:
        ok = ok & check
    reason = F.concat_ws(",", *[F.when(~check, F.lit(c)) for c, check in checks])
    return df.filter(ok), df.filter(~ok).withColumn("reject_reason", reason)


def round_prices(df: DataFrame, columns=(S.PRICE, S.LIMIT_PRICE), digits: int = 4) -> DataFrame:
    """Strict float prices rounded to ``digits`` like numpy."""
    return df.withColumns({c: round_half_even(F.col(c).cast("double"), digits) for c in columns})

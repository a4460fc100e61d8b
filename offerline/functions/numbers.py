"""Numeric, date and id expressions (all native Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spreadsheet serial-day origin and the lenient number grammar.
SERIAL_DAY_ORIGIN = "1899-12-30"
NUMBER_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c, digits: int = 4) -> Column:
    """Round like numpy/pandas ``round(digits)``: rint(x * 10^d) / 10^d.

    ``F.round`` rounds half up and ``F.bround`` rounds the decimal value, both
    differ from numpy on binary ties; this form agrees value for value.
    """
    scale = float(10 ** digits)
    return F.rint(_c(c) * F.lit(scale)) / F.lit(scale)


def nan_to_null(c) -> Column:
    c = _c(c)
    return F.when(~F.isnan(c), c)


def lenient_number(c, dtype: T.DataType | None = None) -> Column:
    """``pd.to_numeric(errors='coerce')``: bad text -> NULL, NaN -> NULL.

    Spark's ``try_cast`` also accepts suffixed literals such as ``1.5d``; the
    grammar check keeps exactly the plain decimal/scientific forms.
    """
    c = _c(c)
    if dtype is not None and not isinstance(dtype, T.StringType):
        return nan_to_null(c.cast("double"))
    as_text = c.cast("string")
    parsed = F.when(as_text.rlike(NUMBER_PATTERN), F.trim(as_text).try_cast("double"))
    return nan_to_null(parsed)


def is_invalid_number(c, dtype: T.DataType | None = None) -> Column:
    """Present but not a number (the values ``lenient_number`` turns into NULL)."""
    c = _c(c)
    if dtype is not None and not isinstance(dtype, T.StringType):
        return F.lit(False)
    return c.isNotNull() & ~c.cast("string").rlike(NUMBER_PATTERN)


def id_is_valid(c, dtype: T.DataType | None = None) -> Column:
    """Whether ``strict_id`` accepts the value (not NULL, integral text or a number)."""
    c = _c(c)
    if dtype is None or isinstance(dtype, T.StringType):
        return c.isNotNull() & c.rlike(INTEGER_PATTERN)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def strict_id(c, name: str | None = None, dtype: T.DataType | None = None) -> Column:
    """``astype(int)``: NULL or non-integral text raises, floats truncate.

    The error is raised by the executor that meets the value (``raise_error``),
    so a bad row fails the job instead of silently becoming NULL.
    """
    label = name or (c if isinstance(c, str) else "id")
    c = _c(c)
    if dtype is None or isinstance(dtype, T.StringType):
        value = F.trim(c).cast("bigint")
    else:
        value = c.cast("bigint")
    return F.when(
        id_is_valid(c, dtype), value
    ).otherwise(F.raise_error(F.concat(F.lit(f"invalid id in {label}: "), F.coalesce(c.cast("string"), F.lit("NULL")))).cast("bigint"))


def serial_day_to_date(c) -> Column:
    """Spreadsheet serial day (days since 1899-12-30) -> DATE (time dropped)."""
    return F.date_add(F.lit(SERIAL_DAY_ORIGIN).cast("date"), F.floor(_c(c)).cast("int"))


def serial_day_to_timestamp(c) -> Column:
    """Serial day with fraction -> TIMESTAMP_NTZ (45407.5 -> 2024-04-25 12:00)."""
    seconds = (_c(c).cast("double") * F.lit(86400.0)).cast("decimal(18,6)")
    origin = F.lit(SERIAL_DAY_ORIGIN + " 00:00:00").cast("timestamp_ntz")
    return origin + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def to_sale_date(df: DataFrame, name: str) -> Column:
    """Date column from a date, timestamp, serial number or text column.

    The branch is chosen on the column's type, as the spreadsheet reader
    leaves either real dates or serial day numbers.
    """
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    if isinstance(dtype, T.NumericType):
        return serial_day_to_date(c)
    number = lenient_number(c)
    return F.when(number.isNotNull(), serial_day_to_date(number)).otherwise(F.try_to_date(c, "yyyy-MM-dd"))


def number_text(c) -> Column:
    """Python's ``str(float)`` for prices with at most 4 decimals.

    ``cast(double as string)`` switches to scientific notation from 1e7; going
    through decimal(18,4) and trimming trailing zeros keeps '5.0', '5.1',
    '12345678.5' as Python prints them.
    """
    as_decimal = _c(c).cast("decimal(18,4)").cast("string")
    return F.regexp_replace(as_decimal, r"(\.\d+?)0+$", "$1")


def fixed_decimals(c, digits: int = 4) -> Column:
    """'{:.4f}' text of a float; NULL stays NULL."""
    c = _c(c)
    return F.when(c.isNotNull(), F.format_string(f"%.{digits}f", c))


def opportunity_id(run_date: Column, number: Column) -> Column:
    """yyMMdd of the run date + the day's running number, zero padded to 6."""
    return F.concat(F.date_format(run_date, "yyMMdd"), F.format_string("%06d", number))


def id_sequence(c) -> Column:
    """Running number part of an opportunity id (text after the yyMMdd prefix)."""
    return _c(c).substr(F.lit(7), F.length(_c(c))).cast("bigint")

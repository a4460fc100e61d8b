"""Contact normalisation, channel assignment and the 64-column base."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerline import schemas as S
from offerline.functions.channel import DIS, WHATSAPP, assign_channel, channel_from_mobile
from offerline.functions.phones import (
    CONTACT_SEPARATOR,
    LANDLINE_PATTERN,
    MOBILE_PATTERN,
    contact_text,
    first_match,
    number_of,
)
from offerline.operators.ingest import round_prices


def normalize_contacts(df: DataFrame, always=(S.HOT_PHONE, S.WHATSAPP_PHONE), optional=S.CONTACT_COLUMNS,
                       strict: bool = False, sep: str = CONTACT_SEPARATOR,
                       mobile: str = S.MOBILE, landline: str = S.LANDLINE,
                       mobile_pattern: str = MOBILE_PATTERN, landline_pattern: str = LANDLINE_PATTERN) -> DataFrame:
    """Join every phone field into one text and extract one mobile and one
    landline number from it (first match each, digits only, prefixed 55).
    ``strict`` adds digit boundaries and does not double a matched 55; the
    patterns are arguments (e.g. the stricter STRICT_MOBILE_BODY)."""
    text = contact_text([c for c in always if c in df.columns], [c for c in optional if c in df.columns], sep)
    found = {f"__{mobile}": mobile_pattern, f"__{landline}": landline_pattern}
    # One projection a step: each text and match is computed once, its later uses read it.
    out = df.withColumn(S.CONTACT_TEXT, text)
    out = out.withColumns({m: first_match(S.CONTACT_TEXT, p, strict) for m, p in found.items()})
    return out.withColumns({m[2:]: number_of(m, p, strict) for m, p in found.items()}).drop(*found)


def campaign_base(df: DataFrame, weekday_headers=S.WEEKDAY_COLUMNS) -> DataFrame:
    """Project to the 64 campaign columns, and to Flag and Score where ``df``
    has them, with prices rounded to 4 digits."""
    extra = [c for c in S.OPTIONAL_COLUMNS if c in df.columns]
    return round_prices(df.select(*S.base_columns(weekday_headers), *extra))


def assign_channels(df: DataFrame, channel: str = S.CHANNEL, mobile: str = S.MOBILE,
                    policy: str = "whatsapp_needs_mobile") -> DataFrame:
    """Channel policy: ``whatsapp_needs_mobile`` (WhatsApp rows without a
    mobile become DIS, other rows keep theirs) or ``mobile_is_whatsapp``
    (every row with a mobile becomes WhatsApp)."""
    if policy == "mobile_is_whatsapp":
        return df.withColumn(channel, channel_from_mobile(channel, mobile))
    if policy != "whatsapp_needs_mobile":
        raise ValueError(f"unknown channel policy {policy!r}")
    return df.withColumn(channel, assign_channel(channel, mobile))


def channel_rows(df: DataFrame, value: str, channel: str = S.CHANNEL) -> DataFrame:
    return df.filter(F.col(channel) == value)


def dis_rows(df: DataFrame) -> DataFrame:
    return channel_rows(df, DIS)


def whatsapp_rows(df: DataFrame) -> DataFrame:
    return channel_rows(df, WHATSAPP)


def overwrite_contact(df: DataFrame, source: str, target: str = "10") -> DataFrame:
    """Put ``source`` into ``target`` where ``source`` holds a value."""
    return df.withColumn(target, F.coalesce(F.col(source), F.col(target)))

"""Contact text and Brazilian phone extraction (native regex, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The mobile and landline patterns of the load format, the
# earlier stricter mobile pattern, and the contact separators.
MOBILE_PATTERN = r"(?:\+?55 ?)?(?:\(?([1-9]{2})\)? ?)?(?:9\d{4}|\d{2}\d{5}|\d{5})[- ]?\d{4}"
LANDLINE_PATTERN = r"(?:\+?55)? ?(?:\(?([1-9]{2})\)? ?)?(?:[2-5])(?:\d{3,4}[- ]?\d{4})"
STRICT_MOBILE_BODY = r"(?:\+?55)? ?(?:\(?([1-9]{2})\)? ?)?(?:9[6-9])\d{3}[- ]?\d{4}"
CONTACT_SEPARATOR = " || "
LEGACY_CONTACT_SEPARATOR = "__"
COUNTRY_CODE = "55"
# Runs of the characters the fixed patterns are made of; no number is shorter.
PHONE_RUN = r"[+()\- 0-9]{8,}"
RUN_PATTERNS = (MOBILE_PATTERN, LANDLINE_PATTERN, STRICT_MOBILE_BODY)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contact_text(always, optional, sep: str = CONTACT_SEPARATOR) -> Column:
    """Join contact fields: ``always`` fields turn NULL into '' and are kept
    even when empty, ``optional`` fields are skipped when NULL."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in always]
    parts += [_c(c).cast("string") for c in optional]
    return F.concat_ws(sep, *parts)


def digits_only(c) -> Column:
    return F.regexp_replace(_c(c), r"\D", "")


def phone_runs(c) -> Column:
    """The runs of blanks, digits and ``+()-`` that are long enough for a
    number, one a line. The fixed patterns match such characters only, and
    other characters end a match and are no digits, so the first match in
    these lines is the first one in the text: a long text is scanned once,
    and the patterns read what is left of it."""
    return F.array_join(F.regexp_extract_all(_c(c), F.lit(PHONE_RUN), F.lit(0)), "\n")


def country_group(pattern: str) -> str:
    """The pattern with its leading optional country code made capture group 1."""
    if not pattern.startswith("(?:"):
        raise ValueError("pattern must start with the optional country-code group")
    return "(" + pattern[3:]


def searched(pattern: str, strict: bool) -> str:
    """The expression that is searched for; ``strict`` matches must not touch
    other digits and have their country code as group 1."""
    return r"(?<!\d)" + country_group(pattern) + r"(?!\d)" if strict else pattern


def first_match(text, pattern: str, strict: bool = False) -> Column:
    """The first match in ``text``, '' without one."""
    return F.regexp_extract(_c(text), searched(pattern, strict), 0)


def number_of(match, pattern: str, strict: bool = False) -> Column:
    """Digits of a match, prefixed by 55; NULL for ''. Strict: a country code
    that was matched is not doubled (the match alone matches again in the
    same way)."""
    match = _c(match)
    number = F.concat(F.lit(COUNTRY_CODE), digits_only(match))
    if strict:
        number = F.when(F.regexp_extract(match, searched(pattern, True), 1) != "", digits_only(match)).otherwise(number)
    return F.when(match != "", number)


def find_phone(c, pattern: str = MOBILE_PATTERN, strict: bool = False) -> Column:
    """The number of the first match of ``pattern`` in a text of any length.

    Loose semantics are the load format's: the match may sit inside a longer
    digit run and a matched +55 gets a second 55. The text is scanned once,
    the match bound once, however often the expression uses it.
    """
    text = phone_runs(c) if pattern in RUN_PATTERNS else _c(c)
    match = F.transform(F.array(text), lambda t: first_match(t, pattern, strict))
    return F.get(F.transform(match, lambda m: number_of(m, pattern, strict)), F.lit(0))


def find_phone_strict(c, pattern: str = MOBILE_PATTERN) -> Column:
    return find_phone(c, pattern, True)


def find_mobile(c, strict: bool = False, pattern: str = MOBILE_PATTERN) -> Column:
    return find_phone(c, pattern, strict)


def find_landline(c, strict: bool = False, pattern: str = LANDLINE_PATTERN) -> Column:
    return find_phone(c, pattern, strict)

"""Column-expression builders (native Spark functions only)."""

from offerline.functions.channel import assign_channel, channel_from_mobile
from offerline.functions.numbers import (
    fixed_decimals,
    id_is_valid,
    is_invalid_number,
    lenient_number,
    number_text,
    opportunity_id,
    round_half_even,
    serial_day_to_date,
    serial_day_to_timestamp,
    strict_id,
    to_sale_date,
)
from offerline.functions.phones import contact_text, digits_only, find_landline, find_mobile
from offerline.functions.text import (
    address_text,
    code_list,
    display_value,
    escape_newlines,
    message_field,
    offer_text,
)

__all__ = [
    "address_text", "assign_channel", "channel_from_mobile", "code_list", "contact_text",
    "digits_only", "display_value", "escape_newlines", "find_landline", "find_mobile",
    "fixed_decimals", "id_is_valid", "is_invalid_number", "lenient_number", "message_field",
    "number_text", "offer_text", "opportunity_id", "round_half_even", "serial_day_to_date",
    "serial_day_to_timestamp", "strict_id", "to_sale_date",
]

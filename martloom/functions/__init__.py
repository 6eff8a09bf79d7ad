"""Column functions: text, casts, dates, hash keys, bands, exact rounding."""

from martloom.functions.bands import band_at_least, band_at_most, band_below, yes_no
from martloom.functions.casts import cast_losses, parse_date, parse_timestamp, typed_select
from martloom.functions.dates import DATE_PARTS, date_parts, month_label, week_label
from martloom.functions.hashing import hash_key
from martloom.functions.numbers import (
    exact_sum,
    exact_percent,
    money,
    money_mean,
    money_sum,
    percent,
    ratio,
    rounded_money_mean,
)
from martloom.functions.text import (
    blank_to_null,
    digits_only,
    id_after,
    norm_text,
    party_kind,
    tax_id_or_name,
    trailing_id,
)

__all__ = [
    "DATE_PARTS",
    "band_at_least",
    "band_at_most",
    "band_below",
    "blank_to_null",
    "cast_losses",
    "exact_sum",
    "date_parts",
    "digits_only",
    "exact_percent",
    "hash_key",
    "id_after",
    "money",
    "money_mean",
    "money_sum",
    "month_label",
    "norm_text",
    "parse_date",
    "parse_timestamp",
    "party_kind",
    "percent",
    "ratio",
    "rounded_money_mean",
    "tax_id_or_name",
    "trailing_id",
    "typed_select",
    "week_label",
    "yes_no",
]

"""Column builders; import what you need from the submodules or from here."""

from .arrays import array_lookup, size_or
from .dates import month_start, safe_date, year_month
from .numbers import (
    gate,
    midpoint,
    ordered_bounds,
    pct,
    prefer_pair,
    round_half_away,
    round_half_even,
    safe_double,
)
from .replies import json_list, lenient_salary, reply_fields, strict_json
from .text import (
    alias_map,
    canonical_level,
    canonical_mode,
    clean_url,
    entry_key,
    html_text,
    label_map,
    prompt,
    surrogate_key,
    term_key,
)

__all__ = [
    "alias_map",
    "array_lookup",
    "canonical_level",
    "canonical_mode",
    "clean_url",
    "entry_key",
    "gate",
    "html_text",
    "json_list",
    "label_map",
    "lenient_salary",
    "reply_fields",
    "midpoint",
    "month_start",
    "ordered_bounds",
    "pct",
    "prefer_pair",
    "prompt",
    "round_half_away",
    "round_half_even",
    "safe_date",
    "safe_double",
    "size_or",
    "strict_json",
    "surrogate_key",
    "term_key",
    "year_month",
]

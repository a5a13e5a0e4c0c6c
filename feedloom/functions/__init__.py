"""Column expressions.  All run inside the JVM; none uses a Python UDF."""

from feedloom.functions.dates import combine_dt, day_range, parse_dt, to_utc_ms
from feedloom.functions.flags import (
    is_document,
    map_channel,
    map_value,
    payment_type,
    to_bool,
)
from feedloom.functions.numbers import (
    comma_to_dot,
    number_text,
    to_float,
    to_int,
    to_number_or_null,
)
from feedloom.functions.text import (
    after_sep,
    classify,
    clean_document,
    clean_text,
    contains_norm,
    default_text,
    digits,
    first_filled,
    full_name,
    json_text,
    label_year,
    letters_only,
    name_parts,
    normalize_text,
    null_tokens,
    squash,
    strip,
    strip_prefix,
    truncate,
    unaccent,
)

__all__ = [
    "after_sep", "classify", "clean_document", "clean_text", "combine_dt", "comma_to_dot",
    "contains_norm", "day_range", "default_text", "digits", "first_filled", "full_name",
    "is_document", "json_text", "label_year", "letters_only", "map_channel", "map_value",
    "name_parts", "normalize_text", "null_tokens", "number_text", "parse_dt", "payment_type",
    "squash", "strip", "strip_prefix", "to_bool", "to_float", "to_int", "to_number_or_null",
    "to_utc_ms", "truncate", "unaccent",
]

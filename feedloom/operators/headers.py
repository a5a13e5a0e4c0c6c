"""Header rules.  Names are worked out on the driver; the plan gets one projection."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from unicodedata import combining, normalize

# Header corrections of the shop export, applied in this order after
# the general rule.  The first one needs the whole name; the others any part of it.
EXACT_FIXES = {"ORDER": "ORDER_ID"}
PART_FIXES = (
    ("ID_SKU", "SKU_ID"),
    ("QUANTITY_SKU", "SKU_QUANTITY"),
    ("COURRIER", "COURIER"),
    ("IS_MARKETPLACE_CETIFIED", "IS_MARKETPLACE_CERTIFIED"),
    ("CLIENT_NAME", "CLIENT_FIRST_NAME"),
    ("ADDRESS_IDENTIFICATION", "ADDRESS_ID"),
    ("GIFTREGISTRY_ID", "GIFT_REGISTRY_ID"),
    ("MARKETINGTAGS", "MARKETING_TAGS"),
    ("STATUS_RAW_VALUE_TEMPORARY", "STATUS_RAW_VALUE_TEMP"),
)

# Prefixes of the shop's user records and their short forms.
USER_PREFIXES = (
    ("updates_dates_", "updates_"),
    ("addresses_", "address_"),
    ("active_addresses_", "active_address_"),
    ("person_phones_", "phone_"),
)

MERGE_SUFFIX = r"(_m\d+|_x|_y)$"
WORD_EDGE = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
CAPITALISED_WORD = re.compile(r"(.)([A-Z][a-z]+)")


class HeaderCollision(ValueError):
    """Two columns would end up under one name."""


def csv_header(name: str, spaced: str = "()/") -> str:
    """Export header to upper snake case; ``spaced`` characters count as spaces."""
    words = re.sub(rf"[\s\-{re.escape(spaced)}]+", "_", name.strip())
    words = WORD_EDGE.sub("_", words)
    return re.sub(r"\W", "", words, flags=re.ASCII).upper()


def fixed_header(name: str) -> str:
    fixed = EXACT_FIXES.get(name, name)
    for wrong, right in PART_FIXES:
        fixed = fixed.replace(wrong, right)
    return fixed


def json_header(
    name: str, prefixes: Sequence[tuple[str, str]] = (), suffix: str | None = MERGE_SUFFIX
) -> str:
    """Flattened record name to upper snake case."""
    flat = name.strip()
    if suffix:
        flat = re.sub(suffix, "", flat)
    flat = CAPITALISED_WORD.sub(r"\1_\2", flat.replace(".", "_"))
    flat = re.sub("__+", "_", WORD_EDGE.sub("_", flat).lower()).strip("_")
    for long, short in prefixes:
        flat = re.sub(f"^{re.escape(long)}", short, flat)
    return flat.upper()


def plain_lower(name: str) -> str:
    return "".join(c for c in normalize("NFD", name.strip().lower()) if not combining(c))


STYLES: dict[str, Callable[[str], str]] = {
    "csv": lambda name: fixed_header(csv_header(name)),
    "csv_plain": lambda name: csv_header(name, spaced=""),
    "json": json_header,
    "json_user": lambda name: json_header(name, USER_PREFIXES, suffix=None),
    "lower": plain_lower,
    "upper": lambda name: name.strip().upper(),
}


def canonical_headers(df: DataFrame, style: str = "csv") -> DataFrame:
    names = [STYLES[style](name) for name in df.columns]
    repeated = [name for name, count in Counter(names).items() if count > 1]
    if repeated:
        raise HeaderCollision(f"columns collide after renaming: {', '.join(repeated)}")
    return df.toDF(*names)


def rename_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; other entries of the mapping are ignored."""
    present = {old: new for old, new in mapping.items() if old in df.columns}
    return df.withColumnsRenamed(present)

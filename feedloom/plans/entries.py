"""Second ticketing feed: reduce, type, load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions import null_tokens
from feedloom.operators.dedupe import dedupe_first
from feedloom.operators.headers import canonical_headers, rename_map
from feedloom.operators.shape import apply_spec, quoted
from feedloom.sinks import replace_where
from feedloom.specs import entry
from feedloom.specs.tickets import PAID_CODE


def entry_tickets(df: DataFrame, order: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Typed tickets, the first of each access id, or of each (presentation, code) without one."""
    def shown(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit("None"))

    key = F.coalesce(
        F.col("idacesso").cast("string"), F.concat(shown("idapresentacao"), F.lit("|"), shown("codigo"))
    )
    first = dedupe_first(df, key, order).drop(*drop)
    # An empty text is missing in every column, declared or not.
    texts = [f.name for f in first.schema.fields if isinstance(f.dataType, T.StringType)]
    filled = first.withColumns({name: null_tokens(quoted(name), [""]) for name in texts})
    named = rename_map(canonical_headers(filled, "upper"), entry.RENAMED)
    return apply_spec(named, entry.ENTRIES)


def load_entries(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The fact after a batch: codes in it are deleted and only its paid rows put back."""
    return replace_where(target, batch, "CODIGO", F.col("STATUS") == PAID_CODE)

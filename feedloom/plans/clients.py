"""Client cleaning and its upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions import default_text, digits, full_name, letters_only, truncate
from feedloom.operators.dedupe import dedupe_last
from feedloom.operators.filters import drop_blank_keys, drop_erased
from feedloom.operators.headers import canonical_headers, rename_map
from feedloom.operators.shape import with_lineage
from feedloom.sinks import merge_upsert, verify_unique
from feedloom.specs import tickets as spec

DOCUMENT_LENGTH = 11


def clean_clients(df: DataFrame, order: Sequence[str], day: str | None = None) -> DataFrame:
    """One row per document.  ``order`` says which of several records is the last.

    Records are reduced twice: by the document as sent, before people erased for
    privacy are removed (so an erased person does not come back from an older record),
    and by the cleaned document afterwards.
    """
    named = rename_map(canonical_headers(df, "lower"), spec.CLIENT_RENAMES)
    latest = dedupe_last(named, ["cpf"], order)
    places = {
        name: letters_only(F.upper(default_text(name, spec.NOT_GIVEN, blank=False)))
        for name in ["endereco", "estado", "cidade", "bairro"]
    }
    cleaned = latest.select(
        F.upper(default_text("email", "", blank=False)).alias("email"),
        truncate(digits("cpf"), DOCUMENT_LENGTH).alias("cpf"),
        letters_only(full_name("first_name", "last_name")).alias("nome"),
        F.lit(spec.NOT_GIVEN).alias("telefone"),
        F.replace(default_text("cep", spec.NOT_GIVEN, blank=False), F.lit("-"), F.lit("")).alias("cep"),
        *[column.alias(name) for name, column in places.items()],
        F.struct(*order).alias("_order"),
    )
    kept = drop_erased(drop_blank_keys(cleaned, "cpf", sentinels=()))
    one_each = dedupe_last(kept, ["cpf"], ["_order"])
    return with_lineage(one_each, spec.CLIENT_SOURCE, day).select(*spec.CLIENT_COLUMNS)


def load_clients(target: DataFrame, clients: DataFrame) -> DataFrame:
    """The client table after an upsert; telephone and insertion date are never updated."""
    return merge_upsert(target, verify_unique(clients, "cpf"), "cpf", spec.CLIENT_COMPARED)

"""Event catalogue: the venue's events, classified, each with the base match of its slot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import classify, combine_dt, normalize_text, parse_dt, unaccent
from feedloom.functions.dates import DAY_FORMAT
from feedloom.operators.dedupe import dedupe_first
from feedloom.operators.filters import exclude_patterns, filter_contains
from feedloom.operators.groups import base_row
from feedloom.operators.headers import canonical_headers
from feedloom.specs import tickets as spec


def catalogue_rows(df: DataFrame, order: Sequence[str] | None = None, venue: str = spec.VENUE) -> DataFrame:
    """Valid events with their class and base match.  With ``order``, repeated events
    are reduced to the first."""
    events = filter_contains(canonical_headers(df, "lower"), "stadium", venue)
    events = events.withColumns({
        "event_id": F.col("event_id").cast("string"),
        "event_date_iso": F.date_format(parse_dt("event_date", DAY_FORMAT), "yyyy-MM-dd"),
        "match_norm": normalize_text("match"),
        "championship_norm": normalize_text("championship"),
    }).withColumn("tipo_evento", classify("match_norm", spec.EVENT_CLASSES, spec.GAME, normal=True))
    events = exclude_patterns(
        events,
        {"championship_norm": spec.EXCLUDED_CHAMPIONSHIPS, "match_norm": spec.EXCLUDED_MATCHES},
        {"championship_norm": spec.EXCLUDED_CHAMPIONSHIP},
    )
    if order:
        events = dedupe_first(events, ["event_id"], order)
    ranked = events.withColumn("_id", F.col("event_id").cast("bigint"))
    return base_row(
        ranked, ["event_date", "event_time"], F.col("tipo_evento") == spec.GAME, "_id",
        {"event_id": "event_id_jogo_base", "match": "partida_base"},
    ).drop("_id")


def _title(name: str) -> Column:
    # The feed writes a missing title as this word.
    return F.upper(unaccent(F.coalesce(name, F.lit("None"))))


def clean_events(df: DataFrame, order: Sequence[str] | None = None, venue: str = spec.VENUE) -> DataFrame:
    events = catalogue_rows(df, order, venue)
    return events.select(
        F.col("event_id").alias("COD_EVENTO"),
        F.col("event_date_iso").alias("DT_EVENTO"),
        F.col("event_time").alias("HR_EVENTO"),
        _title("match").alias("PARTIDA"),
        _title("stadium").alias("ESTADIO"),
        _title("championship").alias("CAMPEONATO"),
        F.col("tipo_evento").alias("TIPO_EVENTO"),
        F.coalesce("event_id_jogo_base", F.lit("None")).alias("COD_EVENTO_BASE"),
        _title("partida_base").alias("PARTIDA_BASE"),
        combine_dt("sales_start_date", "sales_start_time").alias("DATA_INICIO_VENDAS"),
        combine_dt("public_sale_start_date", "public_sale_start_time").alias("DATA_INICIO_VENDAS_PUBLICO"),
        parse_dt("sales_end").alias("DATA_FINAL_VENDAS_PUBLICO"),
    )

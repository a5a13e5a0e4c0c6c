"""The load steps of the pipelines: build a batch, put it into its table.

Every load can be repeated: a second run with the same input leaves the table as it is, and
so does a run that finishes one which was stopped (``feedloom.sinks.versions``).  A batch is
computed once, and of the table only the files that hold its keys or days are written again.
Tables are read with ``read_table``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import parse_dt
from feedloom.functions.dates import SHARD_FORMAT
from feedloom.operators.filters import keep_ids
from feedloom.operators.joins import hot_keys
from feedloom.plans.ecommerce import read_exports
from feedloom.plans.facts import build_fact, build_integration, extend_dim, extend_dim_entries
from feedloom.plans.web_events import event_base
from feedloom.sinks import full_refresh, swap_partitions, verify_unique
from feedloom.sinks.versions import ByDay, is_small, load_by_key, load_days, load_new, load_upsert, vacuum
from feedloom.sinks.versions import stage as stage_rows
from feedloom.specs import tickets as spec

Events = Sequence[str] | DataFrame | None
# Fixed value: the catalogue's columns that the dimension and the feed show.
CATALOGUE_USED = ["COD_EVENTO", "PARTIDA", "CAMPEONATO", "DT_EVENTO", "HR_EVENTO"]


def load_fact(
    path: str, stage: DataFrame, people: DataFrame, contracts: DataFrame, events: Events = None,
    keys: DataFrame | None = None, gathered: bool = False,
) -> DataFrame:
    """The tickets of the batch's matches give way to the ones staged now.

    ``keys`` has the tickets' documents, if they have been staged already (``stage_documents``); ``gathered`` says that the
    tickets are read from files whose rows are gathered by match.
    """
    keys = stage_documents(path, stage) if keys is None else keys
    open_ones = people.where(F.col("load_end_date").isNull()).select("cpf", "sk_pessoa", "load_end_date")
    people, contracts = _known(open_ones, keys, path), _known(contracts.select("cpf", "sk_contrato"), keys, path)
    if is_small(people) and is_small(contracts):
        fact = build_fact(stage, F.broadcast(people), F.broadcast(contracts), events, ())
        return load_by_key(fact, path, "sk_partida", gathered=gathered and events is None)
    return load_by_key(build_fact(stage, people, contracts, events, hot_keys(stage, "cpf")), path, "sk_partida")


def stage_documents(path: str, stage: DataFrame) -> DataFrame:
    """The documents of the tickets, computed once for the loads that look them up."""
    return stage_rows(stage.select("cpf").distinct(), path)


def _known(dim: DataFrame, keys: DataFrame, path: str) -> DataFrame:
    """The dimension's rows of the tickets' documents, computed once.

    What is left of a dimension is as a rule small enough to be broadcast, so the wide tickets stay where they are.
    """
    return stage_rows(dim.join(keys, "cpf", "left_semi"), path)


def load_integration(
    path: str, stage: DataFrame, catalogue: DataFrame, people: DataFrame, clients: DataFrame, events: Events = None,
    keys: DataFrame | None = None, gathered: bool = False,
) -> DataFrame:
    """The marketing feed's rows of the batch's matches give way to the ones staged now.

    For ``keys`` and ``gathered`` see ``load_fact``; with the latter the catalogue is read from staged rows as well.
    """
    keys = stage_documents(path, stage) if keys is None else keys
    mailed = F.col("load_end_date").isNull() & F.col("email").isNotNull()
    people = _known(people.where(mailed).select("cpf", "nome", "email", "load_end_date"), keys, path)
    clients = _known(clients.where(F.col("email").isNotNull()).select("cpf", "nome", "email"), keys, path)
    if not (is_small(people) and is_small(clients)):
        return load_by_key(build_integration(stage, catalogue, people, clients, events, hot_keys(stage, "cpf")), path, "event")
    gathered = gathered and events is None and is_small(catalogue)
    catalogue = F.broadcast(catalogue) if gathered else catalogue
    feed = build_integration(stage, catalogue, F.broadcast(people), F.broadcast(clients), events, ())
    return load_by_key(feed, path, "event", gathered=gathered)


def load_dim(path: str, catalogue: DataFrame) -> DataFrame:
    """The match dimension, longer by the catalogue's matches that it lacks."""
    empty = catalogue.select(F.col("COD_EVENTO").alias("sk_partida")).where(F.lit(False))  # the catalogue is not computed for it
    return load_new(extend_dim(catalogue, empty), path, "sk_partida")


def load_dim_entries(path: str, fact: DataFrame) -> DataFrame:
    """The second feed's match dimension, longer by its new matches."""
    columns = ["idapresentacao", "campeonato", "partida", "dthr_apresentacao"]
    return load_new(extend_dim_entries(fact, fact.select(*columns).where(F.lit(False))), path, "idapresentacao")


def load_client_table(path: str, clients: DataFrame) -> DataFrame:
    """The client table after an upsert; telephone and insertion date are never updated."""
    return load_upsert(verify_unique(clients, "cpf"), path, "cpf", spec.CLIENT_COMPARED)


def stage_window(path: str, batch: DataFrame, moment: str) -> DataFrame:
    """A shop feed's rows, computed and gathered by day once, for loads that take them with ``gathered``."""
    return stage_rows(batch, path, ByDay(moment))


def load_window(path: str, batch: DataFrame, moment: str, start: str, end: str, gathered: bool = False) -> DataFrame:
    """A shop feed: the rows of the window give way to the ones extracted for it."""
    return load_days(batch, path, moment, start, end, drop_null=True, gathered=gathered)


def load_ecommerce(spark: SparkSession, path: str, exports: Sequence[str], typed) -> DataFrame:
    """Export files read, stacked, typed and renamed (``ecommerce_orders``, ``ecommerce_customers``); the table is refreshed."""
    return full_refresh(typed(read_exports(spark, exports)), path)


def load_web_day(path: str, events: DataFrame, day: str | None = None) -> DataFrame:
    """The flat web events; each day that is loaded replaces itself."""
    rows = event_base(events if day is None else events.where(F.col("event_date") == day))
    swap_partitions(rows.withColumn("day", F.to_date(parse_dt(F.col("EVENT_DATE"), SHARD_FORMAT))), path, "day")
    return events.sparkSession.read.parquet(path).drop("day")


def load_all(
    folder: str, stage: DataFrame, catalogue: DataFrame, people: DataFrame, contracts: DataFrame, clients: DataFrame, events: Events = None
) -> dict[str, DataFrame]:
    """The chain of one run: staged tickets, match dimension, fact, marketing feed.

    ``events`` reprocesses the chosen matches and leaves all others alone.  The catalogue, the chosen matches, their tickets
    and the tickets' documents are computed once and read by every load; ``vacuum`` removes them.
    """
    catalogue = stage_rows(catalogue.select(*CATALOGUE_USED), f"{folder}/dim_partida")
    if isinstance(events, DataFrame):
        events = stage_rows(events, f"{folder}/stage")
    chosen = stage if events is None else keep_ids(stage, "cod_evento", events)
    staged = load_by_key(chosen, f"{folder}/stage", "cod_evento")
    dim = load_dim(f"{folder}/dim_partida", catalogue)
    tickets = staged if events is None else stage_rows(keep_ids(staged, "cod_evento", events), f"{folder}/stage")
    keys = stage_documents(f"{folder}/stage", tickets)
    fact = load_fact(f"{folder}/fact", tickets, people, contracts, keys=keys, gathered=events is None)
    feed = load_integration(f"{folder}/integration", tickets, catalogue, people, clients, keys=keys, gathered=events is None)
    for name in ("stage", "dim_partida", "fact", "integration"):
        vacuum(staged.sparkSession, f"{folder}/{name}")
    return {"stage": staged, "dim_partida": dim, "fact": fact, "integration": feed}


def events_of_dates(catalogue: DataFrame, dates: Sequence[str]) -> DataFrame:
    """The matches of chosen days, for reprocessing."""
    return catalogue.where(F.col("DT_EVENTO").isin(*dates)).select(F.col("COD_EVENTO").alias("cod_evento")).distinct()

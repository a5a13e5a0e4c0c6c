"""Ticket fact, marketing feed and match dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import label_year, null_tokens
from feedloom.operators.dedupe import distinct_rows
from feedloom.operators.filters import exclude_ilike, keep_ids
from feedloom.operators.joins import enrich_priority, left_joins_salted, new_rows
from feedloom.specs import tickets as spec

# Fixed value: what a ticket without a buyer's document carries, courtesy sales among them.
NO_DOCUMENT = ["-1"]

# The fact's columns in the feed's order, and what staged columns are called there.
FACT_COLUMNS = [
    "sk_partida", "sk_pessoa", "ingresso", "cpf", "valor", "data_pagamento", "forma_pagamento", "usado",
    "setor", "portao_acesso", "fileira", "assento", "desconto", "taxa_conveniencia", "sk_contrato",
    "data_acesso", "nome_portador", "documento_portador", "flag_cpf_portador",
]
FACT_RENAMES = {"cod_evento": "sk_partida", "used_time": "data_acesso", "ticket_name": "nome_portador"}


def build_fact(
    stage: DataFrame, people: DataFrame, contracts: DataFrame, events: Sequence[str] | DataFrame | None = None,
    hot: Sequence[str] | Column = NO_DOCUMENT,
) -> DataFrame:
    """Staged tickets with the current person and the latest contract of their document.

    ``contracts`` has one row per document (see ``latest_per_key``); ``events`` limits
    the build to the events of a batch; ``hot`` documents are spread over tasks, those of tickets without
    one or those that ``hot_keys`` finds.
    """
    if events is not None:
        stage = keep_ids(stage, "cod_evento", events)
    current = people.where(F.col("load_end_date").isNull()).select("cpf", "sk_pessoa")
    joined = left_joins_salted(stage, [current, contracts.select("cpf", "sk_contrato")], "cpf", hot)
    return joined.withColumnsRenamed(FACT_RENAMES).select(*FACT_COLUMNS)


def build_integration(
    stage: DataFrame,
    catalogue: DataFrame,
    people: DataFrame,
    clients: DataFrame,
    events: Sequence[str] | DataFrame | None = None,
    hot: Sequence[str] | Column = NO_DOCUMENT,
) -> DataFrame:
    """Tickets for the marketing consumer, with the best name and e-mail known."""
    if events is not None:
        stage = keep_ids(stage, "cod_evento", events)
    current = people.where(F.col("load_end_date").isNull() & F.col("email").isNotNull())
    known = clients.where(F.col("email").isNotNull())
    joined = enrich_priority(
        stage.withColumnRenamed("nome", "ticket_nome"),
        catalogue.select(F.col("COD_EVENTO").alias("cod_evento"), "PARTIDA", "DT_EVENTO"),
        "cod_evento",
        [
            (current.select("cpf", F.col("nome").alias("person_nome"), F.col("email").alias("person_email")), "cpf"),
            (known.select("cpf", F.col("nome").alias("client_nome"), F.col("email").alias("client_email")), "cpf"),
        ],
        {"nome": ["person_nome", "client_nome", "ticket_nome"], "email": ["person_email", "client_email"]},
        hot,
    )
    return joined.select(
        F.col("PARTIDA").alias("partida"),
        F.col("DT_EVENTO").alias("data_realizacao"),
        "ingresso",
        F.col("portao_acesso").alias("tipo_acesso"),
        "valor", "cpf", "nome", "email", "setor",
        F.lit(spec.NOT_GIVEN).alias("descricao"),
        F.lit(spec.TICKET_SELLER).alias("ticketeira"),
        F.col("usado").alias("used"),
        F.col("fileira").alias("row"),
        F.col("assento").alias("seat"),
        F.col("cod_evento").alias("event"),
        "order_id", "sale_from", "subsector", "ticket_id", "used_time", "member_fc_id", "client_id",
        F.lit(spec.PAID_STATUS).alias("order_status"),
        F.col("data_pagamento").alias("payment_date"),
        F.col("forma_pagamento").alias("payment_method"),
        null_tokens(F.col("member_unique_id").cast("string"), spec.EMPTY_MEMBER).alias("member_unique_id"),
        "ipe_comprou_ano_vigente", "desconto", "taxa_conveniencia", "ticket_name", "documento_portador",
        "flag_cpf_portador",
    )


def extend_dim(catalogue: DataFrame, dim: DataFrame) -> DataFrame:
    """Catalogue matches the match dimension lacks, in its columns."""
    games = exclude_ilike(catalogue, "PARTIDA", spec.NOT_A_GAME)
    fresh = new_rows(games, dim, "COD_EVENTO", "sk_partida")
    return fresh.select(
        F.col("COD_EVENTO").alias("sk_partida"),
        F.col("PARTIDA").alias("partida"),
        label_year("CAMPEONATO", F.col("DT_EVENTO").try_cast("date")).alias("campeonato"),
        F.concat("DT_EVENTO", F.lit(" "), "HR_EVENTO").alias("dthr_partida"),
    )


def extend_dim_entries(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Second feed: its matches that the dimension lacks.

    A null key in the dimension does not block the load here; ``joins.not_in`` has the
    behaviour of the SQL predicate, which then loads nothing.
    """
    columns = ["idapresentacao", "campeonato", "partida", "dthr_apresentacao"]
    games = exclude_ilike(distinct_rows(fact, columns), "campeonato", spec.NOT_AN_ENTRY_GAME)
    return new_rows(games.where(F.col("idapresentacao").isNotNull()), dim, "idapresentacao").select(*columns)

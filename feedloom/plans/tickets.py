"""Ticket cleaning and its near-real-time load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom.functions import (
    clean_document,
    comma_to_dot,
    default_text,
    is_document,
    letters_only,
    null_tokens,
    parse_dt,
    squash,
    strip,
    to_bool,
    to_number_or_null,
    truncate,
    unaccent,
)
from feedloom.functions.flags import TICKET_WORDS
from feedloom.operators.groups import quality_counters
from feedloom.operators.headers import canonical_headers
from feedloom.operators.shape import conform, overwrite_where
from feedloom.specs import tickets as spec
from feedloom.streaming import Days, stream_refresh

NUMBERS = ["client_id", "member_fc_id", "member_unique_id"]
PLACES = ["portao_acesso", "fileira", "assento"]


def _read(df: DataFrame) -> DataFrame:
    """The declared columns as text, renamed, with courtesy sales marked."""
    declared = conform(canonical_headers(df, "lower"), dict.fromkeys(spec.COLUMNS, "string"))
    marked = overwrite_where(
        declared, F.col("sale_from") == spec.COURTESY_SALE,
        {"document": spec.NO_DOCUMENT, "name": spec.COURTESY_NAME},
    )
    return marked.withColumnsRenamed(spec.COLUMNS)


def _shown(c: Column) -> Column:
    """Upper-case text; a missing value shows as the empty text."""
    return F.coalesce(F.upper(null_tokens(c, ["nan", "None"])), F.lit(""))


def _is_paid() -> Column:
    return F.coalesce(F.upper("status_ingresso") == spec.PAID_STATUS, F.lit(False))


def _is_courtesy() -> Column:
    paid_by = F.upper(strip("forma_pagamento"))
    return F.coalesce(paid_by.isin(spec.COURTESY_PAYMENTS), F.lit(False))


def clean_tickets(df: DataFrame, box_office: bool = False) -> DataFrame:
    """Paid tickets, cleaned.

    ``box_office`` names buyers without a document at the box office.  The feed's own
    rule for that comes after such documents have been given a default, so it never
    applies; hence it is off unless asked for.
    """
    document = strip(null_tokens("document", spec.NULL_TEXTS))
    holder = F.when(_is_courtesy(), F.lit(spec.NO_DOCUMENT)).otherwise(
        strip(null_tokens("ticket_document", spec.NULL_TEXTS))
    )
    name = strip(F.when(strip("name") != "", F.upper("name")).otherwise(F.col("ticket_name")))
    if box_office:
        unnamed = (F.col("sale_from") == spec.BOX_OFFICE_SALE) & (F.coalesce(document, F.lit("")) == "")
        name = F.when(unnamed, F.lit(spec.BOX_OFFICE_NAME)).otherwise(name)
    discount = truncate(letters_only(F.upper(strip(F.coalesce("desconto", F.lit(""))))), spec.DISCOUNT_LENGTH)
    # The blank test comes before spaces are collapsed: a sector of spaces ends up empty.
    sector = letters_only(_shown(unaccent("setor")))
    holder_name = F.replace("ticket_name", F.lit(spec.HOLDER_PREFIX), F.lit(""))

    values = {
        "cod_evento": _shown(F.coalesce("event_id_original", "cod_evento")),
        "cpf": clean_document(document, default=spec.NO_DOCUMENT),
        "nome": truncate(_shown(letters_only(name)), spec.NAME_LENGTH),
        "status_ingresso": F.lit(spec.PAID_CODE),
        "valor": _shown(comma_to_dot("valor")),
        "data_pagamento": parse_dt("data_pagamento"),
        "usado": to_bool("usado", TICKET_WORDS, default=False),
        "setor": squash(default_text(sector, spec.NOT_GIVEN)),
        "used_time": F.date_format(parse_dt("used_time"), "yyyy-MM-dd HH:mm:ss"),
        "desconto": default_text(discount, spec.NO_DISCOUNT),
        "taxa_conveniencia": _shown(comma_to_dot("taxa_conveniencia")),
        "ticket_name": _shown(strip(holder_name)),
        "documento_portador": _shown(holder),
        "flag_cpf_portador": is_document(holder),
        **{name: _shown(unaccent(name)) for name in PLACES},
        **{name: to_number_or_null(_shown(F.col(name))) for name in NUMBERS},
    }
    paid = _read(df).where(_is_paid())
    return paid.select([
        values.get(name, _shown(F.col(name))).alias(name) for name in spec.CLEANED
    ])


def ticket_counters(df: DataFrame) -> DataFrame:
    """One row of counters for the run log."""
    return quality_counters(_read(df), {"status": ~_is_paid()}, {"courtesy": _is_courtesy()})


def refresh_tickets(
    source: DataFrame, path: str, checkpoint: str, cycle: str | None = None
) -> StreamingQuery:
    """Clean landed tickets and replace them, by ticket, in the days they were paid."""
    by = Days(
        day=F.to_date(parse_dt("payment_date")), loaded_day=F.to_date("data_pagamento"),
        key="ticket_id", loaded_key="ticket_id",
    )
    return stream_refresh(source, path, checkpoint, by, clean_tickets, cycle)

"""Flags and value mappings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions._column import ColumnLike, as_column
from feedloom.functions.text import strip, strip_text

# The words each feed takes for true and false (lower case).
SHOP_WORDS = {
    "true": True, "false": False,
    "1": True, "0": False,
    "sim": True, "não": False, "nao": False,
    "s": True, "n": False,
    "verdadeiro": True, "falso": False,
    "t": True, "f": False,
    "ok": True,
}
ENTRY_WORDS = {"s": True, "n": False, "true": True, "false": False, "1": True, "0": False}
TICKET_WORDS = {"true": True}

# Media (upper case, no brackets) and the channel each belongs to.
PAID_MARK = "CPC"
CHANNELS = {
    "MIDIA PAGA": ["PAID"],
    "NI": [
        "BOTAO", "BOTÃO", "SPFC", "DATA NOT AVAILABLE", "CUPOM", "PRE_HOME", "ST", "2024_NOVIDADES",
        "CBAAFE", "EVENT-DISCOVERY-PLATFORM", "MORUMBIBRANCO",
    ],
    "SEM REFERENCIA": ["NONE", "REFERRAL"],
    "ORGÂNICO": ["ORGANIC"],
    "EMAIL": [
        "EMAIL", "ATIVOS", "SOCIOSATIVOS", "BASE_LEADS", "LEADSSP", "SOCIOS", "LEADS",
        "SOCIOSINATIVOS", "LEADSOFFSP",
    ],
    "SPFCTICKET": [
        "BANNER", "SPFCTICKET_HELPCENTER", "BOTAO_PLANOBRANCO", "BOTAO_RODAPE", "SPFCTICKET",
    ],
    "APLICATIVO": ["APP_BANNER"],
    "WHATSAPP": ["WHATSAPP_STNASOITAVAS"],
    "REDE SOCIAL": ["SOCIAL"],
    "ACESSO DIRETO": ["DIRECT"],
    "NOT SET": ["NOT SET"],
}

# Payment labels.
PIX, CREDIT_CARD, UNKNOWN_PAYMENT = "PIX", "CARTÃO DE CRÉDITO", "unknown"


def _literal_map(values: Mapping[str, object]) -> Column:
    return F.create_map(*[F.lit(part) for pair in values.items() for part in pair])


def map_value(c: ColumnLike, mapping: Mapping[str, object], default: object = None) -> Column:
    """Exact lookup; values outside the mapping give ``default``."""
    return F.coalesce(F.try_element_at(_literal_map(mapping), as_column(c)), F.lit(default))


def to_bool(c: ColumnLike, words: Mapping[str, bool] = SHOP_WORDS, default: bool | None = None) -> Column:
    """Word to boolean, in any case and with spaces around; unknown words give ``default``."""
    return map_value(F.lower(strip_text(c)), words, default)


def map_channel(c: ColumnLike) -> Column:
    """Traffic medium to channel; a medium outside the table stays as it is."""
    raw = as_column(c)
    medium = F.upper(strip(F.regexp_replace(raw, "[()]", "")))
    listed = {name: channel for channel, names in CHANNELS.items() for name in names}
    return F.when(F.contains(medium, F.lit(PAID_MARK)), F.lit("MIDIA PAGA")).otherwise(
        F.coalesce(F.try_element_at(_literal_map(listed), medium), raw)
    )


def payment_type(declared: ColumnLike, is_pix: ColumnLike, is_card: ColumnLike) -> Column:
    return F.coalesce(
        as_column(declared),
        F.when(as_column(is_pix) == "true", F.lit(PIX)),
        F.when(as_column(is_card) == "true", F.lit(CREDIT_CARD)),
        F.lit(UNKNOWN_PAYMENT),
    )


def is_document(c: ColumnLike, length: int = 11) -> Column:
    return F.coalesce(as_column(c).rlike(f"^[0-9]{{{length}}}\\z"), F.lit(False))

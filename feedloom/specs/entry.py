"""Columns of the second ticketing feed, under their names in the table."""

from __future__ import annotations

from feedloom.operators.shape import ENTRY_KINDS, Field, TableSpec

# Names in the feed that differ from the table's.
RENAMED = {
    "TITULO": "CAMPEONATO",
    "DSCAPRESENTACAO": "PARTIDA",
    "DSCINTERNA": "TIPO_INGRESSO",
    "DSCTIPOPRODUTO": "TIPO_PRODUTO",
}

# The columns of each kind.
COLUMNS = {
    "text": [
        "IDEVENTO", "CAMPEONATO", "IDAPRESENTACAO", "PARTIDA", "NOME", "CPF", "EMAIL", "CELULAR", "TELEFONE",
        "DSCPESSOA_TIPO", "CODIGO", "TIPO_INGRESSO", "TIPO_PRODUTO", "LOCALIZADOR_ITEM", "STATUS", "DSCFORMAPAG",
        "LOCALIZADOR", "DSCEQUIPAMENTO", "PORTADOR_NOME", "PORTADOR_DOCUMENTO", "TIPO_INGRESSO_BASE",
        "SETOR_INGRESSO", "FLAG_ACOMPANHANTE", "SEXO", "END_ESTADO", "ESTADO_CIVIL", "IDACESSO", "REGIAO", "ESTADIO",
    ],
    "float": [
        "VALOR", "VALOR_JUROS", "VALOR_TAXA", "VALOR_DESCONTO", "VALOR_CANCELADO", "VALOR_PAGO", "VALOR_TOTAL",
    ],
    "int": ["CARTAO", "LOCALIZADOR_BLOCO", "LOCALIZADOR_FILA", "LOCALIZADOR_LUGAR", "USER_BEPASS"],
    "bool": ["ACESSO_ENTROU"],
}

ENTRIES = TableSpec(
    tuple(Field(name, kind, name) for kind, names in COLUMNS.items() for name in names), ENTRY_KINDS
)

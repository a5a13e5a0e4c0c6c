"""Columns and words of the first ticketing feed."""

from __future__ import annotations

# Columns read from the feed and what they are called afterwards.
COLUMNS = {
    "event": "cod_evento",
    "name": "name",
    "document": "document",
    "amount": "valor",
    "payment_method": "forma_pagamento",
    "payment_date": "data_pagamento",
    "order_status": "status_ingresso",
    "used": "usado",
    "ticket_hash": "ingresso",
    "gate": "portao_acesso",
    "sector": "setor",
    "row": "fileira",
    "seat": "assento",
    "order_id": "order_id",
    "sale_from": "sale_from",
    "subsector": "subsector",
    "ticket_id": "ticket_id",
    "used_time": "used_time",
    "member_fc_id": "member_fc_id",
    "client_id": "client_id",
    "member_unique_id": "member_unique_id",
    "ticket_name": "ticket_name",
    "ticket_document": "ticket_document",
    "ipe_comprou_ano_vigente": "ipe_comprou_ano_vigente",
    "discount": "desconto",
    "convenience_fee": "taxa_conveniencia",
    "event_id_original": "event_id_original",
    "event_id_jogo_base": "event_id_jogo_base",
    "tipo_evento": "tipo_evento",
    "event_date": "event_date",
    "event_date_iso": "event_date_iso",
    "event_time": "event_time",
    "match": "match",
    "partida_base": "partida_base",
    "championship": "championship",
    "stadium": "stadium",
}

# Columns of the cleaned ticket, in order.
CLEANED = [
    "cod_evento", "cpf", "nome", "ingresso", "status_ingresso", "valor", "data_pagamento", "forma_pagamento",
    "usado", "setor", "portao_acesso", "fileira", "assento", "order_id", "sale_from", "subsector", "ticket_id",
    "used_time", "member_fc_id", "client_id", "member_unique_id", "ipe_comprou_ano_vigente", "desconto",
    "taxa_conveniencia", "ticket_name", "documento_portador", "flag_cpf_portador", "tipo_evento",
    "event_id_jogo_base", "partida_base",
]
# The staging table has all of them but the three that describe the base match.
STAGED = CLEANED[:-3]

# Words of the feed.
PAID_STATUS, PAID_CODE, OTHER_CODE = "PAGO", "PA", "CA"
COURTESY_SALE = "VENDA PROIBIDA FLAMENGO"
COURTESY_NAME = "CORTESIA"
COURTESY_PAYMENTS = ["PEDIDO DE CORTESIA", "CARGA"]
BOX_OFFICE_SALE, BOX_OFFICE_NAME = "PDV FLAMENGO", "PDV"
NO_DOCUMENT = "-1"
NO_DISCOUNT = "NÃO INFORMADO"
NOT_GIVEN = "NAO_INFORMADO"
HOLDER_PREFIX = "Documento: "
NULL_TEXTS = ["None", "nan", "NaN", ""]
NAME_LENGTH, DISCOUNT_LENGTH = 100, 200

# Match titles and championships.
VENUE = "MARACANA"
GAME = "JOGO"
EVENT_CLASSES = [
    ("ESTACIONAMENTO", ["ESTACIONAMENTO"]),
    ("FLA_PLUS", ["ESPACO", "FLA+", "FLA PLUS"]),
]
EXCLUDED_CHAMPIONSHIP = "NBB"
EXCLUDED_CHAMPIONSHIPS = "TESTE|PACOTE|FUTEBOLCARD|TREINO|BCLA|COPA FLA MARACA|FLA FEST"
EXCLUDED_MATCHES = "TESTE|PACOTE"
NOT_A_GAME = ["%ESPACO%", "%FLA+%", "%ESTACIONAMENTO%"]
NOT_AN_ENTRY_GAME = ["%tour da%", "%estacionamento%"]

# Client records.
CLIENT_RENAMES = {
    "document": "cpf",
    "city": "cidade",
    "address": "endereco",
    "state": "estado",
    "district": "bairro",
}
CLIENT_COLUMNS = [
    "email", "cpf", "endereco", "nome", "telefone", "cidade", "bairro", "estado", "cep", "data_insercao", "fonte",
]
CLIENT_SOURCE = "FUTEBOLCARD"
CLIENT_COMPARED = ["nome", "email", "estado", "cidade", "bairro", "endereco", "cep", "fonte"]

# The marketing feed.
TICKET_SELLER = "FCARD"
EMPTY_MEMBER = ["", "null"]

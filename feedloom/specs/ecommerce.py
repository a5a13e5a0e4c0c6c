"""Columns of the two e-commerce exports: header in the file, kind, name in the table."""

from __future__ import annotations

from feedloom.operators.shape import SHOP_KINDS, Field, TableSpec

# Fixed values.
ORDER_FIELDS = (
    Field("Origin", "text", "ORIGEM_PEDIDO"),
    Field("Order", "text", "ID_PEDIDO"),
    Field("Sequence", "int", "SEQUENCIA_ITEM"),
    Field("Creation Date", "date", "DT_CRIACAO_PEDIDO"),
    Field("Client Name", "text", "NOME"),
    Field("Client Last Name", "text", "SOBRENOME"),
    Field("Client Document", "text", "CPF"),
    Field("Email", "text", "EMAIL"),
    Field("Phone", "text", "TELEFONE"),
    Field("UF", "text", "UF"),
    Field("City", "text", "CIDADE"),
    Field("Address Identification", "text", "ID_ENDERECO"),
    Field("Address Type", "text", "TIPO_ENDERECO"),
    Field("Receiver Name", "text", "NOME_DESTINATARIO"),
    Field("Street", "text", "LOGRADOURO"),
    Field("Number", "text", "NUMERO_ENDERECO"),
    Field("Complement", "text", "COMPLEMENTO_ENDERECO"),
    Field("Neighborhood", "text", "BAIRRO"),
    Field("Reference", "text", "REFERENCIA_ENDERECO"),
    Field("Postal Code", "text", "CEP"),
    Field("SLA Type", "text", "TIPO_SLA_ENTREGA"),
    Field("Courrier", "text", "TRANSPORTADORA"),
    Field("Estimate Delivery Date", "date", "DT_PREVISTA_ENTREGA"),
    Field("Delivery Deadline", "text", "DT_LIMITE_ENTREGA"),
    Field("Status", "text", "STATUS_PEDIDO"),
    Field("Last Change Date", "date", "DT_ULTIMA_ATUALIZACAO"),
    Field("UtmMedium", "text", "UTM_MEDIUM"),
    Field("UtmSource", "text", "UTM_SOURCE"),
    Field("UtmCampaign", "text", "UTM_CAMPAIGN"),
    Field("Coupon", "text", "CUPOM_DESCONTO"),
    Field("Payment System Name", "text", "SISTEMA_PAGAMENTO"),
    Field("Installments", "int", "QTD_PARCELAS"),
    Field("Payment Value", "float", "VL_PAGAMENTO"),
    Field("Quantity_SKU", "int", "QTD_SKU"),
    Field("ID_SKU", "text", "ID_SKU"),
    Field("Category Ids Sku", "text", "IDS_CATEGORIA_SKU"),
    Field("Reference Code", "text", "CODIGO_REFERENCIA"),
    Field("SKU Name", "text", "NOME_SKU"),
    Field("SKU Value", "float", "VL_SKU"),
    Field("SKU Selling Price", "float", "VL_VENDA_SKU"),
    Field("SKU Total Price", "float", "VL_TOTAL_SKU"),
    Field("SKU Path", "text", "CAMINHO_CATEGORIA_SKU"),
    Field("Item Attachments", "text", "ANEXOS_ITEM"),
    Field("List Id", "text", "ID_LISTA"),
    Field("List Type Name", "text", "TIPO_LISTA"),
    Field("Service (Price/ Selling Price)", "float", "VL_SERVICO"),
    Field("Shipping List Price", "float", "VL_LISTA_FRETE"),
    Field("Shipping Value", "float", "VL_FRETE"),
    Field("Total Value", "float", "VL_TOTAL_PEDIDO"),
    Field("Discounts Totals", "float", "VL_TOTAL_DESCONTOS"),
    Field("Discounts Names", "text", "NOMES_DESCONTOS"),
    Field("Call Center Email", "text", "EMAIL_CALL_CENTER"),
    Field("Call Center Code", "text", "CODIGO_CALL_CENTER"),
    Field("Tracking Number", "text", "CODIGO_RASTREIO"),
    Field("Host", "text", "HOST_ORIGEM"),
    Field("GiftRegistry ID", "text", "ID_LISTA_PRESENTE"),
    Field("Seller Name", "text", "NOME_VENDEDOR"),
    Field("Status TimeLine", "text", "HISTORICO_STATUS"),
    Field("Obs", "text", "OBSERVACAO"),
    Field("UtmiPart", "text", "UTMI_PART"),
    Field("UtmiCampaign", "text", "UTMI_CAMPAIGN"),
    Field("UtmiPage", "text", "UTMI_PAGE"),
    Field("Seller Order Id", "text", "ID_PEDIDO_VENDEDOR"),
    Field("Acquirer", "text", "ADQUIRENTE"),
    Field("Authorization Id", "text", "ID_AUTORIZACAO"),
    Field("TID", "text", "ID_TRANSACAO_TID"),
    Field("NSU", "text", "NSU_TRANSACAO"),
    Field("Card First Digits", "text", "CARTAO_PRIMEIROS_DIGITOS"),
    Field("Card Last Digits", "text", "CARTAO_ULTIMOS_DIGITOS"),
    Field("Payment Approved By", "text", "APROVADO_POR"),
    Field("Cancelled By", "text", "CANCELADO_POR"),
    Field("Cancellation Reason", "text", "MOTIVO_CANCELAMENTO"),
    Field("Gift Card Name", "text", "NOME_GIFT_CARD"),
    Field("Gift Card Caption", "text", "DESCRICAO_GIFT_CARD"),
    Field("Authorized Date", "date", "DT_AUTORIZACAO_PAGAMENTO"),
    Field("Corporate Name", "text", "RAZAO_SOCIAL"),
    Field("Corporate Document", "text", "DOCUMENTO_EMPRESA"),
    Field("TransactionId", "text", "ID_TRANSACAO"),
    Field("PaymentId", "text", "ID_PAGAMENTO"),
    Field("PaymentOrigin", "text", "ORIGEM_PAGAMENTO"),
    Field("SalesChannel", "text", "CANAL_VENDA"),
    Field("marketingTags", "text", "TAGS_MARKETING"),
    Field("Delivered", "bool", "FLAG_ENTREGUE"),
    Field("SKU RewardValue", "float", "VL_RECOMPENSA_SKU"),
    Field("Is Marketplace cetified", "bool", "FLAG_MARKETPLACE_CERTIFICADO"),
    Field("Is Checked In", "bool", "FLAG_CHECKIN"),
    Field("Currency Code", "text", "CODIGO_MOEDA"),
    Field("Taxes", "float", "VL_IMPOSTOS"),
    Field("Invoice Numbers", "text", "NUMEROS_NOTA_FISCAL"),
    Field("Country", "text", "PAIS"),
    Field("Input Invoices Numbers", "text", "NF_ENTRADA"),
    Field("Output Invoices Numbers", "text", "NF_SAIDA"),
    Field("Status raw value (temporary)", "text", "STATUS_BRUTO"),
    Field("Cancellation Data", "date", "DT_CANCELAMENTO"),
)

CUSTOMER_FIELDS = (
    Field("email", "text", "EMAIL"),
    Field("firstName", "text", "NOME"),
    Field("lastName", "text", "SOBRENOME"),
    Field("phone", "text", "TELEFONE"),
    Field("homePhone", "text", "TELEFONE_RESIDENCIAL"),
    Field("businessPhone", "text", "TELEFONE_COMERCIAL"),
    Field("document", "text", "CPF"),
    Field("documentType", "text", "TIPO_DOCUMENTO"),
    Field("corporateDocument", "text", "CNPJ"),
    Field("stateRegistration", "text", "INSCRICAO_ESTADUAL"),
    Field("isCorporate", "bool", "FLAG_EMPRESA"),
    Field("corporateName", "text", "RAZAO_SOCIAL"),
    Field("tradeName", "text", "NOME_FANTASIA"),
    Field("userId", "text", "ID_USUARIO"),
    Field("id", "text", "ID"),
    Field("accountId", "text", "ID_CONTA"),
    Field("accountName", "text", "NOME_CONTA"),
    Field("dataEntityId", "text", "ID_ENTIDADE_DADOS"),
    Field("isNewsletterOptIn", "bool", "FLAG_NEWSLETTER"),
    Field("approved", "bool", "APROVADO"),
    Field("customerClass", "text", "CLASSE_CLIENTE"),
    Field("priceTables", "text", "TABELAS_PRECO"),
    Field("tradePolicy", "text", "POLITICA_COMERCIAL"),
    Field("restrictions", "text", "RESTRICOES"),
    Field("birthDate", "date", "DATA_NASCIMENTO"),
    Field("birthDateMonth", "int", "MES_NASCIMENTO"),
    Field("gender", "text", "SEXO"),
    Field("profilePicture", "text", "FOTO_PERFIL"),
    Field("localeDefault", "text", "LOCALE_PADRAO"),
    Field("attach", "text", "ANEXO"),
    Field("rclastcart", "raw", "ID_ULTIMO_CARRINHO"),
    Field("rclastcartvalue", "float", "VALOR_ULTIMO_CARRINHO"),
    Field("rclastsession", "raw", "ID_ULTIMA_SESSAO"),
    Field("rclastsessiondate", "date", "DATA_ULTIMA_SESSAO"),
    Field("brandPurchasedTag", "text", "TAG_MARCA_COMPRADA"),
    Field("brandVisitedTag", "text", "TAG_MARCA_VISITADA"),
    Field("categoryPurchasedTag", "text", "TAG_CATEGORIA_COMPRADA"),
    Field("categoryVisitedTag", "text", "TAG_CATEGORIA_VISITADA"),
    Field("departmentVisitedTag", "text", "TAG_DEPARTAMENTO_VISITADO"),
    Field("productPurchasedTag", "text", "TAG_PRODUTO_COMPRADO"),
    Field("productVisitedTag", "text", "TAG_PRODUTO_VISITADO"),
    Field("visitedProductWithStockOutSkusTag", "text", "TAG_PRODUTO_VISITADO_SEM_ESTOQUE"),
    Field("carttag", "text", "TAG_CARRINHO"),
    Field("checkouttag", "text", "TAG_CHECKOUT"),
    Field("tags", "text", "TAGS"),
    Field("auto_filter", "text", "FILTRO_AUTOMATICO"),
    Field("createdBy", "text", "CRIADO_POR"),
    Field("createdIn", "date", "DATA_CRIACAO"),
    Field("updatedBy", "text", "ATUALIZADO_POR"),
    Field("updatedIn", "date", "DATA_ATUALIZACAO"),
    Field("lastInteractionBy", "text", "ULTIMA_INTERACAO_POR"),
    Field("lastInteractionIn", "date", "DATA_ULTIMA_INTERACAO"),
    Field("followers", "int", "SEGUIDORES"),
)

ORDERS = TableSpec(ORDER_FIELDS, SHOP_KINDS)
CUSTOMERS = TableSpec(CUSTOMER_FIELDS, SHOP_KINDS)

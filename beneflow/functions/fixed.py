"""Fixed values of the data contract.

Every literal below is part of the input or output contract (header names,
code lists, markers) and has to stay exactly as it is for results to be right.
"""

# Separators tried on a delivery's header line, in this order, and the fallback.
SEPARATORS = (";", ",", "\t", "|")
DEFAULT_SEPARATOR = ";"

# Encoding and date pattern of a delivery.
DELIVERY_ENCODING = "ISO-8859-1"
DATE_PATTERN = "dd/MM/yyyy"

# Landing header -> bronze column, in bronze order. The delivery repeats the
# header "Espécie"; Spark's CSV reader tells the two apart by column position.
LANDING_TO_BRONZE = {
    "Despacho": "despacho",
    "Sexo.": "sexo",
    "Clientela": "clientela",
    "Tipo Benefício": "tipo_beneficio",
    "UF": "uf",
    "Meio pagamento": "meio_pagamento",
    "Banco": "banco",
    "Mun Pagto": "mun_pagto",
    "Mun Resid": "mun_resid",
    "Vl Líquido": "vl_liquido",
    "Ramo Atividade": "ramo_atividade",
    "Dt início validade": "dt_inicio_validade",
    "Espécie12": "especie_codigo",
    "Espécie13": "especie_descricao",
}

# Texts that mean "no information", after trimming, in the categorical columns.
NULL_MARKERS = ("{ñ class}", "Nao Informado", "")
CATEGORICAL_COLUMNS = ("sexo", "clientela", "ramo_atividade", "despacho")

# State name -> two-letter code.
STATE_CODES = {
    "Acre": "AC",
    "Alagoas": "AL",
    "Amapá": "AP",
    "Amazonas": "AM",
    "Bahia": "BA",
    "Ceará": "CE",
    "Distrito Federal": "DF",
    "Espírito Santo": "ES",
    "Goiás": "GO",
    "Maranhão": "MA",
    "Mato Grosso": "MT",
    "Mato Grosso do Sul": "MS",
    "Minas Gerais": "MG",
    "Pará": "PA",
    "Paraíba": "PB",
    "Paraná": "PR",
    "Pernambuco": "PE",
    "Piauí": "PI",
    "Rio de Janeiro": "RJ",
    "Rio Grande do Norte": "RN",
    "Rio Grande do Sul": "RS",
    "Rondônia": "RO",
    "Roraima": "RR",
    "Santa Catarina": "SC",
    "São Paulo": "SP",
    "Sergipe": "SE",
    "Tocantins": "TO",
}

# Payment-means prefix -> (code, description).
PAYMENT_MEANS = {
    "Ccf": ("CCF", "Conta-Corrente Fisica"),
    "Ccl": ("CCL", "Conta-Corrente Loterica"),
    "Cmg": ("CMG", "Cartao Magnetico"),
}

# Business group -> species codes; any other code, or none, is OTHER_GROUP.
SPECIES_GROUPS = {
    "Pensao": (1, 2, 3, 21, 22, 23, 26, 27, 28, 29, 54, 55, 56, 59),
    "Aposentadoria": (
        4, 5, 6, 7, 8, 30, 32, 33, 34, 37, 38, 40, 41, 42, 43, 44, 45, 46, 47, 48, 49,
        51, 57, 58, 72, 79,
    ),
    "Auxilio": (10, 13, 16, 18, 25, 31, 36, 60),
    "Amparo_BPC": (11, 12, 87, 88),
}
OTHER_GROUP = "Outros"

# Accuracy of the approximate percentiles.
PERCENTILE_ACCURACY = 100

# Columns of the reports over gold tables, in their order.
TOP_STATES_REPORT = (
    "_ano_mes", "rank_vl_total", "sg_uf", "grupo_especie_top", "qtd_beneficios", "vl_total",
    "vl_medio", "pct_feminino", "pct_nacional_valor",
)
SPECIES_VOLUME_REPORT = (
    "_ano_mes", "especie_codigo", "especie_descricao", "grupo_especie", "qtd_beneficios",
    "vl_total", "vl_medio", "uf_com_mais_beneficios",
)
BANK_SHARES_REPORT = (
    "_ano_mes", "rank_qtd", "banco_codigo", "banco_nome", "qtd_beneficios", "market_share_pct",
    "market_share_valor_pct",
)
# Columns a bronze preview shows.
BRONZE_PREVIEW = (
    "despacho", "sexo", "uf", "tipo_beneficio", "vl_liquido", "dt_inicio_validade", "especie_codigo",
    "especie_descricao", "_ano_mes", "_ingestion_ts",
)

"""DuckDB texts giving the same rows as the registered queries, from the same tables."""

from __future__ import annotations

from beneflow.functions import fixed
from beneflow.plans import queries as Q
from beneflow.sources import people as P
from beneflow.sources.benefits import FEED_STATES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_text(v) if isinstance(v, str) else str(v) for v in values)


_STATES = "(VALUES " + ", ".join(f"({k}, {_text(n)}, {_text(c)})" for k, n, c in FEED_STATES) + ")"

RAW = f"""raw AS MATERIALIZED (
SELECT
 CASE o_orderstatus WHEN 'F' THEN 'Normal  ' WHEN 'O' THEN ' {{ñ class}}' ELSE ' Especial' END AS despacho,
 CASE l_returnflag WHEN 'A' THEN 'Feminino ' WHEN 'R' THEN 'Masculino' ELSE '{{ñ class}}' END AS sexo,
 CASE WHEN l_linenumber = 7 THEN 'Nao Informado' WHEN l_linestatus = 'F' THEN 'Urbano  ' ELSE 'Rural' END AS clientela,
 p_type AS tipo_beneficio,
 ur.nome AS uf,
 CASE substr(o_orderpriority,1,1) WHEN '1' THEN 'Ccf - Conta' WHEN '2' THEN 'Cmg - Cartao' WHEN '3' THEN 'Ccl  -  Loterica' WHEN '4' THEN 'Xyz - Outro' ELSE 'Cmg' END AS meio_pagamento,
 CASE WHEN s_suppkey % 21 = 20 THEN 'SemCodigo' ELSE concat(CAST(100 + s_suppkey % 21 AS VARCHAR), '-Banco-', CAST(s_suppkey % 21 AS VARCHAR), ' ') END AS banco,
 CASE WHEN s_suppkey % 50 = 49 THEN 'Ignorado' ELSE CAST(20000 + s_suppkey % 50 AS VARCHAR) || '-' || up.sg || '-Mun-' || CAST(s_suppkey % 50 AS VARCHAR) END AS mun_pagto,
 CAST(20000 + c_custkey % 50 AS VARCHAR) || '-' || ur.sg || '-Mun-' || CAST(c_custkey % 50 AS VARCHAR) AS mun_resid,
 CASE WHEN l_orderkey % 997 = 0 THEN 'n/d' WHEN l_linenumber = 3 AND l_tax = 0 THEN '0,00' ELSE translate(format('{{:,.2f}}', l_extendedprice), ',.', '.,') END AS vl_liquido,
 CASE c_mktsegment WHEN 'MACHINERY' THEN 'Rural' WHEN 'HOUSEHOLD' THEN '{{ñ class}}' ELSE 'Urbano ' END AS ramo_atividade,
 CASE WHEN l_orderkey % 991 = 0 THEN '31/02/2000' ELSE strftime(o_orderdate,'%d/%m/%Y') END AS dt_inicio_validade,
 CASE WHEN p_size = 48 THEN 'x' ELSE lpad(CAST(CASE WHEN p_size >= 49 THEN p_size + 38 ELSE p_size END AS VARCHAR), 3, ' ') END AS especie_codigo,
 concat('Especie ', CAST(p_size AS VARCHAR)) AS especie_descricao,
 strftime(o_orderdate,'%Y%m') AS _ano_mes
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey
LEFT JOIN {_STATES} ur(k, nome, sg) ON c_nationkey = ur.k LEFT JOIN {_STATES} up(k, nome, sg) ON s_nationkey = up.k)"""

BRONZE = f"""bronze AS MATERIALIZED (
SELECT * REPLACE (
   try_cast(replace(replace(vl_liquido, '.', ''), ',', '.') AS DECIMAL(12,2)) AS vl_liquido,
   CAST(try_strptime(dt_inicio_validade, '%d/%m/%Y') AS DATE) AS dt_inicio_validade),
   {_text(Q.SOURCE)} AS _source_path, {_text(Q.RUN_TS)} AS _ingestion_ts
FROM raw)"""

_TRIMMED = ("tipo_beneficio", "uf", "meio_pagamento", "banco", "mun_pagto", "mun_resid",
            "especie_codigo", "especie_descricao")
_MARKERS = _list(fixed.NULL_MARKERS)

CLEAN = "clean AS (SELECT * REPLACE (" + ", ".join(
    [f"trim({c}, ' ') AS {c}" for c in _TRIMMED]
    + [f"CASE WHEN trim({c}, ' ') NOT IN ({_MARKERS}) THEN trim({c}, ' ') END AS {c}"
       for c in fixed.CATEGORICAL_COLUMNS]
) + ") FROM bronze)"

_PAY_KEY = r"split_part(regexp_replace(meio_pagamento, '\s+-\s+', '|'), '|', 1)"


def _case(key: str, entries: dict[str, str]) -> str:
    return f"CASE {key} " + " ".join(
        f"WHEN {_text(k)} THEN {_text(v)}" for k, v in entries.items()
    ) + " END"


def _town(column: str) -> str:
    return (
        f"split_part({column}, '-', 1) AS {column}_codigo, "
        f"upper(nullif(split_part({column}, '-', 2), '')) AS {column}_sg_uf, "
        rf"regexp_replace({column}, '^\d+-[A-Za-z]+-', '') AS {column}_nome"
    )


SILVER = f"""parsed AS (
SELECT * EXCLUDE (especie_codigo),
   banco AS origem_banco, meio_pagamento AS origem_pagamento,
   try_cast(split_part(banco, '-', 1) AS INTEGER) AS banco_codigo,
   regexp_replace(banco, '^\\d+-', '') AS banco_nome,
   {_town("mun_pagto")}, {_town("mun_resid")},
   {_case("uf", fixed.STATE_CODES)} AS sg_uf,
   try_cast(especie_codigo AS INTEGER) AS especie_codigo,
   {_case(_PAY_KEY, {k: v[0] for k, v in fixed.PAYMENT_MEANS.items()})} AS meio_pag_codigo,
   {_case(_PAY_KEY, {k: v[1] for k, v in fixed.PAYMENT_MEANS.items()})} AS meio_pag_descricao,
   CAST(year(dt_inicio_validade) AS INTEGER) AS ano_inicio,
   CAST(month(dt_inicio_validade) AS INTEGER) AS mes_inicio,
   coalesce(vl_liquido <= 0, false) AS fl_vl_zero
FROM clean),
silver AS MATERIALIZED (
SELECT * EXCLUDE (banco, mun_pagto, mun_resid, meio_pagamento),
   mun_pagto_codigo = mun_resid_codigo AS fl_mesmo_municipio, {_text(Q.RUN_TS)} AS _silver_ts,
   CASE {" ".join(f"WHEN especie_codigo IN ({_list(codes)}) THEN {_text(group)}"
                  for group, codes in fixed.SPECIES_GROUPS.items())}
        ELSE {_text(fixed.OTHER_GROUP)} END AS grupo_especie
FROM parsed)"""

N = "CAST(count(*) AS BIGINT)"


def _fixed_point(units: str, digits: int) -> str:
    """Exact text of a whole number of the last digit, as a decimal is printed."""
    return f"CAST(({units}) // {10**digits} AS VARCHAR) || '.' || lpad(CAST(({units}) % {10**digits} AS VARCHAR), {digits}, '0')"


# Mean to six digits, rounded half up, from whole cents.
MEAN = _fixed_point(
    "(CAST(sum(vl_liquido) * 100 AS HUGEINT) * 20000 + count(vl_liquido)) // (2 * count(vl_liquido))", 6
)
TOTAL = "CAST(sum(vl_liquido) AS VARCHAR)"


def _pct(condition: str) -> str:
    return f"round(100.0::DOUBLE * count(*) FILTER (WHERE {condition}) / count(*), 2)"


def _share(column: str) -> str:
    whole = f"CAST(sum({column}) OVER (PARTITION BY _ano_mes) AS DOUBLE)"
    return f"round(CAST({column} AS DOUBLE) * 100.0::DOUBLE / nullif({whole}, 0), 2)"


def _rank(column: str, partition: str = "_ano_mes") -> str:
    return (
        f"CAST(dense_rank() OVER (PARTITION BY {partition} ORDER BY {column} DESC NULLS LAST) "
        "AS INTEGER)"
    )


def _q(p: float) -> str:
    return f"CAST(quantile_disc(vl_liquido, {p}) AS VARCHAR)"


FAT_UF = f"""uf_grupo AS (
SELECT uf, sg_uf, _ano_mes, grupo_especie AS grupo_especie_top, {N} AS qtd_beneficios,
   sum(vl_liquido) AS total, {MEAN} AS vl_medio, {_q(0.5)} AS vl_mediano,
   CAST(min(vl_liquido) AS VARCHAR) AS vl_minimo, CAST(max(vl_liquido) AS VARCHAR) AS vl_maximo,
   {_pct("sexo = 'Feminino'")} AS pct_feminino, {_pct("sexo = 'Masculino'")} AS pct_masculino,
   {_pct("ramo_atividade = 'Rural'")} AS pct_rural,
   {_pct("fl_mesmo_municipio")} AS pct_pagto_mesmo_municipio,
   count(DISTINCT mun_resid_codigo) AS qtd_municipios_atendidos,
   count(DISTINCT banco_codigo) AS qtd_bancos_utilizados, {_text(Q.RUN_TS)} AS _gold_ts
FROM silver GROUP BY ALL),
fat_uf AS (
SELECT * EXCLUDE (total), CAST(total AS VARCHAR) AS vl_total,
   {_rank("qtd_beneficios")} AS rank_qtd, {_rank("total")} AS rank_vl_total,
   {_share("qtd_beneficios")} AS pct_nacional_qtd, {_share("total")} AS pct_nacional_valor
FROM uf_grupo)"""

TOP_STATE = """top_state AS (
SELECT _ano_mes, especie_codigo, sg_uf AS uf_com_mais_beneficios
FROM (SELECT _ano_mes, especie_codigo, sg_uf, count(*) AS n FROM silver GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY _ano_mes, especie_codigo
                           ORDER BY n DESC, sg_uf ASC NULLS LAST) = 1)"""

FAT_ESPECIE = f"""{TOP_STATE},
especie AS (
SELECT especie_codigo, especie_descricao, grupo_especie, _ano_mes, {N} AS qtd_beneficios,
   {TOTAL} AS vl_total, {MEAN} AS vl_medio, {_q(0.5)} AS vl_mediano,
   CAST(max(vl_liquido) AS VARCHAR) AS vl_maximo,
   {_pct("sexo = 'Feminino'")} AS pct_feminino, {_pct("ramo_atividade = 'Rural'")} AS pct_rural,
   {_pct("clientela = 'Urbano'")} AS pct_urbano,
   {_pct("fl_mesmo_municipio")} AS pct_mesmo_municipio,
   count(DISTINCT uf) AS qtd_ufs_atendidas,
   CAST(count(*) FILTER (WHERE fl_vl_zero) AS BIGINT) AS qtd_vl_zero, {_text(Q.RUN_TS)} AS _gold_ts
FROM silver GROUP BY ALL),
fat_especie AS (
SELECT especie.*, uf_com_mais_beneficios,
   {_rank("qtd_beneficios", "_ano_mes, grupo_especie")} AS rank_no_grupo
FROM especie LEFT JOIN top_state USING (_ano_mes, especie_codigo))"""

FAT_BANCO = f"""banco AS (
SELECT banco_codigo, banco_nome, _ano_mes, {N} AS qtd_beneficios, sum(vl_liquido) AS total,
   {MEAN} AS vl_medio, count(DISTINCT uf) AS qtd_ufs_atendidas,
   count(DISTINCT mun_pagto_codigo) AS qtd_municipios_pagadores,
   {_pct("meio_pag_codigo = 'CCF'")} AS pct_conta_corrente,
   {_pct("meio_pag_codigo = 'CMG'")} AS pct_cartao, {_text(Q.RUN_TS)} AS _gold_ts
FROM silver GROUP BY ALL),
fat_banco AS (
SELECT * EXCLUDE (total), CAST(total AS VARCHAR) AS vl_total, {_rank("qtd_beneficios")} AS rank_qtd,
   {_share("qtd_beneficios")} AS market_share_pct, {_share("total")} AS market_share_valor_pct
FROM banco)"""

KPIS = f"""kpis AS (
SELECT _ano_mes, {N} AS total_beneficios, count(DISTINCT uf) AS total_ufs_atendidas,
   count(DISTINCT mun_resid_codigo) AS total_municipios_atendidos, {TOTAL} AS vl_total_brasil,
   {MEAN} AS vl_medio_nacional, CAST(max(vl_liquido) AS VARCHAR) AS vl_maximo_nacional,
   {_pct("sexo = 'Feminino'")} AS pct_feminino, {_pct("ramo_atividade = 'Rural'")} AS pct_rural,
   {_pct("fl_mesmo_municipio")} AS pct_pagto_mesmo_municipio,
   count(DISTINCT especie_codigo) AS total_especies_ativas,
   count(DISTINCT banco_codigo) AS total_bancos_pagadores,
   CAST(count(*) FILTER (WHERE fl_vl_zero) AS BIGINT) AS qtd_vl_zero,
   CAST(count(*) FILTER (WHERE sexo IS NULL) AS BIGINT) AS qtd_sexo_nulo,
   {_q(0.5)} AS vl_mediano_nacional, {_q(0.9)} AS vl_p90_nacional, {_text(Q.RUN_TS)} AS _gold_ts
FROM silver GROUP BY _ano_mes)"""


def _over(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _raw(select: str) -> str:
    return _over(select, RAW)


def _bronze(select: str) -> str:
    return _over(select, RAW, BRONZE)


def _silver(select: str, *more: str) -> str:
    return _over(select, RAW, BRONZE, CLEAN, SILVER, *more)


def _counted(columns: str) -> str:
    return _silver(f"SELECT {columns}, {N} AS qtd FROM silver GROUP BY ALL")


def _bronze_columns() -> str:
    shown = {"vl_liquido": "CAST(vl_liquido AS VARCHAR) AS vl_liquido",
             "dt_inicio_validade": "CAST(dt_inicio_validade AS VARCHAR) AS dt_inicio_validade"}
    columns = [*fixed.LANDING_TO_BRONZE.values(), "_ano_mes", "_source_path", "_ingestion_ts"]
    return ", ".join(shown.get(c, c) for c in columns)


_KEPT = ("despacho", "sexo", "clientela", "tipo_beneficio", "uf", "ramo_atividade",
         "especie_descricao", "_ano_mes", "_source_path", "_ingestion_ts")
_DERIVED = (
    "banco_codigo", "banco_nome", "mun_pagto_codigo", "mun_pagto_sg_uf", "mun_pagto_nome",
    "mun_resid_codigo", "mun_resid_sg_uf", "mun_resid_nome", "sg_uf", "especie_codigo",
    "meio_pag_codigo", "meio_pag_descricao", "ano_inicio", "mes_inicio", "fl_vl_zero",
    "fl_mesmo_municipio", "_silver_ts",
)
_SILVER_ALL = (*_KEPT, "vl_liquido", "dt_inicio_validade", *_DERIVED)
_SILVER_SHOWN = (
    ", ".join([*_KEPT, *_DERIVED]) + ", CAST(vl_liquido AS VARCHAR) AS vl_liquido, "
    "CAST(dt_inicio_validade AS VARCHAR) AS dt_inicio_validade"
)


def _null_profile() -> str:
    columns = [c for c in _SILVER_ALL if not c.startswith("_")]
    rows = " UNION ALL ".join(
        f"SELECT {_text(c)} AS coluna, {N} - count({c}) AS nulos, "
        f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS pct FROM silver"
        for c in columns
    )
    return _silver(f"SELECT * FROM ({rows}) ORDER BY nulos DESC, coluna LIMIT 10")


def _silver_schema() -> str:
    types = {"vl_liquido": "decimal(12,2)", "dt_inicio_validade": "date", "banco_codigo": "int",
             "especie_codigo": "int", "ano_inicio": "int", "mes_inicio": "int",
             "fl_vl_zero": "boolean", "fl_mesmo_municipio": "boolean"}
    return _silver(" UNION ALL ".join(
        f"SELECT {_text(c)} AS coluna, {_text(types.get(c, 'string'))} AS tipo, "
        f"{str(c.startswith('_')).lower()} AS metadado, CAST(count({c}) AS BIGINT) AS preenchidas "
        "FROM silver" for c in _SILVER_ALL
    ))


def _header_dedup() -> str:
    return _raw(" UNION ALL ".join(
        f"SELECT {i} AS posicao, {_text(header)} AS coluna, "
        f"CAST(count({column}) AS BIGINT) AS preenchidas FROM raw"
        for i, (header, column) in enumerate(fixed.LANDING_TO_BRONZE.items())
    ))


def _run_audit() -> str:
    runs = [(Q.RUN_TS, "true"), (Q.LATER_TS, "_ano_mes LIKE '1998%'"),
            (Q.LAST_TS, f"_ano_mes = {_text(Q.REWRITTEN_MONTH)}")]
    return _bronze(" UNION ALL ".join(
        f"SELECT {_text(ts)} AS run_ts, 'replace' AS operacao, min(_ano_mes) AS primeiro_mes, "
        f"max(_ano_mes) AS ultimo_mes, {N} AS linhas, CAST(count(*) FILTER (WHERE vl_liquido IS NULL) "
        "+ count(*) FILTER (WHERE dt_inicio_validade IS NULL) AS BIGINT) AS nulos "
        f"FROM bronze WHERE {condition}" for ts, condition in runs
    ))


def _reconciliation() -> str:
    def shares(name: str, table: str, column: str) -> str:
        return (
            f"SELECT {_text(name)} AS verificacao, _ano_mes, round(sum({column}), 2) AS lhs, "
            f"100.0::DOUBLE AS rhs, abs(round(sum({column}), 2) - 100.0) < 1.0 AS ok "
            f"FROM {table} GROUP BY _ano_mes"
        )

    def rows(name: str, table: str) -> str:
        return (
            f"SELECT {_text(name)} AS verificacao, _ano_mes, "
            "CAST(sum(qtd_beneficios) AS DOUBLE) AS lhs, "
            "CAST(any_value(total_beneficios) AS DOUBLE) AS rhs, "
            "sum(qtd_beneficios) = any_value(total_beneficios) AS ok "
            f"FROM {table} JOIN kpis USING (_ano_mes) GROUP BY _ano_mes"
        )

    checks = [
        shares("fat_uf_soma_pct", "fat_uf", "pct_nacional_qtd"),
        shares("fat_banco_soma_pct", "fat_banco", "market_share_pct"),
        rows("fat_uf_total", "fat_uf"),
        rows("fat_especie_total", "fat_especie"),
        rows("fat_banco_total", "fat_banco"),
    ]
    return _silver(" UNION ALL ".join(checks), FAT_UF, FAT_ESPECIE, FAT_BANCO, KPIS)


def _delivery_rescued() -> str:
    fields = list(fixed.LANDING_TO_BRONZE.values())
    few, many = (_text(Q.BROKEN_CENTS[why]) for why in ("campos_a_menos", "campos_a_mais"))
    return f"""WITH {RAW}, lines AS (
        SELECT CASE WHEN _ano_mes < {_text(Q.EVOLVED_FROM)} THEN 'older' ELSE 'newer' END AS pasta, uf, right(vl_liquido, 2) AS cents,
               concat_ws(';', {', '.join(fields)}) AS whole, concat_ws(';', {', '.join(fields[:-1])}) AS short FROM raw
    ), judged AS (
        SELECT pasta, CASE cents WHEN {few} THEN 'campos_a_menos' WHEN {many} THEN 'campos_a_mais' ELSE 'boa' END AS situacao,
               CASE cents WHEN {few} THEN short WHEN {many} THEN whole || ';sobra' ELSE uf END AS chave FROM lines
    )
    SELECT pasta, situacao, chave, {N} AS qtd FROM judged GROUP BY ALL
    UNION ALL SELECT pasta, 'auditoria', 'landing', {N} FROM judged GROUP BY pasta
    UNION ALL SELECT pasta, 'auditoria', 'quarantine', {N} FROM judged WHERE situacao <> 'boa' GROUP BY pasta"""


def _people() -> str:
    prime = P._PRIME

    def mix(salt: int) -> str:
        step = f"((id % {prime}) * 48271 + {salt * 7919 + 17}) % {prime}"
        squared = f"(({step}) * ({step}) + {salt}) % {prime}"
        return f"((({squared}) * 69621 + {salt * 104729}) % {prime})"

    def pick(salt: int, choices) -> str:
        return f"([{_list(choices)}])[{mix(salt)} % {len(choices)} + 1]"

    def digits(salt: int, width: int) -> str:
        return f"lpad(CAST({mix(salt)} % {10**width} AS VARCHAR), {width}, '0')"

    base = [f"(number // {10**p} % 10)" for p in range(8, -1, -1)]
    first = " + ".join(f"{d} * {w}" for d, w in zip(base, range(10, 1, -1), strict=True))
    second = " + ".join(f"{d} * {w}" for d, w in zip([*base, "d1"], range(11, 1, -1), strict=True))

    def check(total: str) -> str:
        return f"CASE WHEN 11 - ({total}) % 11 >= 10 THEN 0 ELSE 11 - ({total}) % 11 END"

    given, family = pick(1, P.GIVEN_NAMES), pick(2, P.FAMILY_NAMES)
    return f"""WITH ids AS (SELECT CAST(c_custkey AS BIGINT) AS id FROM customer),
numbered AS (SELECT id, {mix(3)} % 1000000000 AS number FROM ids),
one AS (SELECT *, {check(first)} AS d1 FROM numbered),
two AS (SELECT *, {check(second)} AS d2 FROM one)
SELECT id, {given} || ' ' || {family} AS nome,
  lower({given} || '.' || {family} || CAST(id AS VARCHAR) || '@example.com') AS email,
  printf('%03d.%03d.%03d-%d%d', number // 1000000, number // 1000 % 1000, number % 1000, d1, d2) AS cpf,
  '(' || CAST({mix(4)} % 89 + 11 AS VARCHAR) || ') 9' || {digits(5, 4)} || '-' || {digits(6, 4)} AS telefone,
  {pick(7, P.STREETS)} || ', ' || CAST({mix(8)} % 2000 + 1 AS VARCHAR) AS endereco,
  {pick(10, P.CITIES)} AS cidade, {pick(11, fixed.STATE_CODES.values())} AS estado,
  {digits(12, 5)} || '-' || {digits(13, 3)} AS cep,
  CAST(DATE '2026-01-31' - CAST({18 * 366} + {mix(9)} % {72 * 365 - 18} AS INTEGER) AS VARCHAR) AS data_nascimento,
  {pick(14, P.FAMILY_NAMES)} || ' ' || {pick(15, P.COMPANY_KINDS)} AS empresa,
  {pick(16, P.JOBS)} AS cargo,
  CAST(180000 + {mix(17)} % 2320001 AS DOUBLE) / 100 AS salario,
  {_text(Q.RUN_TS)} AS _ingestion_ts
FROM two"""


_REGISTERED = "SELECT _ano_mes, banco_codigo, banco_nome, qtd_beneficios, vl_total FROM fat_banco"

ORACLE: dict[str, str] = {
    "landing_roundtrip_by_uf": _raw(
        f"SELECT uf, {N} AS qtd, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM raw GROUP BY uf"
    ),
    "header_sniff": _raw(f"SELECT ';' AS separador, 14 AS colunas, {N} AS linhas FROM raw"),
    "header_dedup": _header_dedup(),
    "delivery_mixed_headers": _raw(
        f"SELECT CASE WHEN _ano_mes < {_text(Q.EVOLVED_FROM)} THEN 'older' ELSE 'newer' END AS pasta, sexo, uf, "
        f"especie_codigo, especie_descricao, replace(vl_liquido, ',', '') AS vl_digitos, {N} AS qtd FROM raw GROUP BY ALL"
    ),
    "bronze_typed": _bronze(f"SELECT {_bronze_columns()} FROM bronze"),
    "bronze_quality": _bronze(
        f"SELECT _ano_mes, {N} AS total, CAST(count(*) FILTER (WHERE vl_liquido IS NULL) AS BIGINT) AS nulos_vl, "
        "CAST(count(*) FILTER (WHERE dt_inicio_validade IS NULL) AS BIGINT) AS nulos_dt, "
        f"{_pct('vl_liquido IS NULL')} AS pct_nulos_vl, {_pct('dt_inicio_validade IS NULL')} AS pct_nulos_dt, "
        "any_value(origem.n) AS total_origem, count(*) = any_value(origem.n) AS confere FROM bronze "
        "JOIN (SELECT _ano_mes, count(*) AS n FROM raw GROUP BY _ano_mes) origem USING (_ano_mes) "
        "GROUP BY _ano_mes"
    ),
    "bronze_top_uf": _bronze(
        f"SELECT uf, {N} AS qtd_beneficios, {TOTAL} AS vl_total FROM bronze GROUP BY uf "
        "ORDER BY qtd_beneficios DESC, uf ASC NULLS LAST LIMIT 10"
    ),
    "bronze_preview": _bronze(
        "SELECT * REPLACE (CAST(vl_liquido AS VARCHAR) AS vl_liquido, "
        "CAST(dt_inicio_validade AS VARCHAR) AS dt_inicio_validade) FROM ("
        "SELECT despacho, sexo, uf, tipo_beneficio, vl_liquido, dt_inicio_validade, especie_codigo, "
        "especie_descricao, _ano_mes, _ingestion_ts FROM bronze ORDER BY ALL ASC NULLS FIRST LIMIT 5)"
    ),
    "silver_clean": _over(
        "SELECT despacho, sexo, clientela, tipo_beneficio, uf, ramo_atividade, especie_codigo, "
        f"especie_descricao, {N} AS qtd FROM clean GROUP BY ALL", RAW, BRONZE, CLEAN
    ),
    "silver_bank": _counted("origem_banco AS origem, banco_codigo, banco_nome"),
    "silver_municipality": _counted(
        "mun_pagto_codigo, mun_pagto_sg_uf, mun_pagto_nome, "
        "mun_resid_codigo, mun_resid_sg_uf, mun_resid_nome"
    ),
    "silver_state": _counted("uf, sg_uf"),
    "silver_state_broadcast": _counted("uf, sg_uf"),
    "silver_payment": _counted("origem_pagamento AS origem, meio_pag_codigo, meio_pag_descricao"),
    "silver_time_flags": _counted("_ano_mes, ano_inicio, mes_inicio, fl_vl_zero, fl_mesmo_municipio"),
    "silver_full": _silver(f"SELECT {_SILVER_SHOWN} FROM silver"),
    "silver_null_profile": _null_profile(),
    "silver_schema": _silver_schema(),
    "silver_uf_volume": _silver(
        f"SELECT sg_uf, uf, {N} AS qtd, {TOTAL} AS vl_total, {MEAN} AS vl_medio FROM silver "
        "GROUP BY ALL ORDER BY sum(vl_liquido) DESC NULLS LAST, uf ASC NULLS LAST LIMIT 5"
    ),
    "silver_top_species": _silver(
        f"SELECT especie_codigo, especie_descricao, {N} AS qtd, {TOTAL} AS vl_total FROM silver "
        "GROUP BY ALL ORDER BY qtd DESC, especie_codigo ASC NULLS LAST, "
        "especie_descricao ASC NULLS LAST LIMIT 5"
    ),
    "silver_same_town": _silver(
        "SELECT CAST(count(*) FILTER (WHERE NOT fl_mesmo_municipio) AS BIGINT) AS pagto_diferente, "
        "CAST(count(*) FILTER (WHERE fl_mesmo_municipio) AS BIGINT) AS pagto_mesmo FROM silver"
    ),
    "species_group": _counted("especie_codigo, grupo_especie"),
    "fat_uf": _silver("SELECT * FROM fat_uf", FAT_UF),
    "fat_especie": _silver("SELECT * FROM fat_especie", FAT_ESPECIE),
    "fat_banco": _silver("SELECT * FROM fat_banco", FAT_BANCO),
    "kpis_nacionais": _silver("SELECT * FROM kpis", KPIS),
    "percentile_exact": _silver(
        f"SELECT uf, sexo, {_q(0.1)} AS p10, {_q(0.5)} AS p50, {_q(0.9)} AS p90 FROM silver "
        "WHERE vl_liquido IS NOT NULL GROUP BY ALL"
    ),
    "percentile_approx_error": _silver(
        "SELECT _ano_mes, n, " + ", ".join(f"CAST({name} AS VARCHAR) AS {name}" for name in Q.RANK_WINDOW)
        + ", p50_de <= p50 AND p50 <= p50_ate AS p50_ok, p90_de <= p90 AND p90 <= p90_ate AS p90_ok "
        f"FROM (SELECT _ano_mes, {N} AS n, " + ", ".join(
            f"quantile_disc(vl_liquido, {p}) AS {name}" for name, p in Q.RANK_WINDOW.items()
        ) + ", quantile_disc(vl_liquido, 0.5) AS p50, quantile_disc(vl_liquido, 0.9) AS p90 "
        "FROM silver WHERE vl_liquido IS NOT NULL GROUP BY _ano_mes)"
    ),
    "distinct_counts": _silver(
        "SELECT _ano_mes, count(DISTINCT uf) AS ufs, count(DISTINCT mun_resid_codigo) AS municipios, "
        "count(DISTINCT especie_codigo) AS especies, count(DISTINCT banco_codigo) AS bancos "
        "FROM silver GROUP BY _ano_mes"
    ),
    "distinct_rollup": _silver(" UNION ALL ".join(
        f"SELECT {month} AS _ano_mes, {uf} AS uf, '{column}' AS coluna, CAST(count(DISTINCT {column}) AS BIGINT) AS distintos, "
        f"'{level}' AS nivel FROM silver GROUP BY {group} HAVING count({column}) > 0"
        for level, month, uf, group in (("mes", "_ano_mes", "NULL", "_ano_mes"), ("uf", "NULL", "uf", "uf"), ("total", "NULL", "NULL", "()"))
        for column in Q.DISTINCT_COLUMNS
    )),
    "percentile_rollup": _silver(
        "SELECT uf, CAST(count(*) AS BIGINT) AS n, " + ", ".join(
            f"CAST(quantile_disc(vl_liquido, {p}) AS VARCHAR) AS {name}" for name, p in Q.RANK_WINDOW.items()
        ) + ", true AS p50_ok, true AS p90_ok FROM silver WHERE vl_liquido IS NOT NULL GROUP BY uf"
    ),
    "paged_query": _silver(
        "SELECT _ano_mes, banco_codigo, banco_nome, qtd_beneficios, CAST((row_number() OVER (ORDER BY _ano_mes NULLS FIRST, "
        f"banco_codigo NULLS FIRST, banco_nome NULLS FIRST) - 1) // {Q.PAGE_ROWS} + 1 AS INTEGER) AS pagina FROM fat_banco "
        f"WHERE qtd_beneficios >= {Q.LEAST_SHOWN} AND _ano_mes >= {_text(Q.EVOLVED_FROM)}", FAT_BANCO
    ),
    "distinct_approx_error": _silver(
        "SELECT _ano_mes, count(DISTINCT mun_resid_codigo) AS municipios, "
        "count(DISTINCT vl_liquido) AS valores, "
        "abs(approx_count_distinct(mun_resid_codigo) - municipios) <= 0.3 * municipios AS municipios_ok, "
        "abs(approx_count_distinct(vl_liquido) - valores) <= 0.3 * valores AS valores_ok "
        "FROM silver GROUP BY _ano_mes"
    ),
    "silver_view_sql": _silver(
        f"SELECT _ano_mes, grupo_especie, {N} AS qtd, {TOTAL} AS vl_total, "
        "CAST(min(vl_liquido) AS VARCHAR) AS vl_minimo, CAST(max(vl_liquido) AS VARCHAR) AS vl_maximo "
        "FROM silver GROUP BY ALL"
    ),
    "share_of_total": _silver(
        f"SELECT _ano_mes, uf, qtd, CAST(total AS VARCHAR) AS vl_total, {_share('qtd')} AS pct_qtd, "
        f"{_share('total')} AS pct_valor FROM (SELECT _ano_mes, uf, {N} AS qtd, "
        "sum(vl_liquido) AS total FROM silver GROUP BY ALL)"
    ),
    "rank_in_group": _silver(
        f"SELECT *, {_rank('qtd', '_ano_mes, grupo_especie')} AS posicao FROM (SELECT _ano_mes, "
        f"grupo_especie, especie_codigo, {N} AS qtd FROM silver GROUP BY ALL)"
    ),
    "top_state_per_species": _silver("SELECT * FROM top_state", TOP_STATE),
    "species_with_top_state": _silver(
        f"SELECT _ano_mes, especie_codigo, qtd, uf_com_mais_beneficios FROM (SELECT _ano_mes, "
        f"especie_codigo, {N} AS qtd FROM silver GROUP BY ALL) "
        "LEFT JOIN top_state USING (_ano_mes, especie_codigo)", TOP_STATE
    ),
    "group_rollup": _silver(
        f"SELECT grupo_especie, {N} AS qtd, {TOTAL} AS vl_total FROM silver GROUP BY grupo_especie"
    ),
    "top5_uf_by_value": _silver(
        "SELECT _ano_mes, rank_vl_total, sg_uf, grupo_especie_top, qtd_beneficios, vl_total, "
        "vl_medio, pct_feminino, pct_nacional_valor FROM fat_uf WHERE rank_vl_total <= 5", FAT_UF
    ),
    "top5_species_by_volume": _silver(
        "SELECT _ano_mes, especie_codigo, especie_descricao, grupo_especie, qtd_beneficios, "
        "vl_total, vl_medio, uf_com_mais_beneficios FROM fat_especie ORDER BY qtd_beneficios DESC, "
        "_ano_mes, especie_codigo ASC NULLS LAST, especie_descricao ASC NULLS LAST LIMIT 5",
        FAT_ESPECIE,
    ),
    "bank_market_share": _silver(
        "SELECT _ano_mes, rank_qtd, banco_codigo, banco_nome, qtd_beneficios, market_share_pct, "
        "market_share_valor_pct FROM fat_banco WHERE rank_qtd <= 5", FAT_BANCO
    ),
    "month_replace_idempotent": _bronze(
        f"SELECT _ano_mes, CASE _ano_mes WHEN {_text(Q.REWRITTEN_MONTH)} THEN {_text(Q.LATER_TS)} "
        f"ELSE {_text(Q.RUN_TS)} END AS _ingestion_ts, {N} AS qtd, {TOTAL} AS vl_total "
        "FROM bronze GROUP BY _ano_mes"
    ),
    "schema_evolution": _bronze(
        f"SELECT _ano_mes, {N} AS qtd, CAST(count(CASE WHEN _ano_mes >= {_text(Q.EVOLVED_FROM)} "
        "THEN especie_descricao END) AS BIGINT) AS com_descricao FROM bronze GROUP BY _ano_mes"
    ),
    "schema_evolution_variant": _bronze(
        f"SELECT CASE WHEN _ano_mes < {_text(Q.EXTRAS_FROM)} THEN 'older' WHEN _ano_mes < {_text(Q.EVOLVED_FROM)} THEN 'middle' "
        f"ELSE 'newer' END AS pasta, uf, {N} AS qtd, "
        f"CAST(count(vl_liquido) FILTER (WHERE pasta <> 'older') AS BIGINT) AS com_nota, "
        f"CAST(sum(vl_liquido) FILTER (WHERE pasta <> 'older') AS VARCHAR) AS vl_nota, "
        f"CAST(min(dt_inicio_validade) FILTER (WHERE pasta = 'middle') AS VARCHAR) AS primeira_visita, "
        f"CAST(max(dt_inicio_validade) FILTER (WHERE pasta = 'middle') AS VARCHAR) AS ultima_visita, "
        f"CAST(count(DISTINCT trim(especie_descricao)) FILTER (WHERE pasta = 'newer') AS BIGINT) AS observacoes "
        "FROM bronze GROUP BY pasta, uf"
    ),
    "incremental_gold": _silver("SELECT * FROM fat_uf", FAT_UF),
    "incremental_ingest": (
        f"SELECT strftime(ts, '%Y%m%d') AS dia, event_type, {N} AS qtd, "
        "CAST(sum(CAST(value AS DECIMAL(18,2))) AS VARCHAR) AS valor FROM events GROUP BY ALL"
    ),
    "delivery_rescued": _delivery_rescued(),
    "synthetic_people": _people(),
    "run_audit": _run_audit(),
    "table_register": _silver(
        f"SELECT _ano_mes, {N} AS bancos, CAST(sum(qtd_beneficios) AS BIGINT) AS qtd, "
        "max(market_share_pct) AS maior_fatia, 2 AS revisao FROM fat_banco GROUP BY _ano_mes", FAT_BANCO
    ),
    "bounded_query": _silver(
        f"{_REGISTERED} ORDER BY _ano_mes ASC NULLS FIRST, banco_codigo ASC NULLS FIRST, "
        f"banco_nome ASC NULLS FIRST LIMIT {Q.SHOWN_ROWS}", FAT_BANCO
    ),
    "reconciliation": _reconciliation(),
    "lake_kpis": _silver("SELECT * FROM kpis", KPIS),
}

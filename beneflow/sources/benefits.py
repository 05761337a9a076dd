"""The dirty benefits feed derived from the shared star-schema tables, one row per lineitem."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beneflow.functions import fixed
from beneflow.functions.parsing import text_literal
from beneflow.session import shuffles_dropped

# Nation key -> state name and its mixed-case code: the first states of the contract, then abroad.
FEED_STATES = [
    (key, name, code.capitalize())
    for key, (name, code) in enumerate([*list(fixed.STATE_CODES.items())[:24], ("Exterior", "EX")])
]

# Schemas of the shared tables in use, so that no job runs to infer them.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _by_nation(key: Column, position: int) -> Column:
    """Text of the state a nation key stands for; NULL for a key that is not in the list."""
    texts = ", ".join(text_literal(state[position]) for state in sorted(FEED_STATES))
    return F.get(F.expr(f"array({texts})"), key)


def _choice(key: Column, values: Sequence[str]) -> Column:
    """Number of the value a key has, from 0; that after the last one for any other key and NULL."""
    chain = F
    for number, value in enumerate(values):
        chain = chain.when(key == value, F.lit(number))
    return chain.otherwise(F.lit(len(values))).cast("tinyint")


def _chosen(number: str, texts: Sequence[str]) -> Column:
    """The text a choice stands for."""
    return F.get(F.array(*[F.lit(text) for text in texts]), F.col(number).cast("int"))


def feed_facts(spark: SparkSession, folder: str) -> DataFrame:
    """What each row of the feed is made of: keys, numbers of choices and short codes, and ``_ano_mes``.

    Join strategies are left to the optimizer. Payments are many times the other rows, and each join that shuffles
    writes them once, so customers are joined to orders first, and no text is made before the last join.
    """
    payments = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice",
        _choice(F.col("l_returnflag"), ["A", "R"]).alias("sexo"),
        F.when(F.col("l_linenumber") == 7, 0).when(F.col("l_linestatus") == "F", 1).otherwise(2).cast("tinyint")
        .alias("clientela"),
        F.when(F.col("l_orderkey") % 997 == 0, 0)
        .when((F.col("l_linenumber") == 3) & (F.col("l_tax") == 0), 1).otherwise(2).cast("tinyint").alias("valor"),
    )
    customers = table(spark, folder, "customer").select(
        "c_custkey", "c_nationkey", (F.col("c_custkey") % 50).cast("tinyint").alias("home_no"),
        _choice(F.col("c_mktsegment"), ["MACHINERY", "HOUSEHOLD"]).alias("ramo_atividade"),
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate",
        F.date_format("o_orderdate", "yyyyMM").alias("_ano_mes"),
        (F.col("o_orderkey") % 991 == 0).alias("sem_data"),
        _choice(F.col("o_orderstatus"), ["F", "O"]).alias("despacho"),
        _choice(F.substring("o_orderpriority", 1, 1), ["1", "2", "3", "4"]).alias("meio_pagamento"),
    )
    ordered = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    parts = table(spark, folder, "part").select("p_partkey", "p_type", "p_size")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    return (
        payments.join(parts, F.col("l_partkey") == F.col("p_partkey")).drop("l_partkey", "p_partkey")
        .join(ordered, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).drop("l_suppkey")
    )


def feed_texts(facts: DataFrame) -> DataFrame:
    """Bronze-named text columns plus ``_ano_mes``, one row for each of ``feed_facts``."""
    paid_no, home_no, bank_no = F.col("s_suppkey") % 50, F.col("home_no"), F.col("s_suppkey") % 21
    size = F.col("p_size")
    species = F.when(size >= 49, size + 38).otherwise(size)
    return facts.select(
        _chosen("despacho", ["Normal  ", " {ñ class}", " Especial"]).alias("despacho"),
        _chosen("sexo", ["Feminino ", "Masculino", "{ñ class}"]).alias("sexo"),
        _chosen("clientela", ["Nao Informado", "Urbano  ", "Rural"]).alias("clientela"),
        F.col("p_type").alias("tipo_beneficio"),
        _by_nation(F.col("c_nationkey"), 1).alias("uf"),
        _chosen("meio_pagamento", ["Ccf - Conta", "Cmg - Cartao", "Ccl  -  Loterica", "Xyz - Outro", "Cmg"])
        .alias("meio_pagamento"),
        F.when(bank_no == 20, "SemCodigo")
        .otherwise(F.concat((bank_no + 100).cast("string"), F.lit("-Banco-"),
                            bank_no.cast("string"), F.lit(" "))).alias("banco"),
        F.when(paid_no == 49, "Ignorado")
        .otherwise(F.concat((paid_no + 20000).cast("string"), F.lit("-"),
                            _by_nation(F.col("s_nationkey"), 2), F.lit("-Mun-"),
                            paid_no.cast("string"))).alias("mun_pagto"),
        F.concat((home_no + 20000).cast("string"), F.lit("-"),
                 _by_nation(F.col("c_nationkey"), 2), F.lit("-Mun-"), home_no.cast("string"))
        .alias("mun_resid"),
        F.when(F.col("valor") == 0, "n/d").when(F.col("valor") == 1, "0,00")
        .otherwise(F.translate(F.format_number("l_extendedprice", 2), ",.", ".,"))
        .alias("vl_liquido"),
        _chosen("ramo_atividade", ["Rural", "{ñ class}", "Urbano "]).alias("ramo_atividade"),
        F.when(F.col("sem_data"), "31/02/2000").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
        .alias("dt_inicio_validade"),
        F.when(size == 48, "x").otherwise(F.lpad(species.cast("string"), 3, " "))
        .alias("especie_codigo"),
        F.concat(F.lit("Especie "), size.cast("string")).alias("especie_descricao"),
        "_ano_mes",
    )


def stored_facts(spark: SparkSession, folder: str, path: str) -> DataFrame:
    """``feed_facts`` written to ``path`` and read back, for queries that need the feed more than once."""
    facts = feed_facts(spark, folder)
    with shuffles_dropped(spark):
        facts.write.parquet(path)
    return spark.read.schema(facts.schema).parquet(path)


def raw_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze-named text columns plus ``_ano_mes``, with the dirt real deliveries carry."""
    return feed_texts(feed_facts(spark, folder))


def landing_texts(facts: DataFrame, cluster: bool = False) -> DataFrame:
    """The feed under its landing headers, plus the month it belongs to. With ``cluster`` rows are rebalanced by
    month, as facts, so that few bytes are moved."""
    headers = {column: header for header, column in fixed.LANDING_TO_BRONZE.items()}
    return feed_texts(facts.hint("rebalance", "_ano_mes") if cluster else facts).withColumnsRenamed(headers)


def landing_feed(spark: SparkSession, folder: str, cluster: bool = False) -> DataFrame:
    return landing_texts(feed_facts(spark, folder), cluster)

"""Registered queries: every operator over the whole shared test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beneflow.functions import fixed
from beneflow.functions import measures as M
from beneflow.functions.catalog import register_functions
from beneflow.operators import extras, gold, layers, quality, reports, states
from beneflow.operators.percentiles import join_on_keys, percentiles
from beneflow.operators.ranking import (
    species_with_top_state,
    top_ordered,
    top_state_per_species,
)
from beneflow.plans import lake as layer_chain
from beneflow.session import shared_folder, shuffles_dropped
from beneflow.sinks.tables import (
    AUDIT_SCHEMA,
    bounded_query,
    pages,
    record_run,
    register_table,
    replace_parts,
    run_history,
)
from beneflow.sources import benefits, deliveries
from beneflow.sources.people import people
from beneflow.sources.tables import MONTH, read_table, schema_report
from beneflow.streaming.arrivals import ingest_arrivals

RUN_TS = "2026-02-01T00:00:00Z"
LATER_TS = "2026-03-01T00:00:00Z"
LAST_TS = "2026-04-01T00:00:00Z"
SOURCE = "landing/beneficios"
REWRITTEN_MONTH = "199803"
EVOLVED_FROM = "199801"
EXTRAS_FROM = "199501"
DELIVERY_HEADER = [
    "Espécie" if header.startswith("Espécie") else header for header in fixed.LANDING_TO_BRONZE
]
# Fewer than the table has, so that the bound is seen to hold.
SHOWN_ROWS = 100
PAGE_ROWS = 150
LEAST_SHOWN = 2
DISTINCT_COLUMNS = ("mun_resid_codigo", "mun_pagto_codigo", "especie_codigo", "banco_codigo", "despacho")
# Lines whose amount ends so are broken, by what is wrong with them.
BROKEN_CENTS = {"campos_a_menos": "13", "campos_a_mais": "37"}
RANK_WINDOW = {"p50_de": 0.48, "p50_ate": 0.52, "p90_de": 0.88, "p90_ate": 0.92}
EVENT_DAY_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string, dia string"
)


def comparable(df: DataFrame) -> DataFrame:
    """Decimals and dates as exact text, so clients of any engine show the same values."""
    shown = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType | T.DateType):
            column = column.cast("string")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def _bronze_of(feed: DataFrame, run_ts: str = RUN_TS) -> DataFrame:
    return layers.to_bronze(feed, F.col(MONTH), SOURCE, run_ts)


def bronze(spark: SparkSession, sf: str, run_ts: str = RUN_TS) -> DataFrame:
    return _bronze_of(benefits.landing_feed(spark, sf), run_ts)


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return layers.to_silver(bronze(spark, sf), RUN_TS)


def _delivered(spark: SparkSession, sf: str) -> str:
    path = shared_folder(spark, "delivery")
    feed = benefits.landing_feed(spark, sf).drop(MONTH)
    deliveries.write_delivery(feed, path, DELIVERY_HEADER)
    return path


# --- landing ------------------------------------------------------------------------------


def landing_roundtrip_by_uf(spark: SparkSession, sf: str) -> DataFrame:
    landing = shared_folder(spark, "landing")
    deliveries.read_delivery(spark, _delivered(spark, sf)).write.mode("overwrite").parquet(landing)
    states = quality.count_by(spark.read.parquet(landing), "UF").withColumnRenamed("UF", "uf")
    total = quality.total_of_groups(states).scalar()
    return states.select("uf", "qtd", total.alias("total"))


def header_sniff(spark: SparkSession, sf: str) -> DataFrame:
    path = _delivered(spark, sf)
    sniffed = {deliveries.sniff_separator(h) for h in deliveries.file_headers(spark, [path])}
    df = deliveries.read_delivery(spark, path)
    return df.agg(M.rows().alias("linhas")).select(
        F.lit("".join(sorted(sniffed))).alias("separador"), F.lit(len(df.columns)).alias("colunas"), "linhas"
    )


def delivery_mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """The feed in files of each separator and of several column orders, in the same month folders."""
    base = shared_folder(spark, "mixed")
    columns, names = list(fixed.LANDING_TO_BRONZE), DELIVERY_HEADER
    share = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(len(fixed.SEPARATORS)))
    # The feed is joined once and kept by separator and folder; each delivery then reads its own part only,
    # in read splits of even size, so it is not dealt anew before it is written.
    staged = shared_folder(spark, "mixed-feed")
    with shuffles_dropped(spark):
        (
            benefits.landing_feed(spark, sf)
            .select(*[F.col(f"`{c}`") for c in columns], share.alias("_parte"),
                    F.when(F.col(MONTH) < EVOLVED_FROM, "older").otherwise("newer").alias("_pasta"))
            .write.partitionBy("_parte", "_pasta").parquet(staged)
        )
    feed = spark.read.parquet(staged)
    for i, separator in enumerate(fixed.SEPARATORS):
        # Another column first each time; the repeated header keeps its own order.
        order = columns[i:] + columns[:i]
        header = names[i:] + names[:i]
        # Fields are written as they are, so no value may hold the separator: only amounts do.
        amount = F.replace(F.col("Vl Líquido"), F.lit(separator), F.lit("\x02"))
        for month in ("older", "newer"):
            part = feed.where((F.col("_parte") == str(i)) & (F.col("_pasta") == month))
            deliveries.write_delivery(
                part.withColumn("Vl Líquido", amount).select(*[F.col(f"`{c}`") for c in order]),
                f"{base}/{MONTH}={month}", header, separator, "append",
            )
    back = deliveries.read_monthly_deliveries(spark, base, ["older", "newer"], columns)
    return quality.count_by(
        back.select(
            F.col(MONTH).alias("pasta"), F.col("`Sexo.`").alias("sexo"), F.col("UF").alias("uf"),
            F.col("Espécie12").alias("especie_codigo"), F.col("Espécie13").alias("especie_descricao"),
            F.translate("Vl Líquido", ",\x02", "").alias("vl_digitos"),
        ),
        "pasta", "sexo", "uf", "especie_codigo", "especie_descricao", "vl_digitos",
    )


def delivery_rescued(spark: SparkSession, sf: str) -> DataFrame:
    """The feed with lines broken by rule, landed: good rows by state, broken lines as they were, and the audit."""
    base = shared_folder(spark, "broken")
    feed = benefits.landing_feed(spark, sf)
    fields = [F.col(f"`{c}`") for c in fixed.LANDING_TO_BRONZE]
    whole, cents = F.concat_ws(";", *fields), F.substring(F.col("Vl Líquido"), -2, 2)
    line = F.when(cents == BROKEN_CENTS["campos_a_menos"], F.concat_ws(";", *fields[:-1]))
    line = line.when(cents == BROKEN_CENTS["campos_a_mais"], F.concat(whole, F.lit(";sobra"))).otherwise(whole)
    halves = F.col(MONTH) < EVOLVED_FROM
    for folder, chosen in (("older", halves), ("newer", ~halves)):
        deliveries.write_delivery(
            feed.where(chosen).select(line.alias("line")), f"{base}/{MONTH}={folder}", DELIVERY_HEADER
        )
    lake = layer_chain.Lake(f"{base}/layers")
    layer_chain.run_landing(spark, base, ["older", "newer"], lake, RUN_TS)
    shown = lambda kind, key, n: [F.col(MONTH).alias("pasta"), kind.alias("situacao"), key.alias("chave"), n.alias("qtd")]
    landed = read_table(spark, lake.table("landing"), schema=f"UF string, {deliveries.REJECTED_LINE} string, {MONTH} string")
    good = quality.count_by(landed.where(F.col(deliveries.REJECTED_LINE).isNull()), MONTH, "UF")
    broken = quality.count_by(
        read_table(spark, lake.table("quarantine"), schema=layer_chain.QUARANTINE_SCHEMA),
        MONTH, deliveries.REJECTED_WHY, deliveries.REJECTED_LINE,
    )
    audit = spark.read.schema(AUDIT_SCHEMA).parquet(lake.audit)
    return (
        good.select(*shown(F.lit("boa"), F.col("UF"), F.col("qtd")))
        .union(broken.select(*shown(F.col(deliveries.REJECTED_WHY), F.col(deliveries.REJECTED_LINE), F.col("qtd"))))
        .union(audit.select(*shown(F.lit("auditoria"), F.col("tabela"), F.col("linhas"))))
    )


def header_dedup(spark: SparkSession, sf: str) -> DataFrame:
    df = deliveries.read_delivery(spark, _delivered(spark, sf))
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    filled = plain.agg(*[F.count(c).alias(c) for c in plain.columns])
    labels = F.array(*[F.lit(name) for name in names])
    position = F.substring("posicao", 2, 10).cast("int")
    return filled.unpivot([], plain.columns, "posicao", "preenchidas").select(
        position.alias("posicao"), F.get(labels, position).alias("coluna"), "preenchidas"
    )


# --- bronze -------------------------------------------------------------------------------


def bronze_quality(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "bronze")
    df = bronze(spark, sf)
    source = benefits.raw_feed(spark, sf)
    replace_parts(df, path, cluster=True)
    return quality.bronze_quality(read_table(spark, path, schema=layers.BRONZE_SCHEMA), source)


def bronze_preview(spark: SparkSession, sf: str) -> DataFrame:
    shown = bronze(spark, sf).select(*fixed.BRONZE_PREVIEW)
    return top_ordered(shown, [F.col(c).asc_nulls_first() for c in shown.columns], 5)


# --- silver -------------------------------------------------------------------------------


def _counted(df: DataFrame, *columns: str) -> DataFrame:
    return quality.count_by(df, *columns)


def silver_clean(spark: SparkSession, sf: str) -> DataFrame:
    return _counted(
        layers.clean(bronze(spark, sf)),
        "despacho", "sexo", "clientela", "tipo_beneficio", "uf", "ramo_atividade",
        "especie_codigo", "especie_descricao",
    )


def silver_bank(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = layers.clean(bronze(spark, sf)).withColumn("origem", F.col("banco"))
    return _counted(layers.parse_bank(cleaned), "origem", "banco_codigo", "banco_nome")


def silver_municipality(spark: SparkSession, sf: str) -> DataFrame:
    df = layers.clean(bronze(spark, sf))
    for town in ("mun_pagto", "mun_resid"):
        df = layers.parse_municipality(df, town)
    return _counted(
        df, *[f"mun_{t}_{p}" for t in ("pagto", "resid") for p in ("codigo", "sg_uf", "nome")]
    )


def silver_state(spark: SparkSession, sf: str) -> DataFrame:
    return _counted(layers.add_state_code(layers.clean(bronze(spark, sf))), "uf", "sg_uf")


def silver_state_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    return _counted(layers.add_state_code_by_join(layers.clean(bronze(spark, sf))), "uf", "sg_uf")


def silver_payment(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = layers.clean(bronze(spark, sf)).withColumn("origem", F.col("meio_pagamento"))
    return _counted(
        layers.parse_payment(cleaned), "origem", "meio_pag_codigo", "meio_pag_descricao"
    )


def silver_time_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _counted(
        silver(spark, sf), MONTH, "ano_inicio", "mes_inicio", "fl_vl_zero", "fl_mesmo_municipio"
    )


def silver_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    profile = quality.null_profile(silver(spark, sf))
    return top_ordered(profile, [F.col("nulos").desc(), F.col("coluna")], 10)


def silver_schema(spark: SparkSession, sf: str) -> DataFrame:
    df = silver(spark, sf)
    report = schema_report(df)
    names = [name for name, _, _ in report]
    filled = df.agg(*[F.count(name).alias(name) for name in names])
    types = {name: F.struct(F.lit(kind).alias("tipo"), F.lit(meta).alias("metadado"))
             for name, kind, meta in report}
    pairs = [part for name, entry in types.items() for part in (F.lit(name), entry)]
    return filled.unpivot([], names, "coluna", "preenchidas").select(
        "coluna", F.create_map(*pairs)[F.col("coluna")].alias("campo"), "preenchidas"
    ).select("coluna", "campo.tipo", "campo.metadado", "preenchidas")


def species_group(spark: SparkSession, sf: str) -> DataFrame:
    return _counted(layers.add_species_group(silver(spark, sf)), "especie_codigo", "grupo_especie")


# --- aggregates and windows ---------------------------------------------------------------


def percentile_exact(spark: SparkSession, sf: str) -> DataFrame:
    wanted = {"p10": 0.1, "p50": 0.5, "p90": 0.9}
    return percentiles(silver(spark, sf), ["uf", "sexo"], "vl_liquido", wanted, most_groups=1000)


def percentile_approx_100(spark: SparkSession, sf: str) -> DataFrame:
    return percentiles(
        silver(spark, sf), [MONTH], "vl_liquido", gold.NATIONAL_PERCENTILES,
        fixed.PERCENTILE_ACCURACY,
    )


def percentile_approx_error(spark: SparkSession, sf: str) -> DataFrame:
    """The exact values round each percentile that its sketch has to lie between, and whether it does.

    The window is twice the promised rank error wide on either side. Both sides of the join have a row a month.
    """
    df = silver(spark, sf).select(MONTH, "vl_liquido").filter(F.col("vl_liquido").isNotNull())
    wanted = {"p50": 0.5, "p90": 0.9}
    sketch = percentiles(df, [MONTH], "vl_liquido", wanted, fixed.PERCENTILE_ACCURACY)
    window = percentiles(df, [MONTH], "vl_liquido", RANK_WINDOW, most_groups=gold.MOST_GROUPS)
    rows = df.groupBy(MONTH).agg(M.rows().alias("n"))
    return rows.join(window, MONTH).join(sketch, MONTH).select(
        MONTH, "n", *RANK_WINDOW,
        *[F.col(name).between(F.col(f"{name}_de"), F.col(f"{name}_ate")).alias(f"{name}_ok") for name in wanted],
    )


def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    columns = {"ufs": "uf", "municipios": "mun_resid_codigo", "especies": "especie_codigo",
               "bancos": "banco_codigo"}
    return silver(spark, sf).groupBy(MONTH).agg(
        *[M.distinct_count(F.col(column)).alias(name) for name, column in columns.items()]
    )


def distinct_approx_error(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the opt-in distinct sketch is within three times its relative error."""
    rsd, columns = 0.02, {"municipios": "mun_resid_codigo", "valores": "vl_liquido"}
    # In one aggregation with exact counts, every distinct value of a month would carry sketches of its own.
    path = shared_folder(spark, "distinct-columns")
    rows = silver(spark, sf).select(MONTH, *columns.values())
    with shuffles_dropped(spark):
        rows.write.parquet(path)
    months = spark.read.schema(rows.schema).parquet(path).groupBy(MONTH)
    exact = months.agg(*[M.distinct_count(F.col(c)).alias(n) for n, c in columns.items()])
    sketches = months.agg(*[M.distinct_count(F.col(c), rsd).alias(f"{n}_aprox") for n, c in columns.items()])
    return join_on_keys(exact, sketches, [MONTH]).select(
        MONTH, *columns,
        *[(F.abs(F.col(f"{n}_aprox") - F.col(n)) <= F.col(n) * (3 * rsd)).alias(f"{n}_ok")
          for n in columns],
    )


def silver_view_sql(spark: SparkSession, sf: str) -> DataFrame:
    """SQL over a temporary view, grouped by a catalogued function."""
    view = f"silver_{uuid.uuid4().hex}"
    silver(spark, sf).createOrReplaceTempView(view)
    register_functions(spark)
    rows = spark.sql(
        f"SELECT {MONTH}, grupo_especie(especie_codigo) AS grupo_especie, count(*) AS qtd, "
        f"sum(vl_liquido) AS vl_total, min(vl_liquido) AS vl_minimo, max(vl_liquido) AS vl_maximo "
        f"FROM {view} GROUP BY {MONTH}, grupo_especie(especie_codigo)"
    )
    # The plan holds what the name stood for.
    spark.catalog.dropTempView(view)
    return rows


def _monthly_state(spark: SparkSession, sf: str, name: str, state: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A state by month, stored; half of the months are delivered again and replace themselves."""
    path = shared_folder(spark, name)
    made = state(silver(spark, sf))
    replace_parts(made, path, cluster=True)
    again = state(silver(spark, sf).where(F.col(MONTH) >= EVOLVED_FROM))
    replace_parts(again, path, cluster=True)
    return spark.read.schema(made.schema).parquet(path)


def distinct_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct codes by month, by state and in all, from monthly bitmaps alone."""
    state = _monthly_state(
        spark, sf, "distinct-state", lambda df: states.distinct_state(df, [MONTH, "uf"], DISTINCT_COLUMNS)
    )
    return states.distinct_rollup(state, [MONTH], ["uf"], []).drop("nivel").withColumn(
        "nivel", F.when(F.col(MONTH).isNotNull(), "mes").when(F.col("uf").isNotNull(), "uf").otherwise("total")
    )


def percentile_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Percentiles by state over all months from monthly sketches alone, each with the exact values round it
    that it has to lie between, and whether it does."""
    state = _monthly_state(
        spark, sf, "quantile-state", lambda df: states.quantile_state(df, [MONTH, "uf"], "vl_liquido")
    )
    sketch = states.quantile_rollup(state, ["uf"], {"p50": 0.5, "p90": 0.9})
    window = percentiles(silver(spark, sf), ["uf"], "vl_liquido", RANK_WINDOW, most_groups=1000)
    return sketch.join(window, "uf").select(
        "uf", "n", *RANK_WINDOW,
        *[F.col(name).between(F.col(f"{name}_de"), F.col(f"{name}_ate")).alias(f"{name}_ok") for name in ("p50", "p90")],
    )


def share_of_total(spark: SparkSession, sf: str) -> DataFrame:
    states = silver(spark, sf).groupBy(MONTH, "uf").agg(
        M.rows().alias("qtd"), F.sum("vl_liquido").alias("vl_total")
    )
    return states.select(
        "*",
        M.percent_of_partition(F.col("qtd"), MONTH).alias("pct_qtd"),
        M.percent_of_partition(F.col("vl_total"), MONTH).alias("pct_valor"),
    )


def rank_in_group(spark: SparkSession, sf: str) -> DataFrame:
    species = _counted(
        layers.add_species_group(silver(spark, sf)), MONTH, "grupo_especie", "especie_codigo"
    )
    return species.withColumn(
        "posicao", M.rank_descending(F.col("qtd"), MONTH, "grupo_especie")
    )


def top_state(spark: SparkSession, sf: str) -> DataFrame:
    counts = silver(spark, sf).groupBy(MONTH, "especie_codigo", "sg_uf").agg(M.rows().alias("n"))
    return top_state_per_species(counts)


def species_top_state(spark: SparkSession, sf: str) -> DataFrame:
    counts = silver(spark, sf).groupBy(MONTH, "especie_codigo", "sg_uf").agg(M.rows().alias("n"))
    return species_with_top_state(counts)


# --- sinks, streaming, audit --------------------------------------------------------------


def month_replace_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "bronze")
    # The tables are joined once for the three runs.
    facts = benefits.stored_facts(spark, sf, shared_folder(spark, "facts"))
    with shuffles_dropped(spark):
        replace_parts(_bronze_of(benefits.landing_texts(facts, cluster=True)), path)
        for run_ts in (LATER_TS, LATER_TS):
            again = _bronze_of(benefits.landing_texts(facts), run_ts).filter(F.col(MONTH) == REWRITTEN_MONTH)
            replace_parts(again, path, [REWRITTEN_MONTH])
    return read_table(spark, path, schema=layers.BRONZE_SCHEMA).groupBy(MONTH, "_ingestion_ts").agg(
        M.rows().alias("qtd"), F.sum("vl_liquido").alias("vl_total")
    )


def schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "evolving")
    df = bronze(spark, sf)
    early = F.col(MONTH) < EVOLVED_FROM
    replace_parts(df.drop("especie_descricao").filter(early), path, cluster=True)
    replace_parts(df.filter(~early), path, cluster=True)
    return read_table(spark, path, merge_schema=True).groupBy(MONTH).agg(
        M.rows().alias("qtd"), F.count("especie_descricao").alias("com_descricao")
    )


def schema_evolution_variant(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries with different columns beyond the contract, kept as VARIANT up to silver and typed there."""
    base = shared_folder(spark, "extras")
    # The tables are joined once for the three folders.
    feed = benefits.landing_texts(benefits.stored_facts(spark, sf, shared_folder(spark, "facts")))
    given = {"Nota": "Vl Líquido", "Dt. Visita": "Dt início validade", "Observação": "Espécie13"}
    folders = {
        "older": (F.col(MONTH) < EXTRAS_FROM, []),
        "middle": (F.col(MONTH).between(EXTRAS_FROM, EVOLVED_FROM) & (F.col(MONTH) != EVOLVED_FROM), ["Nota", "Dt. Visita"]),
        "newer": (F.col(MONTH) >= EVOLVED_FROM, ["Observação", "Nota"]),
    }
    for folder, (chosen, names) in folders.items():
        more = [F.col(f"`{given[name]}`").alias(name) for name in names]
        part = feed.where(chosen).select(*[F.col(f"`{c}`") for c in fixed.LANDING_TO_BRONZE], *more)
        deliveries.write_delivery(part, f"{base}/{MONTH}={folder}", [*DELIVERY_HEADER, *names])
    lake = layer_chain.Lake(f"{base}/layers")
    layer_chain.run_landing(spark, base, list(folders), lake, RUN_TS)
    layer_chain.run_bronze(spark, list(folders), lake, RUN_TS, variant=True)
    layer_chain.run_silver(spark, list(folders), lake, RUN_TS)
    typed = extras.with_extras(
        read_table(spark, lake.table("silver")), {"Nota": extras.MONEY, "Dt. Visita": extras.DAY, "Observação": "string"}
    )
    return typed.groupBy(F.col(MONTH).alias("pasta"), "uf").agg(
        M.rows().alias("qtd"), F.count("Nota").alias("com_nota"), F.sum("Nota").alias("vl_nota"),
        F.min("`Dt. Visita`").alias("primeira_visita"), F.max("`Dt. Visita`").alias("ultima_visita"),
        F.countDistinct("Observação").alias("observacoes"),
    )


def incremental_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries, the second with late files for some months: ``fat_uf`` finished from the states of both."""
    base = shared_folder(spark, "increments")
    # The tables are joined once for both deliveries, whose rows are rebalanced by month as facts.
    facts = benefits.stored_facts(spark, sf, shared_folder(spark, "facts"))
    feed = benefits.landing_texts(facts, cluster=True)
    late = (F.col(MONTH) >= EVOLVED_FROM) & (F.pmod(F.xxhash64("Vl Líquido", "UF"), F.lit(3)) == 0)
    lake = layer_chain.Lake(f"{base}/layers")
    for delivery in (feed.where(~late), feed.where(late)):
        with shuffles_dropped(spark):
            (
                delivery.write.mode("append").partitionBy(MONTH)
                .options(header=True, sep=";", encoding=fixed.DELIVERY_ENCODING)
                .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
                .csv(f"{base}/deliveries")
            )
        layer_chain.follow_files(spark, f"{base}/deliveries", lake, f"{base}/checkpoint", RUN_TS)
    return read_table(spark, lake.table("fat_uf"))


def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries touching the same days; the second run rebuilds whole days."""
    base = shared_folder(spark, "arrivals")
    landing, target = f"{base}/landing", f"{base}/daily"
    events = benefits.table(spark, sf, "events").withColumn("dia", F.date_format("ts", "yyyyMMdd"))
    first = F.col("event_type").isin("click", "view")
    for delivery in (events.filter(first), events.filter(~first)):
        delivery.hint("rebalance", "dia").write.mode("append").partitionBy("dia").parquet(landing)
        ingest_arrivals(
            spark, landing, EVENT_DAY_SCHEMA, target, f"{base}/checkpoint", lambda df: df, "dia"
        )
    daily = read_table(spark, target, key="dia", schema=EVENT_DAY_SCHEMA)
    return daily.groupBy("dia", "event_type").agg(
        M.rows().alias("qtd"), F.sum(F.col("value").cast("decimal(18,2)")).alias("valor")
    )


def synthetic_people(spark: SparkSession, sf: str) -> DataFrame:
    return people(benefits.table(spark, sf, "customer"), "c_custkey", "2026-01-31", RUN_TS)


def run_audit(spark: SparkSession, sf: str) -> DataFrame:
    base = shared_folder(spark, "audited")
    runs = {
        RUN_TS: F.lit(True),
        LATER_TS: F.col(MONTH).startswith("1998"),
        LAST_TS: F.col(MONTH) == REWRITTEN_MONTH,
    }
    # The tables are joined once for all runs, whose rows are rebalanced by month as facts.
    facts = benefits.stored_facts(spark, sf, shared_folder(spark, "facts"))
    # The second run is repeated, as after a failure further on.
    for run_ts, months in [*runs.items(), (LATER_TS, runs[LATER_TS])]:
        with shuffles_dropped(spark):
            given = _bronze_of(benefits.landing_texts(facts, cluster=True), run_ts)
            written = replace_parts(given.filter(months), f"{base}/bronze")
        record_run(spark, f"{base}/audit", f"{base}/bronze", "bronze", written, run_ts,
                   ["vl_liquido", "dt_inicio_validade"])
    return run_history(spark, f"{base}/audit", "bronze", 5)


def _registered(spark: SparkSession, df: DataFrame, name: str) -> str:
    """A table name that first stood for a folder with fewer months and columns, now for all of them."""
    wide = df.withColumn("revisao", F.lit(2))
    for rows in (df.where(F.col(MONTH) < EVOLVED_FROM), wide):
        path = shared_folder(spark, name)
        replace_parts(rows, path, cluster=True)
        columns = [f for f in rows.schema.fields if f.name != MONTH]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        register_table(spark, name, path, f"{schema}, {MONTH} string")
    return name


def table_register(spark: SparkSession, sf: str) -> DataFrame:
    name = _registered(spark, gold.fat_banco(silver(spark, sf), RUN_TS), "banco_registrado")
    return spark.sql(
        f"SELECT {MONTH}, count(*) AS bancos, sum(qtd_beneficios) AS qtd, "
        f"max(market_share_pct) AS maior_fatia, max(revisao) AS revisao FROM {name} GROUP BY {MONTH}"
    )


def bounded(spark: SparkSession, sf: str) -> DataFrame:
    name = _registered(spark, gold.fat_banco(silver(spark, sf), RUN_TS), "banco_limitado")
    return bounded_query(
        spark,
        f"SELECT {MONTH}, banco_codigo, banco_nome, qtd_beneficios, vl_total FROM {name}",
        [MONTH, "banco_codigo", "banco_nome"],
        SHOWN_ROWS,
    )


def paged(spark: SparkSession, sf: str) -> DataFrame:
    """A query with named markers, fetched page by page; all pages together, with their numbers."""
    name = _registered(spark, gold.fat_banco(silver(spark, sf), RUN_TS), "banco_paginado")
    order = [MONTH, "banco_codigo", "banco_nome"]
    wanted = spark.sql(
        f"SELECT {MONTH}, banco_codigo, banco_nome, qtd_beneficios FROM {name} WHERE qtd_beneficios >= :minimo AND {MONTH} >= :desde",
        args={"minimo": LEAST_SHOWN, "desde": EVOLVED_FROM},
    )
    # The rows of each page as a client gets them.
    path = shared_folder(spark, "pages")
    for number, page in enumerate(pages(wanted, order, PAGE_ROWS), 1):
        spark.createDataFrame(page, wanted.schema).withColumn("pagina", F.lit(number)).write.mode("append").parquet(path)
    return spark.read.schema(wanted.withColumn("pagina", F.lit(1)).schema).parquet(path)


# --- whole plans --------------------------------------------------------------------------


def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "silver")
    df = silver(spark, sf)
    df.write.parquet(path)
    return quality.reconcile(gold.gold_tables(spark.read.schema(df.schema).parquet(path), RUN_TS))


def lake_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly deliveries, picked up as they arrive, through all layers on storage: the KPI table."""
    base = shared_folder(spark, "lake")
    with shuffles_dropped(spark):
        (
            benefits.landing_feed(spark, sf, cluster=True)
            .write.partitionBy(MONTH)
            .option("header", "true")
            .option("sep", ";")
            .option("encoding", fixed.DELIVERY_ENCODING)
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .csv(f"{base}/deliveries")
        )
    lake = layer_chain.Lake(f"{base}/layers")
    layer_chain.follow_deliveries(spark, f"{base}/deliveries", lake, f"{base}/checkpoint", RUN_TS)
    return read_table(spark, lake.table("kpis_nacionais"))


def top_states_by_count(spark: SparkSession, sf: str) -> DataFrame:
    measures = {"qtd_beneficios": M.rows(), "vl_total": F.sum("vl_liquido")}
    order = [F.col("qtd_beneficios").desc(), F.col("uf").asc_nulls_last()]
    return reports.volume_report(bronze(spark, sf), ["uf"], measures, order, 10)


def top_states_by_value(spark: SparkSession, sf: str) -> DataFrame:
    measures = {"qtd": M.rows(), "vl_total": F.sum("vl_liquido"), "vl_medio": F.avg("vl_liquido")}
    order = [F.col("vl_total").desc_nulls_last(), F.col("uf").asc_nulls_last()]
    return reports.volume_report(silver(spark, sf), ["sg_uf", "uf"], measures, order, 5)


def top_species(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["especie_codigo", "especie_descricao"]
    measures = {"qtd": M.rows(), "vl_total": F.sum("vl_liquido")}
    order = [F.col("qtd").desc(), *[F.col(key).asc_nulls_last() for key in keys]]
    return reports.volume_report(silver(spark, sf), keys, measures, order, 5)


def group_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Species groups from the species table: an aggregate of an aggregate."""
    measures = {"qtd": F.sum("qtd_beneficios"), "vl_total": F.sum("vl_total")}
    return reports.volume_report(gold.fat_especie(silver(spark, sf), RUN_TS), ["grupo_especie"], measures)


def species_by_volume(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.col("qtd_beneficios").desc(), F.col(MONTH), F.col("especie_codigo").asc_nulls_last(),
             F.col("especie_descricao").asc_nulls_last()]
    species = gold.fat_especie(silver(spark, sf), RUN_TS)
    return top_ordered(species.select(*fixed.SPECIES_VOLUME_REPORT), order, 5)


def _over_silver(report: Callable[[DataFrame], DataFrame]) -> Callable:
    return lambda spark, sf: report(silver(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "landing_roundtrip_by_uf": landing_roundtrip_by_uf,
    "header_sniff": header_sniff,
    "header_dedup": header_dedup,
    "delivery_mixed_headers": delivery_mixed_headers,
    "delivery_rescued": delivery_rescued,
    "bronze_typed": bronze,
    "bronze_quality": bronze_quality,
    "bronze_top_uf": top_states_by_count,
    "bronze_preview": bronze_preview,
    "silver_clean": silver_clean,
    "silver_bank": silver_bank,
    "silver_municipality": silver_municipality,
    "silver_state": silver_state,
    "silver_state_broadcast": silver_state_broadcast,
    "silver_payment": silver_payment,
    "silver_time_flags": silver_time_flags,
    "silver_full": silver,
    "silver_null_profile": silver_null_profile,
    "silver_schema": silver_schema,
    "silver_uf_volume": top_states_by_value,
    "silver_top_species": top_species,
    "silver_same_town": _over_silver(quality.same_town_counts),
    "species_group": species_group,
    "fat_uf": _over_silver(lambda s: gold.fat_uf(s, RUN_TS)),
    "fat_especie": _over_silver(lambda s: gold.fat_especie(s, RUN_TS)),
    "fat_banco": _over_silver(lambda s: gold.fat_banco(s, RUN_TS)),
    "kpis_nacionais": _over_silver(lambda s: gold.kpis_nacionais(s, RUN_TS)),
    "percentile_exact": percentile_exact,
    "percentile_approx_100": percentile_approx_100,
    "percentile_approx_error": percentile_approx_error,
    "percentile_rollup": percentile_rollup,
    "distinct_counts": distinct_counts,
    "distinct_rollup": distinct_rollup,
    "distinct_approx_error": distinct_approx_error,
    "silver_view_sql": silver_view_sql,
    "share_of_total": share_of_total,
    "rank_in_group": rank_in_group,
    "top_state_per_species": top_state,
    "species_with_top_state": species_top_state,
    "group_rollup": group_totals,
    "top5_uf_by_value": _over_silver(
        lambda s: reports.ranked_report(gold.fat_uf(s, RUN_TS), fixed.TOP_STATES_REPORT, "rank_vl_total", 5)
    ),
    "top5_species_by_volume": species_by_volume,
    "bank_market_share": _over_silver(
        lambda s: reports.ranked_report(gold.fat_banco(s, RUN_TS), fixed.BANK_SHARES_REPORT, "rank_qtd", 5)
    ),
    "month_replace_idempotent": month_replace_idempotent,
    "schema_evolution": schema_evolution,
    "schema_evolution_variant": schema_evolution_variant,
    "incremental_ingest": incremental_ingest,
    "incremental_gold": incremental_gold,
    "synthetic_people": synthetic_people,
    "run_audit": run_audit,
    "table_register": table_register,
    "bounded_query": bounded,
    "paged_query": paged,
    "reconciliation": reconciliation,
    "lake_kpis": lake_kpis,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shown(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf: comparable(query(spark, sf))

    return {name: shown(query) for name, query in QUERIES.items()}

"""What the optimizer makes of the operators: pruning, pre-aggregation, no Python, no cross join."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from beneflow.operators import gold, reports
from beneflow.operators.percentiles import percentiles
from beneflow.operators.ranking import top_state_per_species
from beneflow.plans import queries
from beneflow.session import shared_folder, shuffles_dropped
from beneflow.sinks.tables import replace_parts
from beneflow.sources import benefits
from beneflow.sources.tables import read_table


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", [
    "bronze_typed", "silver_full", "fat_uf", "fat_especie", "fat_banco", "kpis_nacionais",
    "percentile_exact", "synthetic_people", "silver_null_profile",
])
def test_no_python_and_no_cross_join(spark, folder, name):
    plan = plan_of(queries.QUERIES[name](spark, folder))
    for bad in ("PythonUDF", "EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["bronze_typed", "silver_full", "fat_uf", "fat_especie", "fat_banco", "kpis_nacionais"])
def test_no_job_runs_while_a_plan_is_built(spark, folder, name):
    spark.sparkContext.setJobGroup("plan", name)
    queries.QUERIES[name](spark, folder)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plan")) == []


def test_silver_is_narrow(spark, folder):
    bronze = queries.bronze(spark, folder)
    path = shared_folder(spark, "bronze")
    bronze.write.parquet(path)
    from beneflow.operators.layers import to_silver

    assert "Exchange" not in plan_of(to_silver(spark.read.schema(bronze.schema).parquet(path), "t"))


def test_month_filter_prunes_partitions_and_columns(spark, silver):
    path = shared_folder(spark, "silver")
    replace_parts(silver, path, cluster=True)
    month = read_table(spark, path, ["199803"], schema=silver.schema)
    plan = plan_of(gold.fat_banco(month, "t"))
    assert "PartitionFilters: [isnotnull(_ano_mes" in plan and "199803" in plan
    assert "vl_liquido" in plan and "despacho" not in plan and "mun_resid_codigo" not in plan


def shuffled(df):
    """(partitioning, records written) of every exchange of a plan that ran."""
    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            yield from walk(node.executedPlan())
        elif name.endswith("QueryStage"):
            yield from walk(node.plan())
        elif name != "ReusedExchange":
            if name == "Exchange":
                yield node.outputPartitioning().toString(), node.metrics().apply("shuffleRecordsWritten").value()
            children = node.children()
            for i in range(children.size()):
                yield from walk(children.apply(i))

    return list(walk(df._jdf.queryExecution().executedPlan()))


def test_only_values_near_the_percentiles_are_shuffled(spark):
    n = 400_000
    df = spark.range(0, n, 1, 4).selectExpr(
        "id % 3 AS k", "CAST((id * 7919 % 1000003) / 100 AS decimal(12,2)) AS v"
    )
    path = shared_folder(spark, "values")
    df.write.parquet(path)
    out = percentiles(spark.read.parquet(path), ["k"], "v", {"p10": 0.1, "p50": 0.5, "p90": 0.9}, most_groups=10)
    found = {r.k: (r.p10, r.p50, r.p90) for r in out.collect()}
    records = shuffled(out)
    assert records and sum(r for _, r in records) < 0.1 * n, records
    for k in range(3):
        own = sorted(id * 7919 % 1000003 for id in range(k, n, 3))
        want = tuple(own[-(-p * len(own) // 10) - 1] for p in (1, 5, 9))
        assert tuple(int(x * 100) for x in found[k]) == want


@pytest.mark.parametrize("table", [gold.fat_uf, gold.fat_especie, gold.kpis_nacionais])
def test_silver_is_read_once_for_sums_and_twice_for_percentiles(silver, table):
    df = table(silver, "t")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 3
    values = [n for by, n in shuffled(df) if "units" in by]
    # The smallest tables have hardly more rows than groups have bands.
    assert values and sum(values) < 0.7 * silver.count()


def test_top_state_keeps_one_row_per_key_before_the_shuffle(silver):
    counts = silver.groupBy("_ano_mes", "especie_codigo", "sg_uf").agg(F.count("*").alias("n"))
    assert "WindowGroupLimit" in plan_of(top_state_per_species(counts))


def test_top_k_does_not_sort_everything(silver):
    report = reports.volume_report(silver, ["uf"], {"qtd": F.count("*")}, [F.desc("qtd"), "uf"], 5)
    assert "TakeOrderedAndProject" in plan_of(report)


def test_mixed_deliveries_join_the_feed_once(spark, folder, monkeypatch):
    """each of the eight deliveries reads its part of the staged feed; none joins the tables again."""
    from beneflow.sources import deliveries

    written, write = [], deliveries.write_delivery

    def spy(df, *args, **kwargs):
        written.append(plan_of(df))
        return write(df, *args, **kwargs)

    monkeypatch.setattr(deliveries, "write_delivery", spy)
    queries.QUERIES["delivery_mixed_headers"](spark, folder)
    assert len(written) == 8
    assert all("Join" not in plan for plan in written)


@pytest.mark.parametrize("name, runs", [("month_replace_idempotent", 3), ("run_audit", 4)])
def test_repeated_runs_join_the_feed_once(spark, folder, monkeypatch, name, runs):
    """F8, F5: each run reads the stored facts of the feed; what it moves holds no texts."""
    replaced, replace = [], queries.replace_parts

    def spy(df, *args, **kwargs):
        replaced.append((plan_of(df), kwargs.get("cluster", False)))
        return replace(df, *args, **kwargs)

    monkeypatch.setattr(queries, "replace_parts", spy)
    queries.QUERIES[name](spark, folder)
    assert len(replaced) == runs
    assert not any("Join" in plan or cluster for plan, cluster in replaced)


def test_feed_joins_move_no_texts(spark, folder):
    """F7 and all others over the feed: texts are made on top of the last join, of numbers."""
    plan = benefits.raw_feed(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    above, joins = plan.split("Join", 1)
    for text in ("-Mun-", "Especie ", "Normal", "Masculino", "Urbano", "31/02/2000"):
        assert text in above and text not in joins


def test_shuffles_of_stored_tables_are_dropped(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    found = tracker.shuffleStatuses().size()
    with shuffles_dropped(spark):
        rows.write.parquet(path := shared_folder(spark, "counted"))
    assert tracker.shuffleStatuses().size() <= found and spark.conf.get(key) == before
    assert spark.read.parquet(path).agg(F.sum("count")).first()[0] == 1000


def test_sketches_are_not_carried_by_distinct_values(spark, folder):
    """exact distinct counts group by value; a sketch in the same aggregation is kept once for each value."""
    plan = queries.QUERIES["distinct_approx_error"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    sketches = [line for line in plan.splitlines() if "approx_count_distinct" in line]
    assert sketches and not any("gid" in line for line in sketches)


@pytest.mark.parametrize("name, writes", [("lake_kpis", 1), ("incremental_gold", 2)])
def test_deliveries_are_rebalanced_as_facts(spark, folder, monkeypatch, name, writes):
    """texts are made behind the shuffle by month; the second delivery does not join the tables again."""
    from pyspark.sql.readwriter import DataFrameWriter

    written, csv = [], DataFrameWriter.csv

    def spy(self, path, *args, **kwargs):
        if path.endswith("/deliveries"):
            written.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return csv(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "csv", spy)
    # What is delivered counts here, not what is made of it.
    for step in ("follow_deliveries", "follow_files"):
        monkeypatch.setattr(queries.layer_chain, step, lambda *args, **kwargs: None)
    monkeypatch.setattr(queries, "read_table", lambda *args, **kwargs: None)
    queries.QUERIES[name](spark, folder)
    assert len(written) == writes
    for plan in written:
        above, below = plan.split("RebalancePartitions", 1)
        assert "-Mun-" in above and "-Mun-" not in below
        assert writes == 1 or "Join" not in plan


def test_variant_deliveries_join_the_feed_once(spark, folder, monkeypatch):
    """each of the three folders is written from the stored facts of the feed."""
    from beneflow.sources import deliveries

    written, write = [], deliveries.write_delivery

    def spy(df, *args, **kwargs):
        written.append(plan_of(df))
        return write(df, *args, **kwargs)

    monkeypatch.setattr(deliveries, "write_delivery", spy)
    queries.QUERIES["schema_evolution_variant"](spark, folder)
    assert len(written) == 3
    assert all("Join" not in plan for plan in written)

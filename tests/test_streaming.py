import pytest

from beneflow.session import shared_folder
from beneflow.sources.tables import read_table
from beneflow.streaming.arrivals import ingest_arrivals

SCHEMA = "v int, _ano_mes string"


@pytest.fixture
def places(spark):
    base = shared_folder(spark, "stream-test")
    return f"{base}/landing", f"{base}/target", f"{base}/checkpoint"


def deliver(spark, landing, *rows):
    df = spark.createDataFrame(list(rows), SCHEMA)
    df.coalesce(1).write.mode("append").partitionBy("_ano_mes").parquet(landing)


def ingest(spark, places, transform=lambda df: df):
    landing, target, checkpoint = places
    ingest_arrivals(spark, landing, SCHEMA, target, checkpoint, transform)
    return sorted(tuple(r) for r in read_table(spark, target).select("v", "_ano_mes").collect())


def test_a_late_file_keeps_the_earlier_rows_of_its_month(spark, places):
    deliver(spark, places[0], (1, "202601"), (2, "202602"))
    assert ingest(spark, places) == [(1, "202601"), (2, "202602")]
    deliver(spark, places[0], (3, "202601"))
    assert ingest(spark, places) == [(1, "202601"), (2, "202602"), (3, "202601")]


def test_a_run_without_new_files_changes_nothing(spark, places):
    deliver(spark, places[0], (1, "202601"))
    first = ingest(spark, places)
    assert ingest(spark, places, lambda df: df.selectExpr("v + 100 AS v", "_ano_mes")) == first


def test_only_touched_months_are_rebuilt(spark, places):
    deliver(spark, places[0], (1, "202601"), (2, "202602"))
    ingest(spark, places)
    deliver(spark, places[0], (3, "202602"))
    rebuilt = ingest(spark, places, lambda df: df.selectExpr("v * 10 AS v", "_ano_mes"))
    assert rebuilt == [(1, "202601"), (20, "202602"), (30, "202602")]


def test_a_failed_batch_is_done_by_the_next_run(spark, places):
    deliver(spark, places[0], (1, "202601"))

    def broken(df):
        raise RuntimeError("boom")

    with pytest.raises(Exception, match="boom"):
        ingest(spark, places, broken)
    assert ingest(spark, places) == [(1, "202601")]

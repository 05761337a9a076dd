import pytest
from pyspark.sql import functions as F

from beneflow.session import shared_folder
from beneflow.sinks.tables import (
    Written,
    bounded_query,
    record_run,
    register_table,
    replace_parts,
    run_history,
)
from beneflow.sources.tables import read_table, schema_report

SCHEMA = "v int, _ano_mes string"


def rows_of(spark, path, **options):
    return sorted(tuple(r) for r in read_table(spark, path, **options).select("v", "_ano_mes").collect())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture
def path(spark):
    return shared_folder(spark, "sink-test")


@pytest.fixture
def two_months(spark, path):
    df = frame(spark, (1, "202601"), (2, "202601"), (3, "202602"))
    assert replace_parts(df, path, ["202601", "202602"]) == Written(3, ["202601", "202602"])
    return path


def test_rewriting_a_month_twice_keeps_it_once(spark, two_months):
    for _ in range(2):
        replace_parts(frame(spark, (9, "202601")), two_months, ["202601"])
    assert rows_of(spark, two_months) == [(3, "202602"), (9, "202601")]


def test_rows_of_another_month_are_refused(spark, two_months):
    before = rows_of(spark, two_months)
    for stray in ("202603", "202602", None):
        with pytest.raises(Exception, match="_ano_mes outside 202601"):
            replace_parts(frame(spark, (7, "202601"), (8, stray)), two_months, ["202601"])
    assert rows_of(spark, two_months) == before


def test_a_stated_month_without_rows_ends_up_empty(spark, two_months):
    written = replace_parts(frame(spark, (5, "202602")), two_months, ["202601", "202602"])
    assert written.rows == 1
    assert rows_of(spark, two_months) == [(5, "202602")]
    replace_parts(frame(spark), two_months, ["202602"])
    assert rows_of(spark, two_months, schema=SCHEMA) == []


def test_months_found_in_the_rows(spark, two_months):
    written = replace_parts(frame(spark, (4, "202602"), (6, "202603")), two_months, cluster=True)
    assert written == Written(2, ["202602", "202603"])
    assert rows_of(spark, two_months) == [(1, "202601"), (2, "202601"), (4, "202602"), (6, "202603")]


def test_month_stays_text_and_prunes_partitions(spark, two_months):
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    try:
        df = read_table(spark, two_months, ["202601"])
        assert dict(df.dtypes)["_ano_mes"] == "string"
        assert [tuple(r) for r in df.sort("v").collect()] == [(1, "202601"), (2, "202601")]
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")


def test_new_column_reads_as_null_in_earlier_months(spark, path):
    replace_parts(frame(spark, (1, "202601")), path, ["202601"])
    wider = frame(spark, (2, "202602")).withColumn("extra", F.lit("x"))
    replace_parts(wider, path, ["202602"])
    rows = read_table(spark, path, merge_schema=True).select("v", "extra", "_ano_mes").sort("v")
    assert [tuple(r) for r in rows.collect()] == [(1, None, "202601"), (2, "x", "202602")]


def test_history_lists_the_latest_runs_first(spark, two_months):
    audit = shared_folder(spark, "audit")
    for i, rows in enumerate([((1, "202601"), (None, "202601")), ((3, "202601"),), ((4, "202602"),)]):
        months = sorted({month for _, month in rows})
        written = replace_parts(frame(spark, *rows), two_months, months)
        record_run(spark, audit, two_months, "t", written, f"run{i}", ["v"])
    history = [tuple(r) for r in run_history(spark, audit, "t", 2).collect()]
    assert history == [
        ("run2", "replace", "202602", "202602", 1, 0), ("run1", "replace", "202601", "202601", 1, 0)
    ]
    assert run_history(spark, audit, "t", 9).collect()[-1]["nulos"] == 1
    assert run_history(spark, audit, "other", 9).count() == 0


def test_a_repeated_run_is_recorded_once(spark, two_months):
    audit = shared_folder(spark, "audit")
    for _ in range(3):
        rows = frame(spark, (1, "202601"), (None, "202601"), (5, "202602"))
        written = replace_parts(rows, two_months, ["202601", "202602"])
        record_run(spark, audit, two_months, "t", written, "run", ["v"])
    assert [tuple(r) for r in run_history(spark, audit, "t", 9).collect()] == [
        ("run", "replace", "202601", "202602", 3, 1)
    ]


def test_a_failed_check_records_nothing(spark, two_months):
    audit = shared_folder(spark, "audit")
    written = replace_parts(frame(spark, (1, "202601")), two_months, ["202601"])
    record_run(spark, audit, two_months, "t", written, "good")
    with pytest.raises(RuntimeError, match="7 expected"):
        record_run(spark, audit, two_months, "t", Written(7, ["202601"]), "bad")
    assert [r["run_ts"] for r in run_history(spark, audit, "t", 9).collect()] == ["good"]


def test_a_name_follows_its_folder_and_columns(spark, two_months):
    other = shared_folder(spark, "sink-test")
    replace_parts(frame(spark, *[(i, "202603") for i in range(9)]), other, ["202603"])
    register_table(spark, "sink_moved", two_months, SCHEMA)
    assert spark.table("sink_moved").count() == 3
    register_table(spark, "sink_moved", other, SCHEMA.replace("v int", "v int, w string"))
    assert spark.table("sink_moved").columns == ["v", "w", "_ano_mes"]
    assert spark.table("sink_moved").count() == 9
    register_table(spark, "sink_moved", two_months, SCHEMA)
    assert {r["_ano_mes"] for r in spark.table("sink_moved").collect()} == {"202601", "202602"}
    spark.sql("DROP TABLE sink_moved")


@pytest.mark.parametrize("inference", ["true", "false"])
def test_part_names_stay_text(spark, path, inference):
    replace_parts(frame(spark, *[(i, "007") for i in range(3)]), path, ["007"])
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", inference)
    try:
        assert rows_of(spark, path, parts=["007"]) == [(0, "007"), (1, "007"), (2, "007")]
        record_run(spark, shared_folder(spark, "audit"), path, "t", Written(3, ["007"]), "run", ["v"])
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")


def test_a_table_without_the_written_rows_fails_the_run(spark, two_months):
    with pytest.raises(RuntimeError, match="5 expected"):
        record_run(spark, shared_folder(spark, "audit"), two_months, "t",
                   Written(5, ["202601"]), "run", ["v"])


def test_registered_table_and_bounded_query(spark, two_months):
    register_table(spark, "sink_test", two_months, SCHEMA)
    register_table(spark, "sink_test", two_months, SCHEMA)
    assert spark.table("sink_test").count() == 3
    top = bounded_query(spark, "SELECT v FROM sink_test", ["v"], 2)
    assert [r[0] for r in top.collect()] == [1, 2]
    spark.sql("DROP TABLE sink_test")
    assert len(rows_of(spark, two_months)) == 3


def test_schema_report_puts_metadata_last(spark):
    df = spark.createDataFrame([], "_a string, b decimal(12,2), c date")
    assert schema_report(df) == [
        ("b", "decimal(12,2)", False), ("c", "date", False), ("_a", "string", True)
    ]


def test_shared_folder_follows_the_session(spark):
    class Conf:
        def get(self, key, default):
            return "s3a://shared/checkpoints/" if key == "spark.checkpoint.dir" else default

    class Context:
        applicationId, master = "app-1", "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    assert shared_folder(Session(), "x").startswith("s3a://shared/checkpoints/app-1/x-")
    Session.conf = type("Unset", (), {"get": lambda self, key, default: default})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(), "x")


def test_run_time_settings_apply_to_an_existing_session(spark):
    from beneflow.session import RUNTIME_SETTINGS, tune

    spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    tune(spark)
    assert {key: spark.conf.get(key) for key in RUNTIME_SETTINGS} == RUNTIME_SETTINGS

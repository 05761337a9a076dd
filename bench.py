"""Headline queries and layer throughput; prints one JSON line.

``BENCH_SF_DIR`` picks the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` how often each
query is timed (the best run counts).
"""

from __future__ import annotations

import json
import os
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from beneflow.operators import layers  # noqa: E402
from beneflow.plans import queries  # noqa: E402
from beneflow.plans.lake import LANDING_SCHEMA  # noqa: E402
from beneflow.session import build_session, shared_folder  # noqa: E402
from beneflow.sinks.tables import replace_parts  # noqa: E402
from beneflow.sources import benefits, deliveries  # noqa: E402

HEADLINE = (
    "bronze_typed", "silver_full", "silver_null_profile", "fat_uf", "fat_especie", "fat_banco",
    "kpis_nacionais", "percentile_exact", "percentile_approx_100", "distinct_counts",
    "share_of_total", "top_state_per_species", "landing_roundtrip_by_uf", "incremental_ingest",
    "synthetic_people", "reconciliation", "lake_kpis",
)
# The delivery is read this many times over, so that a layer's rate is not mostly start-up.
COPIES = 10


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_time(action, runs: int) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def layer_rates(spark, folder: str, runs: int) -> dict[str, int]:
    """Rows per second of the narrow layers: delimited text -> landing -> bronze -> silver -> files."""
    month = "199803"
    base = shared_folder(spark, "bench")
    feed = benefits.landing_feed(spark, folder).drop("_ano_mes")
    deliveries.write_delivery(feed, f"{base}/in", queries.DELIVERY_HEADER)
    delivery = deliveries.read_delivery(spark, f"{base}/in")
    rows = delivery.count() * COPIES
    landing = reduce(lambda a, b: a.union(b), [delivery] * COPIES)

    def land():
        landing.write.mode("overwrite").parquet(f"{base}/landing")

    rates = {"landing": round(rows / best_time(land, runs))}
    schema = LANDING_SCHEMA.replace(", _ano_mes string", "")
    stored = spark.read.schema(schema).parquet(f"{base}/landing")
    bronze = layers.to_bronze(stored, month, "landing", queries.RUN_TS)
    rates["bronze"] = round(
        rows / best_time(lambda: replace_parts(bronze, f"{base}/bronze", [month]), runs)
    )
    stored = spark.read.schema(layers.BRONZE_SCHEMA).parquet(f"{base}/bronze")
    silver = layers.to_silver(stored, queries.RUN_TS)
    rates["silver"] = round(
        rows / best_time(lambda: replace_parts(silver, f"{base}/silver", [month]), runs)
    )
    return rates


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false", spark__sql__shuffle__partitions=str(cpus),
        # The bench tables are small: splits that give every core some of them.
        spark__sql__files__maxPartitionBytes="2m", spark__sql__files__openCostInBytes="64k",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {
        name: best_time(lambda q=queries.QUERIES[name]: run(q(spark, folder)), runs)
        for name in HEADLINE
    }
    rates = layer_rates(spark, folder, runs)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": rates,
        "cores": cpus,
        "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()

"""Session settings the jobs are written for."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# SQL settings that may change at run time; each can be overridden by the caller.
RUNTIME_SETTINGS = {
    # Re-plan each shuffle: coalesce small partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # One read split = one written file in the narrow layers.
    "spark.sql.files.maxPartitionBytes": "128m",
    # Month folders stay text ('202601'), not integers.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Month tables hold few months per task: write them without a sort first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.session.timeZone": "UTC",
}

# Fixed when the session starts.
STATIC_SETTINGS = {
    # One query of many stages compiles dozens of classes; the default of 100 evicts them between
    # queries, and every run of a long-lived session starts cold again.
    "spark.sql.codegen.cache.maxEntries": "4000",
    # Do not record a Python stack for every column expression; it doubles plan-building time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Wide projections and aggregates compile to methods above HotSpot's 8000-byte limit, which
    # would otherwise stay interpreted for the whole job.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


# On a cluster: begin with many shuffle partitions, which are merged at run time as far as they are small.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "10000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A tuned session; ``settings`` use ``__`` for the dots of a setting's name."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sizing = {} if master and master.startswith("local") else CLUSTER_SETTINGS
    options = STATIC_SETTINGS | RUNTIME_SETTINGS | sizing | {k.replace("__", "."): v for k, v in settings.items()}
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files behind; they would stay until the driver collects garbage.

    For tables that are written and read back. A query that is run twice within shuffles twice.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate tables under the cluster's ``spark.checkpoint.dir``.

    Everything one application writes sits below one folder named after it, so it can be
    dropped in one go. A machine-local folder is used only by a local session without the setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if base is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = os.path.join(tempfile.gettempdir(), "beneflow")
    return f"{base.rstrip('/')}/{context.applicationId}/{label}-{uuid.uuid4().hex}"

"""Pick up newly arrived files and rebuild the partitions they touch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from beneflow.sinks.tables import replace_parts
from beneflow.sources.tables import MONTH, read_table

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def on_arrivals(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    rebuild: Callable[[Sequence[str]], None],
    key: str = MONTH,
) -> None:
    """Call ``rebuild`` with the partitions that got files not seen before, then stop.

    Files of any format under ``folder/key=value/`` count; only their listing is streamed, their
    content is not read here. Seen files are remembered in ``checkpoint``. A rebuild that fails is
    repeated by the next run, so it has to replace, not add. Only partition values, a handful per
    delivery, reach the driver.
    """

    def batch_arrived(batch: DataFrame, _batch_id: int) -> None:
        touched = sorted(row[0] for row in batch.distinct().collect())
        if touched:
            rebuild(touched)

    query = (
        spark.readStream.format("binaryFile")
        .schema(f"{FILE_SCHEMA}, {key} string")
        .load(folder)
        .select(key)
        .writeStream.foreachBatch(batch_arrived)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def on_new_files(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    add: Callable[[Sequence[str], int], None],
    key: str = MONTH,
    files_at_a_time: int = 1000,
) -> None:
    """Call ``add`` with the files under ``folder/key=value/`` not seen before and the number of their batch, then stop.

    More than ``files_at_a_time`` files make several batches, one after the other. A batch that fails is
    repeated by the next run under its number and with the same files, so ``add`` has to replace what it
    left under that number.
    """

    def batch_arrived(batch: DataFrame, number: int) -> None:
        files = sorted(row[0] for row in batch.collect())
        if files:
            add(files, number)

    query = (
        spark.readStream.format("binaryFile")
        .schema(f"{FILE_SCHEMA}, {key} string")
        .option("maxFilesPerTrigger", files_at_a_time)
        .load(folder)
        .select("path")
        .writeStream.foreachBatch(batch_arrived)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_arrivals(
    spark: SparkSession,
    landing: str,
    schema: str | T.StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    key: str = MONTH,
) -> None:
    """Keep a target table in step with a landing table.

    Each touched partition is read again as a whole and replaced, so earlier files of the same
    partition are kept, and a batch that runs twice after a failure gives the same table. The work
    runs in the caller's session: a streaming query's own session has adaptive execution off.
    """

    def rebuild(touched: Sequence[str]) -> None:
        whole = read_table(spark, landing, touched, key, schema)
        replace_parts(transform(whole), target, touched, key)

    on_arrivals(spark, landing, checkpoint, rebuild, key)

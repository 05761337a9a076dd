"""Small helpers around ``mapInArrow`` and intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beneflow.llm.words import slices
from beneflow.session import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written below ``spark.checkpoint.dir`` and read back.

    What follows starts from those files: a lost executor costs no earlier stage, and a second use
    costs no second run.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """Tables an operator needs only on its way, in a folder of their own below ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder = spark, shared_folder(spark, label)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """The rows written and read back."""
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self) -> None:
        """Remove them all; what was made from them has to be stored by then."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def by_slice(
    df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, text: str = "text"
) -> DataFrame:
    """``make`` over consecutive parts of each partition, cut by the bytes of their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                if (out := make(part)) is not None:
                    yield out

    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, mask: Callable[[pa.RecordBatch], np.ndarray], text: str = "text") -> DataFrame:
    """Rows for which ``mask`` holds, all their columns as they are."""

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        return part.filter(pa.array(mask(part)))

    return by_slice(df, make, df.schema, text)


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that the table does not have, in either case."""
    taken = {name.lower() for name in df.columns}
    while wish in taken:
        wish += "_"
    return wish


def record_batch(**columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))

"""Reading month-partitioned Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTH = "_ano_mes"


def read_table(
    spark: SparkSession,
    path: str,
    parts: Sequence[str] | None = None,
    key: str = MONTH,
    schema: str | T.StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """A partitioned table, or only the stated partitions of it.

    The partition key is text whatever its values look like. With ``merge_schema`` a column that
    only some partitions have reads as NULL in the others.
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    df = (reader.schema(schema) if schema is not None else reader).parquet(path)
    if not isinstance(df.schema[key].dataType, T.StringType):
        # Values were read as another type: '007' as 7. With the key's type given they stay as they are.
        typed = [T.StructField(key, T.StringType()) if f.name == key else f for f in df.schema.fields]
        df = reader.schema(T.StructType(typed)).parquet(path)
    return df if parts is None else df.filter(F.col(key).isin(*parts))


def schema_report(df: DataFrame) -> list[tuple[str, str, bool]]:
    """(name, type, is lineage metadata) of every column, metadata last."""
    fields = [(f.name, f.dataType.simpleString(), f.name.startswith("_")) for f in df.schema.fields]
    return sorted(fields, key=lambda field: field[2])

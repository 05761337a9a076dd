"""Monthly states that merge: distinct codes as bitmaps, values as quantile sketches.

A state is made once for a month and stored with it. Any coarser question, over months, over states of the
country or over both, is answered from states alone; a month that is delivered again replaces its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Codes are small whole numbers, so a bucket of 32,768 bits holds most columns whole.
LARGEST_CODE = 2_147_483_647
# Buffer of a sketch: a rank is off by about 0.7 % with 99 % confidence.
SKETCH_SIZE = 400


def distinct_state(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, coluna, balde, bits, textos): which values each column has in a group, NULL not counted.

    Values that read as a whole number are bits of a bitmap; any other text is kept as it is, one a row. Rows
    are combined on the map side, so a group's rows never meet.
    """
    pairs = F.inline(F.array(*[
        F.struct(F.lit(c).alias("coluna"), F.col(c).cast("string").alias("valor")) for c in columns
    ]))
    values = df.select(*keys, pairs).where(F.col("valor").isNotNull())
    code = F.col("valor").try_cast("int")
    # '007' is not '7': only the usual way to write a number makes it one.
    is_code = (code >= 0) & code.cast("string").eqNullSafe(F.col("valor"))
    values = values.withColumn("codigo", F.when(is_code, code.cast("bigint")))
    # Bitmaps are built by sorting; a task's rows are first made distinct by hashing, so that what is sorted
    # grows with the values a group has, not with its rows.
    distinct = values.select(
        *keys, "coluna", F.bitmap_bucket_number("codigo").alias("balde"),
        F.when(F.col("codigo").isNull(), F.col("valor")).alias("texto"), F.bitmap_bit_position("codigo").alias("bit"),
    ).distinct()
    return (
        distinct.groupBy(*keys, "coluna", "balde", "texto")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .withColumn("bits", F.when(F.col("texto").isNull(), F.col("bits")))
    )


def distinct_rollup(state: DataFrame, *levels: Sequence[str]) -> DataFrame:
    """(all keys, coluna, distintos): distinct values at each level, a level being the keys it keeps; the others are NULL."""
    keys = list(dict.fromkeys(key for level in levels for key in level))
    levelled = [F.struct(
        F.lit(i).alias("nivel"), *[(F.col(k) if k in level else F.lit(None).cast("string")).alias(k) for k in keys]
    ) for i, level in enumerate(levels)]
    rows = state.select(F.inline(F.array(*levelled)), "coluna", "balde", "texto", "bits")
    # A text is one value; a bucket has as many as bits are set in any of the merged.
    merged = rows.groupBy("nivel", *keys, "coluna", "balde", "texto").agg(
        F.bitmap_count(F.bitmap_or_agg(F.coalesce("bits", F.unhex(F.lit("00"))))).alias("bits")
    )
    counted = F.when(F.col("texto").isNull(), F.col("bits")).otherwise(1).cast("bigint")
    return merged.groupBy("nivel", *keys, "coluna").agg(F.sum(counted).alias("distintos"))


def quantile_state(df: DataFrame, keys: Sequence[str], value: str, size: int = SKETCH_SIZE) -> DataFrame:
    """(keys, resumo): a KLL sketch of a decimal column, in units of its last digit; NULL carries no weight."""
    scale = df.schema[value].dataType.scale
    units = (F.col(value) * 10**scale).cast("bigint")
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.kll_sketch_agg_bigint(units, size).alias("resumo"))


def quantile_rollup(
    state: DataFrame, keys: Sequence[str], probabilities: Mapping[str, float], scale: int = 2, size: int = SKETCH_SIZE
) -> DataFrame:
    """(keys, n, one column a percentile): from sketches merged over whatever the keys leave out."""
    merged = state.groupBy(*keys).agg(F.kll_merge_agg_bigint("resumo", size).alias("resumo"))
    return merged.select(
        *keys, F.kll_sketch_get_n_bigint("resumo").alias("n"),
        *[
            (F.kll_sketch_get_quantile_bigint("resumo", F.lit(float(p))) / F.lit(10**scale)).cast(f"decimal(18,{scale})").alias(name)
            for name, p in probabilities.items()
        ],
    )

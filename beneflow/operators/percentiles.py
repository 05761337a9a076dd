"""Percentiles per group: exact without large per-group state, or a small sketch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bands grow with the value: so many for each doubling. Sixteen digits have 54 doublings to either side,
# so a group has a bounded number of bands, whatever its values are.
BANDS_PER_DOUBLING = 1024
# Where rows are narrowed down first: about one percent of the value a band, and a 256th of that.
COARSE_BANDS, FINE_BANDS = 64, 64 * 256


def _band(units: Column, per_doubling: int = BANDS_PER_DOUBLING) -> Column:
    """Number of a value's band; it never falls as the value grows, and is never NULL (see ``_units``)."""
    size = F.coalesce(F.floor(F.log2(F.abs(units) + F.lit(1)) * per_doubling), F.lit(0))
    return F.when(units < 0, -size).otherwise(size)


def join_on_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which a NULL key matches a NULL key; keys are kept once, from the left."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    matches = reduce(
        lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    )
    return left.join(renamed, matches, how).drop(*[f"_right_{key}" for key in keys])


def _units(value: str, dtype: T.DataType) -> Column:
    """A decimal as a count of its last digit; NULL as 0, which callers give no weight.

    Never being NULL, it gets no NULL filter on just one side of the self-join below, so both
    sides share one scan and shuffle.
    """
    if not isinstance(dtype, T.DecimalType) or dtype.precision > 16:
        raise TypeError(f"{value} must be a decimal of at most 16 digits, got {dtype}")
    return F.coalesce((F.col(value) * 10**dtype.scale).cast("bigint"), F.lit(0))


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """How often each value occurs per group; repeated values collapse before the shuffle."""
    return df.groupBy(*keys, value).agg(F.count(value).alias("n"))


def percentiles_of_counts(
    counts: DataFrame, keys: Sequence[str], value: str, probabilities: Mapping[str, float]
) -> DataFrame:
    """Exact percentiles per group from ``value_counts`` rows at this or any finer grain."""
    return _exact(counts, keys, value, F.sum("n"), probabilities)


def _exact(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: Column,
    probabilities: Mapping[str, float],
) -> DataFrame:
    """The smallest value whose running weight reaches ``ceil(p * total)``, per group.

    NULL values carry no weight; a group of only NULLs has no row.

    A group is never sorted as a whole: the band holding the target rank is found on band totals,
    and only that band's distinct values, within a thousandth of each other, are ordered.
    """
    dtype = df.schema[value].dataType
    # One struct key: NULL fields compare equal in it, and joins, windows and aggregates share it.
    values = (
        df.groupBy(F.struct(*keys).alias("key"), _units(value, dtype).alias("units"))
        .agg(weight.alias("n"))
        .withColumn("band", _band(F.col("units")))
    )

    targets = _target_bands(values.groupBy("key", "band").agg(F.sum("n").alias("band_n")), probabilities)
    return _answers(values.join(targets, ["key", "band"]), keys, dtype, probabilities)


def _target_bands(bands: DataFrame, probabilities: Mapping[str, float]) -> DataFrame:
    """(key, band, name, before, rank): the band that holds each percentile, and the weight before it."""
    group = Window.partitionBy("key")
    by_band = group.orderBy("band").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = bands.withColumns({"upto": F.sum("band_n").over(by_band), "total": F.sum("band_n").over(group)})
    wanted = F.array(*[
        F.struct(
            F.lit(name).alias("name"), F.ceil(F.lit(Decimal(str(p))) * F.col("total")).cast("bigint").alias("rank")
        )
        for name, p in probabilities.items()
    ])
    return (
        running.select("key", "band", (F.col("upto") - F.col("band_n")).alias("before"), "upto", F.inline(wanted))
        .withColumn("rank", F.greatest("rank", F.lit(1)))
        .filter((F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("upto")))
        .drop("upto")
    )


def _answers(
    held: DataFrame, keys: Sequence[str], dtype: T.DecimalType, probabilities: Mapping[str, float]
) -> DataFrame:
    """The first value of a target band at which its running weight reaches the rank."""
    by_value = Window.partitionBy("key", "name").orderBy("units")
    running = F.sum("n").over(
        by_value.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    reached = held.withColumn("reached", F.col("before") + running).filter(F.col("reached") >= F.col("rank"))
    answers = reached.groupBy("key").agg(
        *[F.min(F.when(F.col("name") == name, F.col("units"))).alias(name) for name in probabilities]
    )
    return answers.select(
        *[F.col(f"key.{key}") for key in keys],
        *[
            (F.col(name) / 10**dtype.scale).cast(dtype).alias(name)
            for name in probabilities
        ],
    )


def _narrowed(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Mapping[str, float], most_groups: int
) -> DataFrame:
    """The same values from two scans: rows are counted by coarse bands, which shrinks them before any
    shuffle, and only rows of the bands that hold a target are then counted by value.

    A target band that is wide itself is narrowed again by fine bands, on its value counts. The targets, a row
    for a group and percentile, are broadcast; more than ``most_groups`` groups fail the job.
    """
    dtype = df.schema[value].dataType
    rows = df.filter(F.col(value).isNotNull()).select(F.struct(*keys).alias("key"), _units(value, dtype).alias("units"))
    rows = rows.withColumn("band", _band(F.col("units"), COARSE_BANDS))
    targets = _target_bands(rows.groupBy("key", "band").agg(F.count(F.lit(1)).alias("band_n")), probabilities)
    # The rows of a global window are what is broadcast: as many as the bound allows.
    many = F.count(F.lit(1)).over(Window.partitionBy())
    over = F.raise_error(F.lit(f"more than {most_groups} groups for percentiles of {value}")).cast("bigint")
    targets = targets.withColumn("rank", F.when(many <= most_groups * len(probabilities), F.col("rank")).otherwise(over))
    values = (
        rows.join(F.broadcast(targets.select("key", "band", "rank")), ["key", "band"], "left_semi")
        .groupBy("key", "band", "units").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("fine", _band(F.col("units"), FINE_BANDS))
    )
    fine = values.groupBy("key", "band", "fine").agg(F.sum("n").alias("fine_n")).join(F.broadcast(targets), ["key", "band"])
    by_fine = Window.partitionBy("key", "name").orderBy("fine").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("before") + F.sum("fine_n").over(by_fine)
    inside = (
        fine.withColumn("upto", upto)
        .filter((F.col("upto") - F.col("fine_n") < F.col("rank")) & (F.col("rank") <= F.col("upto")))
        .select("key", "band", "fine", "name", "rank", (F.col("upto") - F.col("fine_n")).alias("before"))
    )
    return _answers(values.join(inside, ["key", "band", "fine"]), keys, dtype, probabilities)


def percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    accuracy: int | None = None,
    most_groups: int | None = None,
) -> DataFrame:
    """``{column: p}`` percentiles per group: exact, or a sketch of the given accuracy.

    Exact ones shuffle every value once, or, where the caller knows how many groups there are at most,
    only values near the targets.
    """
    if accuracy is None and most_groups is not None:
        return _narrowed(df, keys, value, probabilities, most_groups)
    if accuracy is None:
        return _exact(df, keys, value, F.count(value), probabilities)
    return df.groupBy(*keys).agg(
        *[F.percentile_approx(value, p, accuracy).alias(n) for n, p in probabilities.items()]
    )

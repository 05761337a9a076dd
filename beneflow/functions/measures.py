"""Aggregate and window expressions shared by the gold tables and reports."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def rows() -> Column:
    return F.count(F.lit(1))


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, two digits; NULL when the whole is zero."""
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), 2)


def percent_where(predicate: Column) -> Column:
    """Share of rows on which the predicate holds; NULL counts in the denominator only."""
    return percent(F.count_if(predicate), rows())


def distinct_count(column: Column, rsd: float | None = None) -> Column:
    """Exact distinct count, or a sketch with relative error ``rsd`` when one is given."""
    return F.countDistinct(column) if rsd is None else F.approx_count_distinct(column, rsd)


def rank_descending(column: Column, *partition: str) -> Column:
    return F.dense_rank().over(Window.partitionBy(*partition).orderBy(column.desc_nulls_last()))


def percent_of_partition(column: Column, *partition: str) -> Column:
    return percent(column, F.sum(column).over(Window.partitionBy(*partition)))


def exact_mean(total: Column, count: Column) -> Column:
    """``decimal(16,6)`` mean from an already summed total, rounded once (half up)."""
    return F.try_divide(total.cast("decimal(38,2)"), count).cast("decimal(16,6)")

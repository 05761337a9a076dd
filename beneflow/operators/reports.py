"""Reports over silver and gold: totals per key, and rows of a ranked table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from beneflow.operators.ranking import top_ordered, top_ranked


def volume_report(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    order: Sequence[Column] = (),
    k: int | None = None,
) -> DataFrame:
    """Named measures per key; with ``k`` the first rows of a total order over keys and measures."""
    totals = df.groupBy(*keys).agg(*[measure.alias(name) for name, measure in measures.items()])
    return totals if k is None else top_ordered(totals, order, k)


def ranked_report(table: DataFrame, columns: Sequence[str], rank: str, k: int) -> DataFrame:
    """The stated columns of rows ranked ``k`` or better; ties stay."""
    return top_ranked(table, rank, k).select(*columns)

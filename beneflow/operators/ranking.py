"""Top rows: per key by an aggregate, by order, by rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; ``order`` must settle ties."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_position", F.row_number().over(window))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )


def top_state_per_species(state_counts: DataFrame) -> DataFrame:
    """State with most payments per month and species; ties go to the first code, NULL last.

    Takes rows of ``(_ano_mes, especie_codigo, sg_uf, n)``, at any finer grain.
    """
    counts = state_counts.groupBy("_ano_mes", "especie_codigo", "sg_uf").agg(F.sum("n").alias("n"))
    best_first = [F.col("n").desc(), F.col("sg_uf").asc_nulls_last()]
    return top_per_key(counts, ["_ano_mes", "especie_codigo"], best_first).select(
        "_ano_mes", "especie_codigo", F.col("sg_uf").alias("uf_com_mais_beneficios")
    )


def species_with_top_state(state_counts: DataFrame) -> DataFrame:
    """Payments per month and species with the top state joined on.

    A NULL species code matches nothing, so its top state is NULL. Both sides are aggregates, a
    row per month and species; the optimizer broadcasts the right one when it is small.
    """
    totals = state_counts.groupBy("_ano_mes", "especie_codigo").agg(F.sum("n").alias("qtd"))
    return totals.join(
        top_state_per_species(state_counts), ["_ano_mes", "especie_codigo"], "left"
    )


def top_ordered(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of a total order (a top-k plan, no full sort)."""
    return df.orderBy(*order).limit(k)


def top_ranked(df: DataFrame, rank: str, k: int) -> DataFrame:
    """Rows whose rank is at most ``k``; ties stay."""
    return df.filter(F.col(rank) <= k)

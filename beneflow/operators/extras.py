"""Columns beyond the contract as one VARIANT column, typed when they are read.

A table keeps its columns whatever a delivery adds. A row holds only what its delivery had, as the text it
was; a column that a delivery lacks, an empty field and a text of another type all read as NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beneflow.functions import parsing

EXTRAS = "_extras"
MONEY, DAY = "money", "day"


def pack_extras(df: DataFrame, names: Sequence[str], column: str = EXTRAS) -> DataFrame:
    """Put text columns, NULLs left out, into one VARIANT object; also where there are none."""
    texts = F.map_from_arrays(
        F.array(*[F.lit(name) for name in names]).cast("array<string>"),
        F.array(*[parsing.named(name) for name in names]).cast("array<string>"),
    )
    packed = F.to_variant_object(F.map_filter(texts, lambda _, text: text.isNotNull()))
    kept = [parsing.named(name) for name in df.columns if name not in names]
    return df.select(*kept, packed.alias(column))


def _path(name: str) -> str:
    quote = "'" if "'" not in name else '"'
    if quote in name:
        raise ValueError(f"a name with both kinds of quotes cannot be looked up: {name}")
    return f"$[{quote}{name}{quote}]"


def extra(name: str, kind: str = "string", column: str = EXTRAS) -> Column:
    """A packed column as a type of Spark, or as ``money`` (1.621,00) or a ``day`` of the contract; NULL where it has none."""
    text = F.trim(F.try_variant_get(F.col(column), _path(name), "string"))
    if kind == MONEY:
        return parsing.money(text)
    return parsing.day(text) if kind == DAY else text.try_cast(kind)


def with_extras(df: DataFrame, kinds: Mapping[str, str], column: str = EXTRAS) -> DataFrame:
    """The table with some packed columns as typed ones, in place of the VARIANT."""
    return df.withColumns({name: extra(name, kind, column) for name, kind in kinds.items()}).drop(column)

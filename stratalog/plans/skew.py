"""Joins of rows with a table of unique keys, where a few keys may own most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_join(rows: DataFrame, table: DataFrame, key: str, weight: str, share: float = 0.001, how: str = "inner") -> DataFrame:
    """`rows` with the columns of `table` (unique `key`, `weight` = rows that have the key) joined on `key`.

    Keys above `share` of the summed weight, at most 1 / share of them, are joined by a broadcast that this bounds; their
    rows are never shuffled. The other keys meet by a shuffle. how: inner, or left. A null key meets nothing.
    """
    total = (table.agg(F.sum(weight).alias("n")).first() or {"n": 0})["n"] or 0
    least = int(total * share) + 1
    values = [c for c in table.columns if c not in (key, weight)]
    hot = F.broadcast(table.where(F.col(weight) > least).select(F.col(key).alias("_hot"), F.struct(*[F.col(c) for c in values], F.lit(1)).alias("_value")))
    cold = table.where(F.col(weight) <= least).select(key, *values)
    split = rows.join(hot, F.col(key) == F.col("_hot"), "left")
    of_hot = split.where("_hot IS NOT NULL").select(*rows.columns, *[F.col(f"_value.{c}").alias(c) for c in values])
    return of_hot.unionByName(split.where("_hot IS NULL").select(*rows.columns).join(cold, key, how).select(*rows.columns, *values))

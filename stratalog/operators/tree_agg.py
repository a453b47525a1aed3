"""Per-key aggregation through a tree of merges, for keys that hold most of the rows (problem 4).

Level 0 combines fixed-size chunks of the input where they lie: the chunk's number is part of the grouping key, so
Spark's map-side aggregation leaves one state per (key, chunk) before anything is shuffled. Each further level
merges the states of `fan_in` neighbouring chunks. No task ever receives more than `fan_in` states of a key from
one level, however many rows the key has; the last level has one state per key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def tree_aggregate(
    df: DataFrame,
    keys: list[str],
    sums: dict[str, Column],
    chunk_rows: int = 1 << 16,
    fan_in: int = 32,
) -> DataFrame:
    """One row per distinct `keys` (null is a key) with the exact totals `sums` (name -> bigint expression).

    Nulls in an expression count as 0. Repeated rows count as often as they stand. An empty table gives no rows.
    Other columns, whatever their names, are not read. chunk_rows: rows combined at level 0; fan_in: states merged per level.
    """
    kk = [f"_k{i}" for i in range(len(keys))]
    vv = [f"_v{i}" for i in range(len(sums))]
    rid = F.monotonically_increasing_id()
    # How many partitions and chunks there are: a scan without columns.
    shape = df.select(rid.alias("r")).agg(
        F.max(F.shiftright("r", _ROW_BITS)).alias("p"),
        F.max(F.floor(F.col("r").bitwiseAND((1 << _ROW_BITS) - 1) / chunk_rows)).alias("c"),
    ).first()
    parts, chunks = (shape["p"] or 0) + 1, int(shape["c"] or 0) + 1
    leaf = F.shiftright(F.col("_r"), _ROW_BITS) * F.lit(chunks) + F.least(
        F.floor(F.col("_r").bitwiseAND((1 << _ROW_BITS) - 1) / chunk_rows).cast("long"), F.lit(chunks - 1)
    )
    state = df.select(
        *[F.col(k).alias(a) for k, a in zip(keys, kk)],
        *[F.coalesce(e.cast("long"), F.lit(0).cast("long")).alias(a) for e, a in zip(sums.values(), vv)],
        rid.alias("_r"),
    ).withColumn("_node", leaf)
    state = state.groupBy(*kk, "_node").agg(*[F.sum(v).alias(v) for v in vv])
    for _ in range(max(0, math.ceil(math.log(max(parts * chunks, 1), fan_in)) - 1)):
        state = state.groupBy(*kk, F.floor(F.col("_node") / fan_in).alias("_node")).agg(*[F.sum(v).alias(v) for v in vv])
    state = state.groupBy(*kk).agg(*[F.sum(v).alias(v) for v in vv])
    return state.select(*[F.col(a).alias(k) for k, a in zip(keys, kk)], *[F.col(a).alias(n) for n, a in zip(sums, vv)])

"""Ranks and running sums over a total order, without a single-task window.

The rows are range-sorted, every range partition computes its own running sum, and the sums of the earlier
partitions are added. Only one row per (partition, group) is gathered for that, and a group's rows may spread
over any number of partitions, so a hot group costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalog.plans.lineage import written


def running_sum(df: DataFrame, groups: list[str], order: list[str], value: str | list[str], out: str | list[str], partitions: int | None = None) -> DataFrame:
    """Adds `out`: the sum of `value` over the rows of the same `groups` up to and including this one in `order`.

    `order` must make rows unique within a group for a defined result. A null value counts as 0. The range-sorted
    rows are written once, so that the second pass sees the same partitions as the first. Several values are summed in
    one pass, each into its own column.
    """
    spark = df.sparkSession
    values, outs = [value] if isinstance(value, str) else value, [out] if isinstance(out, str) else out
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = df.repartitionByRange(n, *groups, *order).withColumn("_rs_pid", F.spark_partition_id())
    laid = written(laid, "running-sum")
    local = Window.partitionBy("_rs_pid", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = [F.coalesce(F.col(v), F.lit(0)) for v in values]
    sums = laid.groupBy("_rs_pid", *groups).agg(*[F.sum(v).alias(f"_rs_sum{i}") for i, v in enumerate(filled)])
    # One row per (partition, group): at most partitions + groups rows, as each partition holds a contiguous range.
    before = Window.partitionBy(*groups).orderBy("_rs_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("*", *[F.coalesce(F.sum(f"_rs_sum{i}").over(before), F.lit(0)).alias(f"_rs_off{i}") for i in range(len(values))])
    o = offsets.select(F.col("_rs_pid").alias("_o_pid"), *[F.col(g).alias(f"_o_{g}") for g in groups], *[f"_rs_off{i}" for i in range(len(values))])
    on = F.col("_rs_pid") == F.col("_o_pid")
    for g in groups:
        on = on & F.col(g).eqNullSafe(F.col(f"_o_{g}"))
    summed = laid.select("*", *[F.sum(v).over(local).alias(name) for v, name in zip(filled, outs)])
    return summed.join(o, on).select(*df.columns, *[(F.col(name) + F.col(f"_rs_off{i}")).alias(name) for i, name in enumerate(outs)])

"""Spreading rows over all cores before work that costs much per row."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str, per_core: int = 3) -> DataFrame:
    """`df` hash-partitioned by `keys` (unique or nearly so) into `per_core` partitions per core, or more if configured.

    Compressed text tables come in few file splits; Python work on them would leave most cores idle.
    """
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism * per_core, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *keys)

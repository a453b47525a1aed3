"""Cutting lineage through storage that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Where it is unset, a local session (tests) gets a temporary folder; on a cluster that folder would be another one on
    every machine, so the call fails there.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(named)
        return named
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    if not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="stratalog-"))
    return sc._jsc.sc().getCheckpointDir().get()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """`df` written as a Parquet table in the shared folder and read again."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    schema = df.schema
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    back = spark.read.schema(schema).parquet(path)
    back._written_at = path
    return back


def discard(*tables: DataFrame | None) -> None:
    """Deletes tables made by `written` that no later plan reads, such as those of earlier rounds of a loop."""
    for t in tables:
        path = getattr(t, "_written_at", None)
        if path:
            remove(t.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder or file of the shared storage."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)

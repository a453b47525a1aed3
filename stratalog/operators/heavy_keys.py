"""Queries of problem 4: keys that hold most records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.operators.tree_agg import tree_aggregate
from stratalog.plans.lineage import written
from stratalog.sources.tables import table


def per_repo(idx: DataFrame, chunk_rows: int = 1 << 16, fan_in: int = 32) -> DataFrame:
    """repo, n_rows, n_bytes: exact for every repo of the batch index, null repo included."""
    return tree_aggregate(idx, ["repo"], {"n_rows": F.lit(1), "n_bytes": F.col("storedlen")}, chunk_rows, fan_in)


def heavy(idx: DataFrame, share: float = 0.02, **tree: int) -> DataFrame:
    """measure, repo: non-null repos with at least `share` of all rows, or of all bytes.

    A measure whose total is 0 has no heavy repo.
    """
    per = written(per_repo(idx, **tree), "per-repo")
    total = per.agg(F.sum("n_rows").alias("r"), F.sum("n_bytes").alias("b")).first()  # two numbers
    rows, size = total["r"] or 0, total["b"] or 0
    tests = [("rows", "n_rows", rows), ("bytes", "n_bytes", size)]
    tagged = per.where(F.col("repo").isNotNull()).select(
        "repo",
        F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), ((F.col(c) >= F.lit(share) * t) & F.lit(t > 0)).alias("hit")) for m, c, t in tests])).alias("x"),
    )
    return tagged.where("x.hit").select("x.measure", "repo")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavy(table(spark, sf_dir, "idx"))


def p4_per_repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_repo(table(spark, sf_dir, "idx"))


QUERIES = {"p4_found": p4_found, "p4_per_repo": p4_per_repo}

SQL = {
    "p4_found": """
        WITH t AS (SELECT repo, count(*) AS r, sum(coalesce(storedlen, 0)) AS b FROM idx GROUP BY repo),
             s AS (SELECT sum(r) AS r, sum(b) AS b FROM t)
        SELECT 'rows' AS measure, t.repo FROM t, s WHERE t.repo IS NOT NULL AND t.r >= 0.02 * s.r
        UNION ALL
        SELECT 'bytes' AS measure, t.repo FROM t, s WHERE t.repo IS NOT NULL AND t.b >= 0.02 * s.b AND s.b > 0""",
    "p4_per_repo": "SELECT repo, count(*) AS n_rows, CAST(sum(coalesce(storedlen, 0)) AS BIGINT) AS n_bytes FROM idx GROUP BY repo",
}

"""The relations of the data model, built from the provided tables.

commits: orders; the first parent is the customer's previous order by key, a second parent (merge) is key div 2 for
keys that 7 divides. Trees: lineitem, one entry per line number. Both parents have smaller keys, so the graph has no
cycles. Objects: documents, addressed by the hash of their content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalog.sources.tables import table


def commits(spark: SparkSession, d: str) -> DataFrame:
    """oid, project, time, subject."""
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("oid"), F.col("o_custkey").alias("project"), F.col("o_orderdate").alias("time"), F.col("o_orderpriority").alias("subject"))


def parents(spark: SparkSession, d: str) -> DataFrame:
    """oid, pos, parent: the edges of the commit graph."""
    c = commits(spark, d).select("oid", "project")
    first = c.select("oid", F.lit(0).alias("pos"), F.lag("oid").over(Window.partitionBy("project").orderBy("oid")).alias("parent")).where("parent IS NOT NULL")
    keys = c.select(F.col("oid").alias("parent"))
    merge = c.where("oid % 7 = 0").select("oid", F.lit(1).alias("pos"), F.expr("oid div 2").alias("parent")).where("parent < oid").join(keys, "parent", "left_semi").select("oid", "pos", "parent")
    return first.unionByName(merge)


def edges(spark: SparkSession, d: str) -> DataFrame:
    return parents(spark, d).select("oid", "parent").distinct()


def heads(spark: SparkSession, d: str) -> DataFrame:
    """project, head: each project's newest commit by key."""
    return commits(spark, d).groupBy("project").agg(F.max("oid").alias("head"))


def head_pairs(spark: SparkSession, d: str) -> DataFrame:
    """a, b: each project's head and the newest head of the customers of its nation."""
    h = heads(spark, d).join(table(spark, d, "customer").select(F.col("c_custkey").alias("project"), F.col("c_nationkey").alias("nation")), "project")
    top = h.groupBy("nation").agg(F.max("head").alias("b"))
    return h.join(top, "nation").where("head <> b").select(F.col("head").alias("a"), "b")


def tree_entries(spark: SparkSession, d: str) -> DataFrame:
    """tree, name, oid, mode (octal text): one row per entry. 100644 plain file, 100755 executable, 040000 directory."""
    li = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("tree"), F.col("l_linenumber").alias("name")).agg(F.min("l_partkey").alias("oid"), F.min("l_returnflag").alias("m"))
    return li.select("tree", "name", "oid", F.when(F.col("m") == "A", "040000").when(F.col("m") == "N", "100644").otherwise("100755").alias("mode"))


def blob_oid(text: Column) -> Column:
    """The object id of a blob with this text: the hash of its kind, length and bytes."""
    body = F.encode(text, "utf-8")
    return F.sha1(F.concat(F.encode(F.concat(F.lit("blob "), F.octet_length(body).cast("string")), "utf-8"), F.unhex(F.lit("00")), body))


def valid_sha(c: Column) -> Column:
    return c.rlike(r"\A[0-9a-f]{40}\z")


def section(hex_oid: Column) -> Column:
    """Shard of an object id: its first byte and 127."""
    return F.conv(F.substring(hex_oid, 1, 2), 16, 10).cast("int").bitwiseAND(127)


#: The same relations for DuckDB.
SQL_MODEL = {
    "commits": "commits AS (SELECT o_orderkey AS oid, o_custkey AS project, o_orderdate AS time, o_orderpriority AS subject FROM orders)",
    "parents": """parents AS (SELECT oid, 0 AS pos, parent FROM (SELECT oid, lag(oid) OVER (PARTITION BY project ORDER BY oid) AS parent FROM commits) WHERE parent IS NOT NULL
        UNION ALL SELECT c.oid, 1, p.oid FROM commits c JOIN commits p ON p.oid = c.oid // 2 WHERE c.oid % 7 = 0 AND p.oid < c.oid)""",
    "edges": "edges AS (SELECT DISTINCT oid, parent FROM parents)",
    "heads": "heads AS (SELECT project, max(oid) AS head FROM commits GROUP BY project)",
    "pairs": "pairs AS (SELECT h.head AS a, t.b FROM heads h JOIN customer c ON c.c_custkey = h.project JOIN (SELECT c_nationkey, max(head) AS b FROM heads JOIN customer ON c_custkey = project GROUP BY 1) t ON t.c_nationkey = c.c_nationkey WHERE h.head <> t.b)",
    "entries": """entries AS (SELECT l_orderkey AS tree, l_linenumber AS name, min(l_partkey) AS oid,
        CASE min(l_returnflag) WHEN 'A' THEN '040000' WHEN 'N' THEN '100644' ELSE '100755' END AS mode FROM lineitem GROUP BY 1, 2)""",
    "closure": "closure AS (SELECT head AS root, head AS oid FROM (SELECT head FROM heads) UNION SELECT c.root, e.parent FROM closure c JOIN edges e ON e.oid = c.oid)",
    "full": "closure AS (SELECT oid AS root, oid FROM commits UNION SELECT c.root, e.parent FROM closure c JOIN edges e ON e.oid = c.oid)",
}


def with_sql(names: str, rest: str) -> str:
    """WITH RECURSIVE over the named relations, then the query."""
    return "WITH RECURSIVE " + ", ".join(SQL_MODEL[n] for n in names.split()) + " " + rest

"""Recursive comparison of folder trees that only descends into folders that differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalog.plans.lineage import written
from stratalog.sources.tables import table


def hashed_tree(files: DataFrame) -> DataFrame:
    """snap, folder, name, is_dir, oid: entries of all folders; a folder's oid is the hash of its ordered entries.

    files: snap, path, oid, one row per path. The root folder is ''. A name may be a file and a folder at once. Folders
    are hashed from the deepest level up, a join-free aggregation per level.
    """
    split = files.select("snap", F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise("").alias("folder"), F.substring_index("path", "/", -1).alias("name"), F.lit(False).alias("is_dir"), "oid")
    level = F.when(F.col("folder") == "", 0).otherwise(F.size(F.split("folder", "/")))
    split = written(split.withColumn("lv", level), "files")
    deepest = split.agg(F.max("lv")).first()[0] or 0
    out = []
    above = None
    for lv in range(deepest, -1, -1):
        here = split.where(F.col("lv") == lv).select("snap", "folder", "name", "is_dir", "oid")
        if above is not None:
            here = here.unionByName(above)
        here = written(here, "level")
        out.append(here)
        g = here.groupBy("snap", "folder").agg(F.array_sort(F.collect_list(F.struct("name", "is_dir", "oid"))).alias("e"))
        text = F.array_join(F.transform("e", lambda x: F.concat_ws(" ", x["name"], x["is_dir"].cast("string"), x["oid"])), "\n")
        parent = F.when(F.col("folder").contains("/"), F.regexp_replace("folder", "/[^/]*$", "")).otherwise("")
        above = g.where("folder <> ''").select("snap", parent.alias("folder"), F.substring_index("folder", "/", -1).alias("name"), F.lit(True).alias("is_dir"), F.sha1(text.cast("binary")).alias("oid"))
    return reduce(DataFrame.unionByName, out)


def pruned_diff(pairs: DataFrame, tree: DataFrame) -> DataFrame:
    """old, new, path, old_oid, new_oid: files that differ between the snapshots of each pair.

    Level by level, entries of the folders under comparison meet in a full outer join; only folders whose hashes differ
    are taken to the next level, so equal subtrees are never read further.
    """
    todo = pairs.select("old", "new", F.lit("").alias("folder"))
    found = []
    while True:
        a = todo.join(tree, (F.col("snap") == F.col("old")) & (todo["folder"] == tree["folder"])).select("old", "new", todo["folder"], "name", "is_dir", F.col("oid").alias("old_oid"))
        b = todo.join(tree, (F.col("snap") == F.col("new")) & (todo["folder"] == tree["folder"])).select("old", "new", todo["folder"], "name", "is_dir", F.col("oid").alias("new_oid"))
        j = a.join(b, ["old", "new", "folder", "name", "is_dir"], "full_outer").where(~F.col("old_oid").eqNullSafe(F.col("new_oid")))
        path = F.when(F.col("folder") == "", F.col("name")).otherwise(F.concat_ws("/", "folder", "name"))
        j = written(j.withColumn("path", path), "differing")
        found.append(j.where("NOT is_dir").select("old", "new", "path", "old_oid", "new_oid"))
        todo = j.where("is_dir").select("old", "new", F.col("path").alias("folder"))
        if todo.isEmpty():
            return reduce(DataFrame.unionByName, found)


def _snapshots(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    files = table(s, d, "olist").where("path IS NOT NULL AND sha IS NOT NULL AND list_id IS NOT NULL AND path <> ''").groupBy(F.col("list_id").alias("snap"), "path").agg(F.min("sha").alias("oid"))
    w = Window.partitionBy("repo").orderBy("batch", "list_id")
    pairs = table(s, d, "p2cd").where("repo IS NOT NULL").select(F.lag("list_id").over(w).alias("old"), F.col("list_id").alias("new")).where("old IS NOT NULL")
    return files, pairs


def listing_diff(s: SparkSession, d: str) -> DataFrame:
    """Files that differ between consecutive listings of a repository."""
    files, pairs = _snapshots(s, d)
    used = pairs.select(F.explode(F.array("old", "new")).alias("snap")).distinct()
    return pruned_diff(pairs, written(hashed_tree(files.join(used, "snap", "left_semi")), "trees"))


def tree_walk(s: SparkSession, d: str) -> DataFrame:
    """snap, folders, files: entries met on a walk through each listing's tree."""
    files, _ = _snapshots(s, d)
    t = hashed_tree(files)
    return t.groupBy("snap").agg(F.sum(F.col("is_dir").cast("long")).alias("folders"), F.sum((~F.col("is_dir")).cast("long")).alias("files"))


QUERIES = {"listing_diff_pruned": listing_diff, "tree_walk": tree_walk}
_F = "WITH f AS (SELECT list_id AS snap, path, min(sha) AS oid FROM olist WHERE path IS NOT NULL AND path <> '' AND sha IS NOT NULL AND list_id IS NOT NULL GROUP BY ALL)"
SQL = {
    "listing_diff_pruned": _F + ", p AS (SELECT * FROM (SELECT lag(list_id) OVER (PARTITION BY repo ORDER BY batch, list_id) AS old, list_id AS new FROM p2cd WHERE repo IS NOT NULL) WHERE old IS NOT NULL), a AS (SELECT p.old, p.new, f.path, f.oid FROM p JOIN f ON f.snap = p.old), b AS (SELECT p.old, p.new, f.path, f.oid FROM p JOIN f ON f.snap = p.new) SELECT coalesce(a.old, b.old) AS old, coalesce(a.new, b.new) AS new, coalesce(a.path, b.path) AS path, a.oid AS old_oid, b.oid AS new_oid FROM a FULL JOIN b ON a.old = b.old AND a.new = b.new AND a.path = b.path WHERE a.oid IS DISTINCT FROM b.oid",
    "tree_walk": _F + ", d AS (SELECT DISTINCT snap, array_to_string(string_split(path, '/')[1:i], '/') AS folder FROM f, range(1, 100) t(i) WHERE i < len(string_split(path, '/'))), n AS (SELECT snap, count(*) AS folders FROM d GROUP BY snap) SELECT f.snap, coalesce(any_value(n.folders), 0) AS folders, count(*) AS files FROM f LEFT JOIN n ON n.snap = f.snap GROUP BY f.snap",
}

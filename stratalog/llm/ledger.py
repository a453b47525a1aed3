"""Duplicates hidden by formatting differences: an incremental ledger of canonical keys (problem 1).

The ledger holds one row per canonical key: bucket, key, number of copies, earliest representative. A new batch is
aggregated first (map-side combined, so a key with a third of the rows is no burden), then full-outer-joined with the
ledger's matching buckets only; other buckets keep the version they had. Counts add up, the earliest row stays. The
batch's own rows then meet its part of the ledger, which tells each further copy and its representative. The ledger is
stored with a manifest, so that a later session goes on with the next batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.plans import manifest
from stratalog.plans.lineage import discard, fresh_path, written
from stratalog.plans.skew import keyed_join
from stratalog.sources.tables import table

# ------------------------------------------------------------------------------------------------- canonical addresses

#: The home forge, and characters that may surround an address.
HOME = "hub.example"
AROUND = r"""[\s\p{Z}\p{Cc}\p{Cf}"'`<>\[\](){}|,;:!/\\«»‘-‟]+"""
#: A full stop counts as surrounding only at the end, where no name has one.
ENDING = AROUND.replace(r"[\s", r"[.\s", 1) + "$"


def _let(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c) with c evaluated once, however often f uses it."""
    return F.transform(F.array(c), f)[0]


def _bare(c: Column) -> Column:
    """Without format characters, percent-escapes, letter case, and what surrounds the value."""
    return _let(F.regexp_replace(c, r"[\p{Cf}]", ""), _bare_of)


def _bare_of(c: Column) -> Column:
    escaped = F.regexp_replace(F.regexp_replace(c, r"\+", "%2B"), r"%(?![0-9A-Fa-f]{2})", "%25")
    c = F.when(c.contains("%"), F.coalesce(F.try_url_decode(escaped), c)).otherwise(c)
    c = F.lower(c)
    return F.regexp_replace(F.regexp_replace(c, "^" + AROUND, ""), ENDING, "")


def _field(c: Column, name: str) -> Column:
    return F.regexp_extract(c, rf"(?:^|[?&;,|\s\p{{Z}}]){name}[\s\p{{Z}}]*[=:][\s\p{{Z}}]*([^?&;,|\s\p{{Z}}]+)", 1)


def _path(c: Column) -> Column:
    """Slashes collapsed, `.git` and slashes dropped at the end, parts of `host/owner/repo` as they are."""
    c = F.regexp_replace(c, r"[\s\p{Z}]+", "")
    c = F.regexp_replace(c, r"/+", "/")
    return F.regexp_replace(F.regexp_replace(c, r"(?:/|\.git)+$", ""), r"^/+", "")


def _named(c: Column, host: Column) -> Column:
    """host/owner/repo from an address's own fields, or null where owner or repo is missing."""
    return _let(
        F.struct(_path(_field(c, "owner")).alias("o"), _path(_field(c, "repo")).alias("r"), F.when(host == "", F.lit(HOME)).otherwise(host).alias("h")),
        lambda x: F.when((x["o"] != "") & (x["r"] != ""), F.concat_ws("/", x["h"], x["o"], x["r"])),
    )


def canonical_url(c: Column) -> Column:
    """`host/owner/repository-path` of an upstream address, whatever its scheme, user, case, escapes or surroundings."""
    v = _bare(c)
    v = F.regexp_replace(v, r"^[a-z][a-z0-9+.-]*:/+", "")
    v = F.regexp_replace(v, r"^[^/@?]*@", "")
    return _let(F.regexp_replace(v, r"^([^/:?]+):(?:\d+/)?/*", "$1/"), _url_of)


def _url_of(v: Column) -> Column:
    host = F.regexp_extract(v, r"^([^/?]+)", 1)
    plain = _path(F.regexp_replace(v, r"[?#].*$", ""))
    return F.coalesce(_named(F.when(v.contains("?"), F.regexp_replace(v, r"^[^?]*", "")).otherwise(F.lit("")), host), plain)


def canonical_project(c: Column) -> Column:
    """`host/owner/repository-path` of a project name; without a host the home forge is meant.

    A first part with a dot is a host, as owners hold neither `_` nor `.` and hosts no `_`. Fields (`owner=`, `repo:` …)
    may stand in any order with any separator.
    """
    v = F.regexp_replace(F.regexp_replace(_bare(c), r"^[a-z][a-z0-9+.-]*:/+", ""), r"^[^/@?_=]*@", "")
    return _let(v, _project_of)


def _project_of(v: Column) -> Column:
    host = _field(v, "host")
    v1 = F.regexp_replace(_path(v), r"^([^/_:]+\.[^/_:]+):", "$1/")
    return F.coalesce(_named(v, host), _let(F.regexp_replace(v1, r"^([^/_]+)[/_]+", "$1/"), _placed))


def _placed(two: Column) -> Column:
    return F.when(F.regexp_extract(two, r"^([^/]+)/", 1).contains("."), F.regexp_replace(two, r"^([^/]+/[^/_]+)[/_]+", "$1/")).otherwise(F.concat(F.lit(HOME + "/"), two))


# ----------------------------------------------------------------------------------------------------------- the ledger

BOOKS = "key string, n long, first_id long, fresh long, bucket int"


class Ledger:
    """Counts per canonical key in buckets, stored below `root`; a root that holds a ledger is opened and goes on.

    Every batch writes one folder with new versions of the buckets that it touches. The manifest says for each bucket
    which folder holds its current version; it is committed after the files, so a lost driver leaves the last state.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, buckets: int = 64) -> None:
        self.spark, self.root = spark, root or fresh_path(spark, "ledger")
        self.version, kept = manifest.load(spark, self.root)
        self.buckets = kept["buckets"] if kept else buckets
        self.place: dict[int, str] = {int(b): at for b, at in kept["place"].items()} if kept else {}

    def add(self, batch: DataFrame) -> DataFrame:
        """Adds a batch (key string, id bigint); ids grow with arrival. Rows with a null key or id are left out.

        Returns the batch's part of the ledger: key, n, first_id, fresh (rows of the batch that have the key).
        """
        new = (
            batch.where(F.col("key").isNotNull() & F.col("id").isNotNull())
            .groupBy("key")
            .agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
            .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int"))
        )
        new = written(new, "ledger-batch")
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most `buckets`
        if not touched:
            return self.spark.createDataFrame([], BOOKS).drop("bucket")
        old = self._read([b for b in touched if b in self.place])
        if old is None:
            merged = new.select("key", "n", "first_id", F.col("n").alias("fresh"), "bucket")
        else:
            a, b = old.alias("a"), new.alias("b")
            merged = a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.key") == F.col("b.key")), "full_outer").select(
                F.coalesce("a.key", "b.key").alias("key"),
                (F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))).alias("n"),
                F.least("a.first_id", "b.first_id").alias("first_id"),
                F.coalesce("b.n", F.lit(0)).alias("fresh"),
                F.coalesce("a.bucket", "b.bucket").alias("bucket"),
            )
        path = f"{self.root}/batch-{self.version + 1}"
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        discard(new)
        self.version += 1
        self.place |= dict.fromkeys(touched, path)
        manifest.commit(self.spark, self.root, self.version, {"buckets": self.buckets, "place": self.place})
        return self._read(touched).where("fresh > 0").select("key", "n", "first_id", "fresh")

    def _read(self, buckets: list[int]) -> DataFrame | None:
        by: dict[str, list[int]] = {}
        for b in buckets:
            by.setdefault(self.place[b], []).append(b)
        out = None
        for path, bs in by.items():  # as many folders as batches whose buckets no later batch has touched
            part = self.spark.read.schema(BOOKS).parquet(path).where(F.col("bucket").isin(bs))
            out = part if out is None else out.unionByName(part)
        return out

    def table(self) -> DataFrame:
        """key, n, first_id: the ledger as it stands."""
        got = self._read(list(self.place))
        return (self.spark.createDataFrame([], BOOKS) if got is None else got).select("key", "n", "first_id")


def copies(batch: DataFrame, books: DataFrame) -> DataFrame:
    """keep_id, dup_id: each row of `batch` (key, id) that is not the earliest of its key, by what `add` returned for it.

    Keys with more than a thousandth of the batch's rows are joined by a broadcast that this bounds; no reducer receives
    their rows. The other keys are joined by a shuffle.
    """
    rows = batch.where(F.col("key").isNotNull() & F.col("id").isNotNull()).select("key", "id")
    met = keyed_join(rows, books.where("n > 1").select("key", "first_id", "fresh"), "key", "fresh")
    return met.where("id <> first_id").select(F.col("first_id").alias("keep_id"), F.col("id").alias("dup_id"))


def batches_of(rows: DataFrame, batches: int) -> list[DataFrame]:
    """`rows` (key, id) as consecutive batches of ids, stored apart so that each batch reads only its own rows."""
    span = rows.agg(F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    if span["lo"] is None:
        return []
    width = (span["hi"] - span["lo"]) // batches + 1
    no = F.floor((F.col("id") - F.lit(span["lo"])) / F.lit(width)).cast("int")
    laid = written(rows.where("id IS NOT NULL").select("key", "id", no.alias("batch")), "canonical", "batch")
    return [laid.where(F.col("batch") == b).select("key", "id") for b in range(batches)]


def fold(rows: DataFrame, batches: int = 4, ledger: Ledger | None = None) -> tuple[Ledger, DataFrame]:
    """A ledger with `rows` (key, id) taken in as consecutive batches of ids, and the copies that the batches had.

    Equal results for any number of batches, as the earliest row of a key never comes in a later batch. A batch reads
    and writes only the buckets of its own keys; rows of earlier batches are not read again.
    """
    spark = rows.sparkSession
    ledger = ledger or Ledger(spark)
    found = spark.createDataFrame([], "keep_id long, dup_id long")
    for batch in batches_of(rows, batches):
        found = found.unionByName(copies(batch, ledger.add(batch)))
    return ledger, found


def tip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key (project and commit), id of p2tips. The commit is compared without letter case and blanks."""
    sha = F.lower(F.trim("commit_sha"))
    return table(spark, sf_dir, "p2tips").select(F.concat(canonical_project(F.col("p")), F.lit(" "), sha).alias("key"), F.col("tip_id").alias("id"))


def url_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key (address), id of urls."""
    return table(spark, sf_dir, "urls").select(canonical_url(F.col("url")).alias("key"), F.col("url_id").alias("id"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every further copy with its group's earliest row, in both tables; rows with a null in the key are no case."""
    out = None
    for name, rows in (("p2tips", tip_rows(spark, sf_dir)), ("urls", url_rows(spark, sf_dir))):
        part = fold(rows)[1].select(F.lit(name).alias("tbl"), "keep_id", "dup_id")
        out = part if out is None else out.unionByName(part)
    return out


def p1_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tbl, key, n_copies, first_id: one record per group and its number of copies."""
    out = None
    for name, rows in (("p2tips", tip_rows(spark, sf_dir)), ("urls", url_rows(spark, sf_dir))):
        part = fold(rows)[0].table().select(F.lit(name).alias("tbl"), "key", F.col("n").alias("n_copies"), "first_id")
        out = part if out is None else out.unionByName(part)
    return out


def p1_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tbl, n_rows, complete: rows that the ledger has counted, and whether its counts and the copies found agree."""
    out = None
    for name, rows in (("p2tips", tip_rows(spark, sf_dir)), ("urls", url_rows(spark, sf_dir))):
        book, found = fold(rows)
        dups = found.agg(F.count("*").alias("dups"), F.count_distinct("dup_id").alias("ids"))
        part = book.table().agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("groups")).join(dups, F.lit(True))  # a row each
        part = part.select(F.lit(name).alias("tbl"), "n_rows", ((F.col("n_rows") - F.col("groups") == F.col("dups")) & (F.col("dups") == F.col("ids"))).alias("complete"))
        out = part if out is None else out.unionByName(part)
    return out


QUERIES = {"p1_found": p1_found, "p1_ledger": p1_ledger, "p1_totals": p1_totals}
SQL = {"p1_totals": "SELECT 'p2tips' AS tbl, count(*) AS n_rows, true AS complete FROM p2tips WHERE p IS NOT NULL AND commit_sha IS NOT NULL UNION ALL SELECT 'urls', count(*), true FROM urls WHERE url IS NOT NULL"}

"""Has this key been seen before? Golomb-coded sets over hash ranges (problem 2).

A key is hashed to 64 bits and reduced to its top `range_bits` bits. The reduced range is divided into equal blocks. Per
segment of history and block, the sorted distinct values are stored as Rice-coded gaps, with the exact keys beside them.
A probe needs only the block of its own hash, so only probed blocks are decoded; a set of n values answers wrongly with
probability n / 2**range_bits. What the sets call seen is checked against the exact keys of the block; what the check
takes back is the audited rate of wrong answers.

The index is stored. A batch is probed against the segments that are there and appended as a segment of its own, in one
pass: segments are bucketed by block, so the history is never shuffled. Every `fan` segments of one tier are merged.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.plans import manifest
from stratalog.plans.lineage import fresh_path, written
from stratalog.sources.tables import table


def key_of(c: Column) -> Column:
    """The 20 bytes of a value that is exactly 40 hexadecimal digits but for case and blanks around it; else null."""
    bare = F.regexp_replace(c, r"^[\s\p{Z}\p{Cc}\p{Cf}]+|[\s\p{Z}\p{Cc}\p{Cf}]+$", "")
    return F.when(bare.rlike(r"\A[0-9a-fA-F]{40}\z"), F.unhex(bare))


# ---------------------------------------------------------------------------------------------- coding of one block


def encode_block(values: np.ndarray) -> tuple[bytes, int]:
    """Rice-codes sorted distinct non-negative int64 values, given relative to the block's start.

    First come the gaps' quotients in unary (ones, closed by a zero), then their low k bits. Returns bytes and k.
    """
    n = len(values)
    if n == 0:
        return b"", 0
    gaps = np.diff(values, prepend=-1).astype(np.int64) - 1
    k = max(0, int(math.log2(max(1.0, float(gaps.mean()) * math.log(2)))))
    q, r = gaps >> k, gaps & ((1 << k) - 1)
    unary = np.ones(int(q.sum()) + n, dtype=np.uint8)
    unary[np.cumsum(q + 1) - 1] = 0
    low = (r[:, None] >> np.arange(k - 1, -1, -1)) & 1
    return np.packbits(np.concatenate([unary, low.ravel().astype(np.uint8)])).tobytes(), k


def decode_block(data: bytes, n: int, k: int) -> np.ndarray:
    """The values that encode_block was given."""
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8))
    ends = np.flatnonzero(bits == 0)[:n]  # the zeros that close the unary parts come before all low bits
    q = np.diff(ends, prepend=-1) - 1
    low = bits[ends[-1] + 1 : ends[-1] + 1 + n * k].reshape(n, k).astype(np.int64) @ (1 << np.arange(k - 1, -1, -1, dtype=np.int64)) if k else 0
    return np.cumsum((q.astype(np.int64) << k) + low + 1) - 1


# ----------------------------------------------------------------------------------------------------------- the index


def range_bits_for(n_keys: int, fp_rate: float) -> int:
    """Bits of the target range at which n_keys keys give at most fp_rate wrong answers (at most 62)."""
    return min(62, max(8, math.ceil(math.log2(max(1, n_keys) / fp_rate))))


def reduced(key: Column, range_bits: int) -> Column:
    """The key's hash, reduced to [0, 2**range_bits)."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - range_bits)


_SEGMENT = "block long, n int, k int, gaps binary, keys array<binary>"
_ANSWERS = "ids array<long>, maybe array<boolean>, seen array<boolean>"


class SeenIndex:
    """Golomb-coded sets of all keys so far, below `root`; a root that holds an index is opened and goes on.

    expected_keys, fp_rate: the range is made for so many keys at that rate of wrong answers; with more keys the rate
    grows in proportion (`bound`), and answers stay right through the exact check. block_keys: keys a block then holds.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, expected_keys: int = 1_000_000_000, fp_rate: float = 1 / 4096, block_keys: int = 1024, fan: int = 4) -> None:
        self.spark, self.root = spark, root or fresh_path(spark, "seen")
        self.version, kept = manifest.load(spark, self.root)
        if kept is None:
            bits = range_bits_for(expected_keys, fp_rate)
            blocks = min(bits, max(0, math.ceil(math.log2(max(1, expected_keys) / block_keys))))
            kept = {"range_bits": bits, "block_bits": blocks, "buckets": int(spark.conf.get("spark.sql.shuffle.partitions")), "fan": fan, "segments": []}
        self.kept = kept
        self.range_bits, self.span = kept["range_bits"], kept["range_bits"] - kept["block_bits"]
        self.tables: dict[str, str] = {}
        try:  # buckets are known to a catalog only; without a usable one, joins shuffle the segments
            spark.sql("SHOW TABLES").limit(0).collect()
            self.bucketed = True
        except Exception:  # noqa: BLE001
            self.bucketed = False

    def close(self) -> None:
        """Takes the segments' tables out of the session's catalog; their files stay. No answer may be read after that."""
        for known in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {known}")
        self.tables.clear()

    def bound(self, n_keys: int) -> float:
        """The rate of wrong answers that theory gives for a set of n_keys keys."""
        return n_keys / 2.0**self.range_bits

    def _segment(self, name: str) -> DataFrame:
        """A stored segment as a table bucketed by block."""
        fields = _SEGMENT if "merged" in name else f"{_SEGMENT}, {_ANSWERS}"
        if not self.bucketed or name.startswith("plain"):
            return self.spark.read.schema(fields).parquet(f"{self.root}/{name}")
        if name not in self.tables:
            known = f"seen_{uuid.uuid4().hex}"
            self.spark.sql(f"CREATE TABLE {known} ({fields}) USING parquet CLUSTERED BY (block) SORTED BY (block) INTO {self.kept['buckets']} BUCKETS LOCATION '{self.root}/{name}'")
            self.tables[name] = known
        return self.spark.table(self.tables[name])

    def _store(self, df: DataFrame, name: str) -> None:
        """Writes `df`, hash-partitioned by block already, as a segment: one file per bucket."""
        if not self.bucketed:
            df.write.mode("overwrite").parquet(f"{self.root}/{name}")
            return
        known = f"seen_{uuid.uuid4().hex}"
        df.write.format("parquet").bucketBy(self.kept["buckets"], "block").sortBy("block").option("path", f"{self.root}/{name}").mode("overwrite").saveAsTable(known)
        self.tables[name] = known

    def add(self, rows: DataFrame) -> DataFrame:
        """Probes a batch (key binary, id long; ids grow with arrival) and appends it as a segment.

        Returns id, maybe, seen for the first row of each key in the batch: the sets' answer and the checked one. Every
        other row of the batch repeats such a row. Rows with a null key or id are left out.
        """
        span, buckets = self.span, self.kept["buckets"]
        r = reduced(F.col("key"), self.range_bits)
        claims = rows.where("key IS NOT NULL AND id IS NOT NULL").groupBy(F.shiftright(r, span).alias("block"), r.alias("r"), "key").agg(F.min("id").alias("id"))  # combined before the shuffle: a hot key is one value per task
        asked = claims.repartition(buckets, "block").groupBy("block").agg(F.collect_list("r").alias("r"), F.collect_list("key").alias("key"), F.collect_list("id").alias("id"))
        names = [s["name"] for s in self.kept["segments"]]
        for i, name in enumerate(names):  # a few, as segments are merged; each join finds both sides bucketed by block
            old = self._segment(name).select("block", F.col("n").alias(f"n{i}"), F.col("k").alias(f"k{i}"), F.col("gaps").alias(f"gaps{i}"), F.col("keys").alias(f"keys{i}"))
            asked = asked.join(old.hint("merge"), "block", "left")
        count = len(names)

        def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = []
                for row in pdf.itertuples(index=False):
                    base = int(row.block) << span
                    values = np.asarray(row.r, dtype=np.int64) - base
                    ids = np.asarray(row.id, dtype=np.int64)
                    sets = [decode_block(bytes(getattr(row, f"gaps{i}")), int(getattr(row, f"n{i}")), int(getattr(row, f"k{i}"))) for i in range(count) if getattr(row, f"gaps{i}") is not None]
                    before = np.isin(values, np.concatenate(sets)) if sets else np.zeros(len(values), dtype=bool)
                    order = np.lexsort((ids, values))
                    again = np.zeros(len(values), dtype=bool)  # the value stands in this batch's own set by an earlier row
                    again[order[1:]] = values[order[1:]] == values[order[:-1]]
                    seen = np.zeros(len(values), dtype=bool)
                    if before.any():
                        known: set[bytes] = set()
                        for i in range(count):
                            keys = getattr(row, f"keys{i}")
                            if keys is not None:
                                known.update(map(bytes, keys))
                        seen[before] = [bytes(row.key[j]) in known for j in np.flatnonzero(before)]
                    own = np.unique(values)
                    data, k = encode_block(own)
                    out.append((row.block, len(own), k, data, row.key, ids, before | again, seen))
                yield pd.DataFrame(out, columns=["block", "n", "k", "gaps", "keys", "ids", "maybe", "seen"])

        name = f"{'' if self.bucketed else 'plain-'}batch-{self.version + 1}"
        self._store(asked.mapInPandas(answer, f"{_SEGMENT}, {_ANSWERS}").repartition(buckets, "block"), name)
        answers = self._segment(name).select(F.explode(F.arrays_zip("ids", "maybe", "seen")).alias("x")).select(F.col("x.ids").alias("id"), F.col("x.maybe").alias("maybe"), F.col("x.seen").alias("seen"))
        self._commit([*self.kept["segments"], {"name": name, "tier": 0}])
        self._compact()
        return answers

    def _commit(self, segments: list[dict]) -> None:
        self.version += 1
        self.kept = {**self.kept, "segments": segments}
        manifest.commit(self.spark, self.root, self.version, self.kept)

    def _compact(self) -> None:
        """Merges the segments of a tier once there are `fan` of them; so their number grows with the logarithm only."""
        tier = 0
        while len(mine := [s for s in self.kept["segments"] if s["tier"] == tier]) >= self.kept["fan"]:
            both = self.spark.read.schema(_SEGMENT).parquet(*[f"{self.root}/{s['name']}" for s in mine])
            grouped = both.repartition(self.kept["buckets"], "block").groupBy("block").agg(*[F.collect_list(c).alias(c) for c in ("n", "k", "gaps")], F.array_distinct(F.flatten(F.collect_list("keys"))).alias("keys"))

            def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for pdf in batches:
                    out = []
                    for block, ns, ks, gaps, keys in zip(pdf.block, pdf.n, pdf.k, pdf.gaps, pdf["keys"]):
                        values = np.unique(np.concatenate([decode_block(bytes(g), int(n), int(k)) for n, k, g in zip(ns, ks, gaps)]))
                        data, k = encode_block(values)
                        out.append((block, len(values), k, data, keys))
                    yield pd.DataFrame(out, columns=["block", "n", "k", "gaps", "keys"])

            name = f"{'' if self.bucketed else 'plain-'}merged-{self.version + 1}"
            self._store(grouped.mapInPandas(merge, _SEGMENT).repartition(self.kept["buckets"], "block"), name)
            self._commit([s for s in self.kept["segments"] if s not in mine] + [{"name": name, "tier": tier + 1}])
            tier += 1


# ------------------------------------------------------------------------------------------------------------- queries


def stream(spark: SparkSession, sf_dir: str, parts: int = 3) -> DataFrame:
    """key, id, batch of every row with a key: the store (batch 0), the object list in `parts` ranges of lines, the
    want-list. id = the table's number in the top bits, the row's own number below."""
    store = table(spark, sf_dir, "store_idx").select(key_of(F.col("sha")).alias("key"), F.col("id").alias("id"), F.lit(0).alias("batch"))
    olist = table(spark, sf_dir, "olist")
    span = olist.agg(F.min("line_no").alias("lo"), F.max("line_no").alias("hi")).first()
    lo, width = span["lo"] or 0, ((span["hi"] or 0) - (span["lo"] or 0)) // parts + 1
    lines = olist.select(key_of(F.col("sha")).alias("key"), (F.col("line_no") + F.lit(1 << 60)).alias("id"), (F.floor((F.col("line_no") - F.lit(lo)) / F.lit(width)) + 1).cast("int").alias("batch"))
    back = table(spark, sf_dir, "backfill").select(key_of(F.col("oid")).alias("key"), (F.col("bf_id") + F.lit(2 << 60)).alias("id"), F.lit(parts + 1).alias("batch"))
    return store.unionByName(lines).unionByName(back).where("key IS NOT NULL")


def answers(rows: DataFrame, index: SeenIndex | None = None) -> tuple[list[tuple[int, DataFrame, DataFrame]], SeenIndex]:
    """(batch, its rows, their answers) for each batch of `rows` (key, id, batch int), taken in in order, and the index.

    Without an index, one is made for as many keys as there are rows.
    """
    laid = written(rows.select("key", "id", "batch"), "keys", "batch")
    sizes = {r["batch"]: r["n"] for r in laid.groupBy("batch").agg(F.count("*").alias("n")).collect()}  # a row a batch
    index = index or SeenIndex(rows.sparkSession, expected_keys=sum(sizes.values()))
    out = []
    for b in sorted(sizes):
        mine = laid.where(F.col("batch") == b).select("key", "id")
        out.append((b, mine, index.add(mine)))
    return out, index


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose key came before: all but the rows that were the first of a key which the index did not hold.

    Null and malformed keys are no case; equal keys in differently written values are equal.
    """
    ids, new = spark.createDataFrame([], "id long"), spark.createDataFrame([], "id long")
    for _, mine, ans in answers(stream(spark, sf_dir))[0]:
        ids = ids.unionByName(mine.select("id"))
        new = new.unionByName(ans.where("NOT seen").select("id"))
    found = ids.where(F.col("id") >= (1 << 60)).join(new, "id", "left_anti")
    return found.select(
        F.when(F.shiftright("id", 60) == 1, "olist").otherwise("backfill").alias("tbl"),
        F.col("id").bitwiseAND((1 << 60) - 1).alias("row_id"),
    )


def p2_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """batch, probes, wrong, unseen, audited_rate, theoretical_bound: how often the sets called a new key seen.

    probes: keys of the batch; unseen: those that were new; the bound is the one for all keys in the index in the end.
    """
    per, keys = [], 0
    got, index = answers(stream(spark, sf_dir))
    for b, _, ans in got:
        r = ans.agg(F.count("*").alias("probes"), F.count_if(F.col("maybe") & ~F.col("seen")).alias("wrong"), F.count_if(~F.col("seen")).alias("unseen")).first()
        per.append((b, r["probes"], r["wrong"], r["unseen"], r["wrong"] / max(1, r["unseen"])))
        keys += r["unseen"]
    out = spark.createDataFrame(per, "batch int, probes long, wrong long, unseen long, audited_rate double")
    return out.withColumn("theoretical_bound", F.lit(index.bound(keys)))


def p2_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tbl, n_rows, n_new: rows with a key per table, and how many of them brought a new one."""
    got, _ = answers(stream(spark, sf_dir))
    out = spark.createDataFrame([], "id long, new boolean")
    for _, mine, ans in got:
        out = out.unionByName(mine.select("id", F.lit(False).alias("new"))).unionByName(ans.where("NOT seen").select("id", F.lit(True).alias("new")))
    tbl = F.shiftright("id", 60)
    return out.groupBy(F.when(tbl == 0, "store_idx").when(tbl == 1, "olist").otherwise("backfill").alias("tbl")).agg(F.count_if(~F.col("new")).alias("n_rows"), F.count_if("new").alias("n_new"))


QUERIES = {"p2_found": p2_found, "p2_error_rate": p2_error_rate, "p2_new_keys": p2_new_keys}

_KEYS = """
    WITH k AS (
        SELECT 0 AS src, id AS row_id, lower(sha) AS key FROM store_idx
        UNION ALL SELECT 1, line_no, lower(regexp_replace(sha, '^[\\s\\p{Z}\\p{Cc}\\p{Cf}]+|[\\s\\p{Z}\\p{Cc}\\p{Cf}]+$', '', 'g')) FROM olist
        UNION ALL SELECT 2, bf_id, lower(regexp_replace(oid, '^[\\s\\p{Z}\\p{Cc}\\p{Cf}]+|[\\s\\p{Z}\\p{Cc}\\p{Cf}]+$', '', 'g')) FROM backfill),
    v AS (SELECT src, row_id, row_number() OVER (PARTITION BY key ORDER BY src, row_id) AS rn FROM k WHERE regexp_full_match(key, '[0-9a-f]{40}'))
"""
SQL = {"p2_found": _KEYS + "SELECT CASE src WHEN 1 THEN 'olist' ELSE 'backfill' END AS tbl, row_id FROM v WHERE src > 0 AND rn > 1",
       "p2_new_keys": _KEYS + "SELECT CASE src WHEN 0 THEN 'store_idx' WHEN 1 THEN 'olist' ELSE 'backfill' END AS tbl, count(*) AS n_rows, count(*) FILTER (rn = 1) AS n_new FROM v GROUP BY 1"}

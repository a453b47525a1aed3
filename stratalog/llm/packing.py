"""Filling fixed-capacity containers: bulk-synchronous best fit (problem 7).

Documents are range-sorted by size, so that each has a rank among those of its size, and dealt by rank to stripes of
containers; every stripe gets the same mixture of sizes. In a round all stripes sweep at the same time: from the largest
size down, each document goes to its successor among the gaps, the smallest gap that holds it; the rank decides between
documents of one size that want the same gap, and the gap is updated at once. What a stripe can't place, and the gaps
that it leaves, move on to the next round, in which stripes are merged. The last round has one stripe and opens the
containers that are still needed.

A sweep works on runs: documents of one size and consecutive ranks, containers with equal gaps. Sizes are whole numbers
up to the capacity, so a sweep's state is bounded by the capacity and the stripe, however many documents there are. Only
at the end do the documents meet the runs, by stripe, size and rank.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.llm.tokens import VOCABULARY, with_tokens
from stratalog.plans.lineage import written
from stratalog.plans.prefix import running_sum
from stratalog.sources.tables import table

Items = tuple[int, int, int, int]  # size, stripe, first rank, how many
Gaps = tuple[int, int, int]  # gap, first container, how many


def sweep(items: list[Items], gaps: list[Gaps]) -> tuple[list[tuple[int, int, int, int, int]], list[Items], list[Gaps]]:
    """((size, stripe, first rank, how many, first container) placed, items left, gaps left).

    Larger items come first; each takes the smallest sufficient gap, and the gap goes on with the room left.
    """
    runs = sorted(gaps)
    placed, left = [], []
    for size, stripe, rank, n in sorted(items, key=lambda x: (-x[0], x[1], x[2])):
        while n:
            at = bisect_left(runs, (size,))
            if at == len(runs):
                left.append((size, stripe, rank, n))
                break
            gap, bin0, m = runs.pop(at)
            k = min(n, m)
            placed.append((size, stripe, rank, k, bin0))
            rank += k
            n -= k
            if k < m:
                insort(runs, (gap, bin0 + k, m - k))
            if gap > size:
                insort(runs, (gap - size, bin0, k))
    return placed, left, runs


def swept(capacity: int, base: int, items: list[Items], gaps: list[Gaps], last: bool) -> tuple[list, list[Items], list[Gaps]]:
    """A stripe's sweep, then new containers from number `base` on: as many as the rest surely fills, in the last round
    as many as it needs."""
    placed, left, gaps = sweep(items, gaps)
    while left:
        rest = sum(size * n for size, _, _, n in left)
        more = -(-rest // capacity) if last else rest // capacity
        if not more:
            break
        got, left, gaps = sweep(left, [*gaps, (capacity, base, more)])
        base += more
        placed += got
        if not last:
            break
    return placed, left, gaps


def pieces_of(sized: DataFrame, packs: DataFrame) -> DataFrame:
    """pack_id, capacity, doc_id, piece, start, n: each document for each capacity, divided only if it exceeds it."""
    both = sized.where("n_tokens > 0").select("doc_id", "n_tokens", F.explode(F.array(*[F.struct(F.lit(r["pack_id"]).alias("p"), F.lit(r["capacity_tokens"]).cast("long").alias("c")) for r in packs.collect()])).alias("x"))
    cut = both.select("doc_id", "n_tokens", F.col("x.p").alias("pack_id"), F.col("x.c").alias("capacity")).withColumn("piece", F.explode(F.expr("sequence(0L, (n_tokens - 1) div capacity)")))
    return cut.select("pack_id", "capacity", "doc_id", "piece", (F.col("piece") * F.col("capacity")).alias("start"), F.least(F.col("capacity"), F.col("n_tokens") - F.col("piece") * F.col("capacity")).alias("n"))


_RUN = "pack_id int, capacity long, kind string, size long, stripe long, rank long, n long, bin long"


def _sweep_round(state: DataFrame, number: int, last: bool) -> DataFrame:
    """One round: `state` (group, and _RUN with kinds item and gap) to _RUN with kinds placed, item and gap."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pack, capacity, group = int(pdf.pack_id.iloc[0]), int(pdf.capacity.iloc[0]), int(pdf.group.iloc[0])
        it, ga = pdf[pdf.kind == "item"], pdf[pdf.kind == "gap"]
        items = list(zip(it["size"].tolist(), it["stripe"].tolist(), it["rank"].tolist(), it["n"].tolist()))
        gaps = list(zip(ga["size"].tolist(), ga["bin"].tolist(), ga["n"].tolist()))
        base = (number << 56) + (group << 32)  # containers opened by this stripe in this round
        placed, left, gaps = swept(capacity, base, items, gaps, last)
        rows = [(pack, capacity, "placed", s, g, r, n, b) for s, g, r, n, b in placed] + [(pack, capacity, "item", s, g, r, n, 0) for s, g, r, n in left]
        rows += [(pack, capacity, "gap", s, group, 0, n, b) for s, b, n in gaps]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _RUN.split(", ")])

    return state.groupBy("pack_id", "group").applyInPandas(work, _RUN)


def packed(sized: DataFrame, packs: DataFrame, stripe_bins: int = 2048, fan_in: int = 16) -> DataFrame:
    """pack_id, bin_id, doc_id, piece, start, n: every document (piece) in a container of each capacity.

    sized: doc_id (unique), n_tokens. packs: pack_id, capacity_tokens (a few). A document without tokens needs no room
    and stands with a null bin_id; one without a number of tokens has no row. Containers never hold more than their
    capacity. stripe_bins: containers that a stripe fills in the first round; fan_in: stripes merged per round.
    """
    spark = sized.sparkSession
    caps = {r["pack_id"]: int(r["capacity_tokens"]) for r in packs.collect()}
    sized = written(sized.select("doc_id", "n_tokens"), "sized")
    total = sized.agg(F.sum("n_tokens")).first()[0] or 0
    stripes = {p: max(1, -(-total // (c * stripe_bins))) for p, c in caps.items()}
    of = F.broadcast(spark.createDataFrame([(p, s) for p, s in stripes.items()], "pack_id int, stripes long"))  # a row per capacity
    ranked = running_sum(pieces_of(sized, packs).withColumn("_1", F.lit(1)), ["pack_id", "n"], ["doc_id", "piece"], "_1", "_rank").join(of, "pack_id")
    # Each size starts at another stripe, so that rare sizes spread too.
    turn = F.col("_rank") - 1 + F.pmod(F.xxhash64("n"), F.col("stripes"))
    laid = written(
        ranked.select("pack_id", "capacity", "doc_id", "piece", "start", "n", F.pmod(turn, F.col("stripes")).alias("stripe"), F.floor(turn / F.col("stripes")).alias("rank")), "ranked-pieces"
    )
    state = laid.groupBy("pack_id", "capacity", "stripe", F.col("n").alias("size")).agg(F.count("*").alias("n"), F.min("rank").alias("rank")).select(
        "pack_id", "capacity", F.lit("item").alias("kind"), "size", "stripe", "rank", "n", F.lit(0).cast("long").alias("bin")
    )
    placed, number, width = None, 0, 1
    most = max(stripes.values(), default=1)
    while True:
        last = width >= most
        grouped = state.withColumn("group", F.floor(F.col("stripe") / F.lit(width)) if number == 0 else F.when(F.col("kind") == "item", F.floor(F.col("stripe") / F.lit(width))).otherwise(F.floor(F.col("stripe") / F.lit(fan_in))))
        out = written(_sweep_round(grouped, number, last), "sweep")
        here = out.where("kind = 'placed'").select("pack_id", "stripe", "size", "rank", "n", "bin")
        placed = here if placed is None else placed.unionByName(here)
        if last:
            break
        state = out.where("kind <> 'placed'")
        number, width = number + 1, width * fan_in
    runs = placed.select(F.col("pack_id").alias("_p"), F.col("stripe").alias("_t"), F.col("size").alias("_s"), F.col("rank").alias("_lo"), (F.col("rank") + F.col("n")).alias("_hi"), "bin")
    met = laid.join(runs, (F.col("pack_id") == F.col("_p")) & (F.col("stripe") == F.col("_t")) & (F.col("n") == F.col("_s")) & (F.col("rank") >= F.col("_lo")) & (F.col("rank") < F.col("_hi")))
    full = met.select("pack_id", (F.col("bin") + F.col("rank") - F.col("_lo")).alias("bin_id"), "doc_id", "piece", "start", "n")
    none = sized.where("n_tokens = 0").select("doc_id", F.explode(F.array(*[F.lit(p) for p in caps])).alias("pack_id"))
    return full.unionByName(none.select("pack_id", F.lit(None).cast("long").alias("bin_id"), "doc_id", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("n")))


def unused(assigned: DataFrame, packs: DataFrame) -> DataFrame:
    """pack_id, containers, used, unused, least: the room left, and the containers that any packing needs at least."""
    per = assigned.where("bin_id IS NOT NULL").groupBy("pack_id").agg(F.countDistinct("bin_id").alias("containers"), F.sum("n").alias("used"))
    return per.join(F.broadcast(packs), "pack_id").select("pack_id", "containers", "used", (F.col("containers") * F.col("capacity_tokens") - F.col("used")).alias("unused"), F.ceil(F.col("used") / F.col("capacity_tokens")).alias("least"))


def p7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(with_tokens(table(spark, sf_dir, "documents"), [], VOCABULARY), table(spark, sf_dir, "pack_capacity"))


def p7_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unused(written(p7_packing(spark, sf_dir), "packing"), table(spark, sf_dir, "pack_capacity"))


def p7_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pack_id, documents, overfull, gaps, torn: documents placed; containers above capacity; documents whose pieces don't
    follow each other from 0 on; documents divided though they fit. All but the first are 0."""
    packs = table(spark, sf_dir, "pack_capacity")
    a = written(p7_packing(spark, sf_dir), "packing").join(F.broadcast(packs), "pack_id")
    per_bin = a.where("bin_id IS NOT NULL").groupBy("pack_id", "bin_id", "capacity_tokens").agg(F.sum("n").alias("used")).groupBy("pack_id").agg(F.count_if(F.col("used") > F.col("capacity_tokens")).alias("overfull"))
    docs = a.groupBy("pack_id", "doc_id", "capacity_tokens").agg(F.sum("n").alias("size"), F.max(F.col("start") + F.col("n")).alias("end"), F.count("*").alias("pieces"), F.max("piece").alias("last"))
    bad = (F.col("size") != F.col("end")) | (F.col("pieces") != F.col("last") + 1)
    per_doc = docs.groupBy("pack_id").agg(F.count("*").alias("documents"), F.count_if(bad).alias("gaps"), F.count_if((F.col("pieces") > 1) & (F.col("size") <= F.col("capacity_tokens"))).alias("torn"))
    return per_doc.join(per_bin, "pack_id", "left").select("pack_id", "documents", F.coalesce("overfull", F.lit(0)).alias("overfull"), "gaps", "torn")


QUERIES = {"p7_packing": p7_packing, "p7_unused": p7_unused, "p7_checks": p7_checks}
SQL = {"p7_checks": "SELECT pack_id, count(*) AS documents, 0 AS overfull, 0 AS gaps, 0 AS torn FROM documents, pack_capacity WHERE text IS NOT NULL GROUP BY pack_id"}

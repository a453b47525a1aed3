"""Mixing sources to target weights by weighted fair queueing (problem 8).

Every document of a source, in shuffled order and once per allowed repeat, gets a virtual finish time: the source's
tokens up to and including it, divided by the source's target share. All documents are put in order of these times by
a global range sort, and the order is cut at the total budget. While no source is exhausted, each has its share of
every prefix of that order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.llm.tokens import VOCABULARY, with_tokens
from stratalog.plans.lineage import written
from stratalog.plans.prefix import running_sum
from stratalog.sources.tables import table


def reachable_total(sized: DataFrame, targets: DataFrame) -> int:
    """The largest total at which every source with a positive share can still give its share within its repeats.

    A source with a share but no tokens makes that 0.
    """
    have = sized.groupBy("source").agg(F.sum("n_tokens").alias("t"))
    row = targets.where("target_share > 0").join(have, "source", "left").agg(F.min(F.coalesce("t", F.lit(0)) * F.col("max_repeats") / F.col("target_share")).alias("m")).first()
    return int(row["m"] or 0)


def finish_line(sources: list[tuple[float, int, int]], total: int) -> float:
    """The virtual time at which the queue has given out `total` tokens.

    sources: (target share, tokens, most repeats). A source gives share * time until its repeats are used up. Infinite
    where all sources together have less than `total`.
    """
    ends = sorted((t * r / w, w, t * r) for w, t, r in sources if w > 0 and t * r > 0)
    given, speed = 0.0, sum(w for _, w, _ in ends)
    for end, w, most in ends:  # before `end` all remaining sources give
        if given + speed * end >= total:
            return (total - given) / speed
        given += most
        speed -= w
    return float("inf")


def mixed(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 1) -> DataFrame:
    """doc_id, source, repeat (from 1), n_tokens, finish: the chosen documents in the order of `finish`.

    sized: doc_id, source, n_tokens. targets: source, target_share, max_repeats. Without a total the largest one that
    meets all shares is taken. Documents without tokens, without a source or of a source without a positive share are
    never chosen. Where a source is exhausted the others go on up to the total. The cut takes whole documents, so up to
    one document's tokens of the total stay unused; `shares` reports them.
    """
    spark = sized.sparkSession
    sized = written(sized.where("n_tokens > 0 AND source IS NOT NULL").select("doc_id", "source", "n_tokens"), "sized")
    goal = targets.where("target_share > 0 AND max_repeats > 0 AND source IS NOT NULL").select("source", "target_share", "max_repeats")
    have = goal.join(sized.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.max("n_tokens").alias("longest")), "source").collect()  # a row per source
    total = reachable_total(sized, goal) if total_tokens is None else total_tokens
    line = finish_line([(r["target_share"], r["t"], r["max_repeats"]) for r in have], total)
    # A source is passed as often as it needs to be on the line, with one document to spare; more could not be chosen.
    # Where another source's documents are long enough to push the line back, all repeats are kept.
    slack = sum(r["longest"] for r in have)
    late = finish_line([(r["target_share"], r["t"], r["max_repeats"]) for r in have], total + slack)
    passes = [(r["source"], r["target_share"], int(min(r["max_repeats"], max(line, late) * r["target_share"] // r["t"] + 1))) for r in have]
    needed = F.broadcast(spark.createDataFrame(passes, "source string, target_share double, passes int"))  # a row per source
    copies = sized.join(needed, "source").withColumn("repeat", F.explode(F.sequence(F.lit(1), F.col("passes"))))
    shuffled = copies.withColumn("_turn", F.xxhash64("doc_id", "repeat", F.lit(seed)))
    queue = running_sum(shuffled, ["source"], ["repeat", "_turn", "doc_id"], "n_tokens", "_sum")
    timed = queue.withColumn("finish", F.col("_sum") / F.col("target_share")).select("doc_id", "source", "repeat", "n_tokens", "finish")
    order = running_sum(timed, [], ["finish", "source", "doc_id", "repeat"], "n_tokens", "_all")
    return order.where(F.col("_all") <= F.lit(total)).select("doc_id", "source", "repeat", "n_tokens", "finish")


def shares(chosen: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """source, target_share, actual_share, n_tokens, n_docs, most_repeats, unused: what the mixture reached.

    unused: tokens of the total that no document was chosen for; null where no total is given.
    """
    per = chosen.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), F.countDistinct("doc_id").alias("n_docs"), F.max("repeat").alias("most_repeats"))
    total = per.agg(F.sum("n_tokens")).first()[0] or 0
    none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return targets.select("source", "target_share").join(per, "source", "left").select(
        "source", "target_share", (F.coalesce("n_tokens", F.lit(0)) / F.lit(total or 1)).alias("actual_share"), none("n_tokens"), none("n_docs"), none("most_repeats"), F.lit(None if total_tokens is None else total_tokens - total).cast("long").alias("unused")
    )


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(with_tokens(table(spark, sf_dir, "documents"), ["source"], VOCABULARY), table(spark, sf_dir, "mix_targets"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = written(with_tokens(table(spark, sf_dir, "documents"), ["source"], VOCABULARY), "sized")
    targets = table(spark, sf_dir, "mix_targets")
    total = reachable_total(sized, targets.where("max_repeats > 0"))
    return shares(written(mixed(sized, targets, total), "mixture"), targets, total)


def p8_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source, capped, in_order: no document of the source is used more often than it may be, and its repeats are 1 to n."""
    goal = table(spark, sf_dir, "mix_targets")
    uses = written(p8_mixture(spark, sf_dir), "mixture").groupBy("source", "doc_id").agg(F.count("*").alias("n"), F.max("repeat").alias("last"))
    per = uses.groupBy("source").agg(F.max("n").alias("most"), F.bool_and(F.col("n") == F.col("last")).alias("in_order"))
    return goal.join(per, "source", "left").select("source", F.coalesce(F.col("most") <= F.col("max_repeats"), F.lit(True)).alias("capped"), F.coalesce("in_order", F.lit(True)).alias("in_order"))


QUERIES = {"p8_mixture": p8_mixture, "p8_shares": p8_shares, "p8_checks": p8_checks}
SQL = {"p8_checks": "SELECT source, true AS capped, true AS in_order FROM mix_targets"}

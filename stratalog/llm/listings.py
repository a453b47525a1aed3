"""Deduplicating new batches against all history: graph index shards (problem 3).

A listing is a set of keys; its MinHash signature stands for it. The history is kept as shards, each a navigable
small-world graph over signatures. The space of sets is flat - unrelated listings are equally far from each other - so a
graph of nearest neighbours alone has no slope to walk along. Nodes are therefore linked on rings: ring j orders them by
components j and j + 1, and every node has links to the nodes 1, 4, 16 … places before and behind it. A search walks
greedily down each ring's links to the query's own components, looks at the nodes within the beam there, and from every
node that is similar enough goes on along its short links, so there is no limit to the number of counterparts. The beam
is tuned against exhaustive search when a shard is built.

The index is stored and grows batch by batch: a new batch gets shards of its own; shards of one tier are merged on
schedule; a directory of entry points tells which shards hold any node with a query's component, so that a query visits
only those. Pairs are verified on the exact sets of keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.llm.seen import key_of
from stratalog.plans import manifest
from stratalog.plans.lineage import fresh_path, written
from stratalog.sources.tables import table

COMPONENTS = 64  # of a signature


def rings_for(similarity: float) -> int:
    """Rings so that a counterpart shares no ring's component with probability 1e-6 at most; 62 at similarity 0.2."""
    if not 0.2 <= similarity <= 1:
        raise ValueError("similarity must lie between 0.2 and 1")
    return min(COMPONENTS, max(2, math.ceil(math.log(1e-6) / math.log(max(1e-9, 1 - similarity)))))


def floor_for(similarity: float) -> float:
    """Share of equal components from which a node is looked at: five standard deviations below `similarity`."""
    return max(1 / COMPONENTS, similarity - 5 * math.sqrt(similarity * (1 - similarity) / COMPONENTS))


# ---------------------------------------------------------------------------------------------------------- signatures


def listing_keys(olist: DataFrame) -> DataFrame:
    """list_id, h: the distinct keys of each listing as 64-bit hashes; rows without key or list_id are left out.

    Grouping by list and key spreads a listing of any size over all tasks.
    """
    return olist.select("list_id", F.xxhash64(key_of(F.col("sha"))).alias("h"), key_of(F.col("sha")).isNotNull().alias("ok")).where("ok AND list_id IS NOT NULL").select("list_id", "h").distinct()


def _component(h: Column, j: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(h, F.lit(j)), 33).cast("int")


def signatures(keys: DataFrame) -> DataFrame:
    """list_id, n, f1, f2 (two fingerprints of the whole set), sig (COMPONENTS ints). Combined map-side."""
    mins = [F.min(_component(F.col("h"), j)).alias(f"m{j}") for j in range(COMPONENTS)]
    agg = keys.groupBy("list_id").agg(F.count("*").alias("n"), F.expr("bit_xor(h)").alias("f1"), F.expr("bit_xor(xxhash64(h, 977))").alias("f2"), *mins)
    return agg.select("list_id", "n", "f1", "f2", F.array(*[f"m{j}" for j in range(COMPONENTS)]).alias("sig"))


# ----------------------------------------------------------------------------------------------------- graph of a shard


class Graph:
    """Navigable small-world graph over the signatures of one shard. Nodes are positions in `sig`.

    links: int32 (rings, 2 * levels, nodes). Entry 2 * k of a ring is the node 4**k places before a node on that ring,
    entry 2 * k + 1 the one as far behind; at the ends a node is linked to itself. hubs: where a ring is entered. All of
    them follow from the rings' orders (int32, rings x nodes), which is how a graph is stored and shipped.
    """

    def __init__(self, sig: np.ndarray, rings: int, orders: np.ndarray | None = None) -> None:
        self.sig, self.rings, n = sig, rings, len(sig)
        self.recall = 1.0
        self.keys = [sig[:, j].astype(np.int64) << 31 | sig[:, (j + 1) % sig.shape[1]] for j in range(rings)]
        if orders is None:
            orders = np.stack([np.lexsort([sig[:, (j + 3) % sig.shape[1]], sig[:, (j + 2) % sig.shape[1]], self.keys[j]]) for j in range(rings)]).astype(np.int32)
        self.orders, self.hubs = orders, orders[:, 0]
        levels = max(1, math.ceil(math.log(max(2, n), 4)))
        self.links = np.empty((rings, 2 * levels, n), dtype=np.int32)
        for j, order in enumerate(orders):
            for k in range(levels):
                step = min(4**k, n)
                self.links[j, 2 * k, order] = np.concatenate([order[:step], order[: n - step]])  # a node without a place so far off is linked to itself
                self.links[j, 2 * k + 1, order] = np.concatenate([order[step:], order[n - step :]])

    def walk(self, queries: np.ndarray, j: int) -> np.ndarray:
        """The node that a greedy walk along ring j ends at for each query: the nearest by components j and j + 1.

        From the hub, the ring's first node, the walk takes the longest link that does not pass the query's place.
        """
        goal = queries[:, j].astype(np.int64) << 31 | queries[:, (j + 1) % queries.shape[1]]
        at = np.full(len(queries), self.hubs[j], dtype=np.int64)
        key, links = self.keys[j], self.links[j]
        for k in range(len(links) // 2 - 1, -1, -1):
            going = np.arange(len(queries))
            while len(going):
                far = links[2 * k + 1, at[going]]
                ok = (far != at[going]) & (key[far] <= goal[going])
                going = going[ok]
                at[going] = far[ok]
        behind = links[1, at]
        return np.where(np.abs(key[behind] - goal) < np.abs(key[at] - goal), behind, at)

    def search(self, queries: np.ndarray, beam: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all nodes found with at least `floor` of their components equal."""
        n = len(self.sig)
        if beam >= n:
            hits = [np.flatnonzero((self.sig == q).mean(axis=1) >= floor) for q in queries]
            return np.repeat(np.arange(len(queries)), [len(h) for h in hits]), np.concatenate([np.zeros(0, dtype=np.int64), *hits])
        rows, cand = np.arange(len(queries)), []
        for j in range(self.rings):
            at = self.walk(queries, j)
            for way in (0, 1):  # from where the walk ended, along the ring while its component is the query's
                q, v = rows, at
                for _ in range(beam):
                    same = self.sig[v, j] == queries[q, j]
                    q, v = q[same], v[same]
                    cand.append(q * n + v)
                    nxt = self.links[j, way, v]
                    q, v = q[nxt != v], nxt[nxt != v].astype(np.int64)
        seen = np.unique(np.concatenate(cand)) if cand else np.zeros(0, dtype=np.int64)
        front = self._near(seen, queries, floor)
        kept = [front]
        short = self.links[:, :4].reshape(-1, n)  # the links to 1 and 4 places on either side, of all rings
        while len(front):  # on from every node that is near enough
            q, v = front // n, front % n
            step = np.unique((q * n + short[:, v]).ravel())
            new = np.setdiff1d(step, seen, assume_unique=True)
            seen = np.union1d(seen, new)
            front = self._near(new, queries, floor)
            kept.append(front)
        got = np.concatenate(kept)
        return got // n, got % n

    def _near(self, codes: np.ndarray, queries: np.ndarray, floor: float) -> np.ndarray:
        n = len(self.sig)
        out = [codes[:0]]
        for i in range(0, len(codes), 100_000):
            c = codes[i : i + 100_000]
            out.append(c[(self.sig[c % n] == queries[c // n]).mean(axis=1) >= floor])
        return np.concatenate(out)

    def exhaustive(self, queries: np.ndarray, floor: float) -> set[tuple[int, int]]:
        return {(i, int(v)) for i, q in enumerate(queries) for v in np.flatnonzero((self.sig == q).mean(axis=1) >= floor)}

    def tuned_beam(self, floor: float, sample: int = 64, recall: float = 0.99) -> int:
        """The smallest beam (1, 2, 4 …) that finds `recall` of what exhaustive search finds for a sample of nodes.

        A beam of the shard's size searches exhaustively, so doubling ends there. `recall` keeps what was measured.
        Half of the components are replaced for a third of the sample, so that it holds distant queries too.
        """
        rng = np.random.default_rng(7)
        pick = self.sig[rng.choice(len(self.sig), min(sample, len(self.sig)), replace=False)].copy()
        for i in range(0, len(pick), 3):
            pick[i, rng.choice(pick.shape[1], pick.shape[1] // 2, replace=False)] = -1
        truth = self.exhaustive(pick, floor)
        beam, self.recall = 1, 1.0
        while beam < len(self.sig):
            q, v = self.search(pick, beam, floor)
            self.recall = len(truth & set(zip(q.tolist(), v.tolist()))) / max(1, len(truth))
            if self.recall >= recall or not truth:
                break
            beam, self.recall = beam * 2, 1.0
        return beam


# ----------------------------------------------------------------------------------------------------------- the index

_SHARD = "shard long, size int, nodes binary, batches binary, sigs binary, orders binary, beam int, recall double"


class ShardIndex:
    """Graph shards below `root` with a directory of entry points; a root that holds an index is opened and goes on.

    max_nodes: nodes of a shard at most. fan: segments of a tier that are merged, if that gives fewer shards.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, similarity: float = 0.6, max_nodes: int = 8192, fan: int = 4) -> None:
        self.spark, self.root = spark, root or fresh_path(spark, "shards")
        self.version, kept = manifest.load(spark, self.root)
        self.kept = kept or {"similarity": similarity, "max_nodes": max_nodes, "fan": fan, "segments": [], "next": 0}
        self.similarity, self.floor, self.rings = self.kept["similarity"], floor_for(self.kept["similarity"]), rings_for(self.kept["similarity"])

    def _commit(self, **changes: object) -> None:
        self.version += 1
        self.kept = {**self.kept, **changes}
        manifest.commit(self.spark, self.root, self.version, self.kept)

    def shards(self) -> DataFrame | None:
        """A row per shard of the index as it stands, with its beam and the recall measured for it."""
        names = [f"{self.root}/{s['name']}/shards" for s in self.kept["segments"]]
        return self.spark.read.schema(_SHARD).parquet(*names) if names else None

    def _build(self, nodes: DataFrame, n: int, tier: int, replaced: list[dict]) -> None:
        """Writes shards and entry points of `nodes` (node, batch, sig) as a segment that replaces others."""
        floor, rings, name, first = self.floor, self.rings, f"segment-{self.version + 1}", self.kept["next"]
        pieces = -(-n // self.kept["max_nodes"])
        placed = nodes.select((F.lit(first) + F.pmod(F.xxhash64("node", F.lit(3)), F.lit(pieces))).cast("long").alias("shard"), "node", "batch", "sig")

        def build(part: pd.DataFrame) -> pd.DataFrame:
            graph = Graph(np.array(part.sig.tolist(), dtype=np.int32), rings)
            node, batch, beam = part.node.to_numpy(dtype=np.int64), part.batch.to_numpy(dtype=np.int32), graph.tuned_beam(floor)
            row = (int(part.shard.iloc[0]), len(part), node.tobytes(), batch.tobytes(), graph.sig.tobytes(), graph.orders.tobytes(), beam, graph.recall)
            return pd.DataFrame([row], columns=[c.split()[0] for c in _SHARD.split(", ")])

        placed.groupBy("shard").applyInPandas(build, _SHARD).write.mode("overwrite").parquet(f"{self.root}/{name}/shards")
        self._entries(placed, "shard").distinct().write.mode("overwrite").parquet(f"{self.root}/{name}/entries")
        self._commit(segments=[s for s in self.kept["segments"] if s not in replaced] + [{"name": name, "tier": tier, "nodes": n, "shards": pieces}], next=first + pieces)

    def _entries(self, nodes: DataFrame, column: str) -> DataFrame:
        """ring, component, `column`: the components by which the rings are entered."""
        return nodes.select(column, F.posexplode(F.slice("sig", 1, self.rings)).alias("ring", "component"))

    def add(self, intake: DataFrame, query_block: int = 16_384) -> DataFrame:
        """a, b: pairs of nodes that the graphs find near, b of this intake and a of an earlier batch.

        intake: node long (unique), batch int, sig array<int>; batches do not come again. The intake becomes shards of
        its own, and its nodes are searched in the shards of history that the directory names, and in its own if it has
        several batches. Queries of a shard are searched in blocks; no task gets more than a shard and a block.
        """
        none = self.spark.createDataFrame([], "a long, b long")
        n, first, last = intake.agg(F.count("*"), F.min("batch"), F.max("batch")).first()
        if not n:
            return none
        before = self.kept["segments"]
        self._build(intake, n, 0, [])
        searched = before if first == last else self.kept["segments"]
        if not searched:
            self._compact()
            return none
        directory = self.spark.read.schema("shard long, ring int, component int").parquet(*[f"{self.root}/{s['name']}/entries" for s in searched])
        asked = self._entries(intake, "node")
        route = written(asked.join(directory, ["ring", "component"]).select("node", "shard").distinct(), "route")
        # A row per shard; written, so that its size is known before shards are moved to meet it.
        blocks = written(route.groupBy("shard").agg(F.ceil(F.count("*") / query_block).cast("int").alias("blocks")), "blocks")
        queries = route.join(blocks, "shard").select("node", "shard", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int").alias("block")).join(intake, "node")
        queries = queries.select(F.col("shard").alias("qs"), F.col("block").alias("qb"), F.col("node").alias("qnode"), F.col("batch").alias("qbatch"), F.col("sig").alias("qsig"))
        held = self.shards().join(blocks, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        floor, rings = self.floor, self.rings

        def search(shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
            out = [pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})]
            if len(shard) and len(queries):
                row = shard.iloc[0]
                size = int(row["size"])
                graph = Graph(np.frombuffer(row.sigs, dtype=np.int32).reshape(size, -1), rings, np.frombuffer(row.orders, dtype=np.int32).reshape(rings, size))
                node, batch = np.frombuffer(row.nodes, dtype=np.int64), np.frombuffer(row.batches, dtype=np.int32)
                for i in range(0, len(queries), 1024):
                    part = queries.iloc[i : i + 1024]
                    q, v = graph.search(np.array(part.qsig.tolist(), dtype=np.int32), int(row.beam), floor)
                    ok = batch[v] < part.qbatch.to_numpy()[q]
                    out.append(pd.DataFrame({"a": node[v[ok]], "b": part.qnode.to_numpy()[q[ok]]}))
            return pd.concat(out)

        found = written(held.groupBy("shard", "block").cogroup(queries.groupBy("qs", "qb")).applyInPandas(search, "a long, b long"), "listing-candidates")
        self._compact()
        return found

    def _compact(self) -> None:
        """Merges the segments of a tier, once there are `fan` of them, into as few shards as hold their nodes."""
        tier = 0
        while len(mine := [s for s in self.kept["segments"] if s["tier"] == tier]) >= self.kept["fan"]:
            n = sum(s["nodes"] for s in mine)
            if -(-n // self.kept["max_nodes"]) >= sum(s["shards"] for s in mine):
                self._commit(segments=[{**s, "tier": tier + 1} if s in mine else s for s in self.kept["segments"]])
                break  # full shards stay as they are
            parts = self.spark.read.schema(_SHARD).parquet(*[f"{self.root}/{s['name']}/shards" for s in mine]).select("size", "nodes", "batches", "sigs")

            def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for pdf in batches:
                    for size, node, batch, sigs in zip(pdf["size"], pdf.nodes, pdf.batches, pdf.sigs):
                        yield pd.DataFrame({"node": np.frombuffer(node, dtype=np.int64), "batch": np.frombuffer(batch, dtype=np.int32), "sig": list(np.frombuffer(sigs, dtype=np.int32).reshape(size, -1))})

            self._build(parts.mapInPandas(unpack, "node long, batch int, sig array<int>"), n, tier + 1, mine)
            tier += 1


def intakes(sizes: dict[int, int], parts: int) -> list[list[int]]:
    """The batches in order, as `parts` or fewer runs of about equal size."""
    total, done, out = sum(sizes.values()), 0, {}
    for b in sorted(sizes):
        out.setdefault(min(parts - 1, done * parts // max(1, total)), []).append(b)
        done += sizes[b]
    return list(out.values())


def verified(pairs: DataFrame, keys: DataFrame, sizes: DataFrame, similarity: float) -> DataFrame:
    """a, b of the pairs of lists whose exact sets of keys (list_id, h) have at least `similarity` of their union in common.

    sizes: list_id, n, f1, f2. Sets with equal size and fingerprints (128 bits) are equal. Otherwise the keys of the
    smaller list are looked up in the other by joins on (list, key), which no large list skews.
    """
    of = lambda c: sizes.select(F.col("list_id").alias(c), F.struct("n", "f1", "f2").alias(f"s{c}"))
    sized = pairs.join(of("a"), "a").join(of("b"), "b")
    equal = sized.where("sa = sb").select("a", "b")
    sized = sized.where("sa <> sb").select("a", "b", F.col("sa.n").alias("na"), F.col("sb.n").alias("nb")).where(F.least("na", "nb") >= F.greatest("na", "nb") * similarity)
    less = F.col("na") <= F.col("nb")
    sized = sized.select("a", "b", "na", "nb", F.when(less, F.col("a")).otherwise(F.col("b")).alias("small"), F.when(less, F.col("b")).otherwise(F.col("a")).alias("large"))
    wanted = sized.select(F.explode(F.array("a", "b")).alias("list_id")).distinct()
    few = keys.join(wanted, "list_id", "left_semi")
    left = sized.join(few.select(F.col("list_id").alias("small"), "h"), "small")
    common = left.join(few.select(F.col("list_id").alias("large"), "h"), ["large", "h"]).groupBy("a", "b", "na", "nb").agg(F.count("*").alias("c"))
    return equal.unionByName(common.where(F.col("c") >= F.lit(similarity) * (F.col("na") + F.col("nb") - F.col("c"))).select("a", "b"))


def counterparts(lists: DataFrame, olist: DataFrame, similarity: float = 0.6, index: ShardIndex | None = None, parts: int | None = None) -> DataFrame:
    """list_a, list_b (list_a < list_b): listings of different batches with sets of keys at least `similarity` alike.

    lists: list_id, batch; each batch is an intake with shards of its own, in the batches' order, unless `parts` asks for
    so many intakes of consecutive batches. Listings with equal sets are one node per batch while searching and are told
    apart again at the end. Listings without a key, without a batch, or not in `lists` have no counterpart.
    """
    keys = written(listing_keys(olist), "listing-keys")
    sig = signatures(keys).join(lists.select("list_id", "batch").where("batch IS NOT NULL").distinct(), "list_id")
    # The class of equal sets: its smallest list. A node is a class within a batch, named by its smallest list there.
    members = written(sig, "signatures")
    classes = members.groupBy("f1", "f2", "n", "batch").agg(F.min("list_id").alias("node"), F.first("sig").alias("sig"))
    nodes = written(classes.select("node", F.col("batch").cast("int").alias("batch"), "n", "sig", "f1", "f2"), "listing-nodes", "batch")  # an intake reads its batches only
    sizes = {r["batch"]: r["n"] for r in nodes.groupBy("batch").agg(F.count("*").alias("n")).collect()}  # a row a batch
    index = index or ShardIndex(lists.sparkSession, similarity=similarity)
    found = lists.sparkSession.createDataFrame([], "a long, b long")
    for run in [[b] for b in sorted(sizes)] if parts is None else intakes(sizes, parts):
        found = found.unionByName(index.add(nodes.where(F.col("batch").between(run[0], run[-1])).select("node", "batch", "sig")))
    exact = verified(found.distinct(), keys, nodes.select(F.col("node").alias("list_id"), "n", "f1", "f2"), similarity)
    of = members.join(nodes.select("f1", "f2", "n", "batch", "node"), ["f1", "f2", "n", "batch"]).select("list_id", "node")
    wide = exact.join(of.select(F.col("node").alias("a"), F.col("list_id").alias("la")), "a").join(of.select(F.col("node").alias("b"), F.col("list_id").alias("lb")), "b")
    return wide.select(F.least("la", "lb").alias("list_a"), F.greatest("la", "lb").alias("list_b"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counterparts(table(spark, sf_dir, "p2cd"), table(spark, sf_dir, "olist"))


def p3_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """list_id, batch, found, exact: counterparts by the graphs and by brute force for each list whose id 20 divides.

    Brute force joins the keys of those lists with all keys, so it misses nothing.
    """
    lists, olist = table(spark, sf_dir, "p2cd"), table(spark, sf_dir, "olist")
    got = written(counterparts(lists, olist), "counterparts")
    either = got.select(F.col("list_a").alias("list_id"), F.col("list_b").alias("other")).unionByName(got.select(F.col("list_b").alias("list_id"), F.col("list_a").alias("other")))
    keys = written(listing_keys(olist).join(lists.select("list_id", "batch"), "list_id"), "listing-keys")
    n = keys.groupBy("list_id").agg(F.count("*").alias("n"))
    q = keys.where("list_id % 20 = 0")
    common = q.alias("q").join(keys.alias("k"), "h").where("q.batch <> k.batch").groupBy(F.col("q.list_id").alias("list_id"), F.col("k.list_id").alias("other")).agg(F.count("*").alias("c"))
    exact = common.join(n, "list_id").join(n.select(F.col("list_id").alias("other"), F.col("n").alias("m")), "other").where("c >= 0.6 * (n + m - c)").select("list_id", "other")
    both = exact.join(either.withColumn("hit", F.lit(1)), ["list_id", "other"], "left").groupBy("list_id").agg(F.count("*").alias("exact"), F.count("hit").alias("found"))
    return lists.where("list_id % 20 = 0").select("list_id", "batch").join(both, "list_id", "left").select("list_id", "batch", F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("exact", F.lit(0)).alias("exact"))


QUERIES = {"p3_found": p3_found, "p3_recall": p3_recall}

SQL = {
    "p3_found": """
        WITH k AS (
            SELECT DISTINCT list_id, lower(regexp_replace(sha, '^[\\s\\p{Z}\\p{Cc}\\p{Cf}]+|[\\s\\p{Z}\\p{Cc}\\p{Cf}]+$', '', 'g')) AS key
            FROM olist WHERE list_id IS NOT NULL),
        v AS (SELECT k.*, p.batch FROM k JOIN p2cd p USING (list_id) WHERE regexp_full_match(key, '[0-9a-f]{40}')),
        n AS (SELECT list_id, count(*) AS n FROM v GROUP BY list_id),
        c AS (SELECT a.list_id AS list_a, b.list_id AS list_b, count(*) AS c FROM v a JOIN v b
              ON a.key = b.key AND a.list_id < b.list_id AND a.batch <> b.batch GROUP BY 1, 2)
        SELECT list_a, list_b FROM c JOIN n x ON x.list_id = list_a JOIN n y ON y.list_id = list_b
        WHERE c >= 0.6 * (x.n + y.n - c)""",
    "p3_recall": """
        WITH k AS (
            SELECT DISTINCT list_id, lower(regexp_replace(sha, '^[\\s\\p{Z}\\p{Cc}\\p{Cf}]+|[\\s\\p{Z}\\p{Cc}\\p{Cf}]+$', '', 'g')) AS key
            FROM olist WHERE list_id IS NOT NULL),
        v AS (SELECT k.*, p.batch FROM k JOIN p2cd p USING (list_id) WHERE regexp_full_match(key, '[0-9a-f]{40}')),
        n AS (SELECT list_id, count(*) AS n FROM v GROUP BY list_id),
        c AS (SELECT a.list_id, b.list_id AS other, count(*) AS c FROM v a JOIN v b ON a.key = b.key AND a.batch <> b.batch WHERE a.list_id % 20 = 0 GROUP BY 1, 2),
        g AS (SELECT c.list_id, count(*) AS n FROM c JOIN n x ON x.list_id = c.list_id JOIN n y ON y.list_id = other WHERE c >= 0.6 * (x.n + y.n - c) GROUP BY 1)
        SELECT list_id, batch, coalesce(g.n, 0) AS found, coalesce(g.n, 0) AS exact FROM p2cd LEFT JOIN g USING (list_id) WHERE list_id % 20 = 0""",
}

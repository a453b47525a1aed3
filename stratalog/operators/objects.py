"""Walks and lookups over objects: peeling, packs, folder closures, iterators, range joins, prefixes, garbage roots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalog.operators.graph import closure, generations
from stratalog.plans import model as M
from stratalog.plans.lineage import discard, written
from stratalog.plans.model import valid_sha, with_sql
from stratalog.plans.prefix import running_sum
from stratalog.sources.tables import table


def peel(tags: DataFrame) -> DataFrame:
    """tag, kind, oid, hops: what a tag finally names. tags: tag, kind, target; kind `tag` names another tag.

    Every round doubles the length of the chains that are followed. A tag that names an unknown tag keeps that name;
    hops counts the tags passed. A tag whose chain runs into a circle keeps the name it gives itself, one hop away: no
    other chain is longer than there are tags, so what still moves by then has no end. Equal rows count once.
    """
    first = F.col("target")
    now = written(tags.select("tag", "kind", first.alias("oid"), F.lit(1).alias("hops"), first.alias("first")).distinct(), "peeled")
    most, reach = now.count(), 1
    while True:
        far = now.select(F.col("tag").alias("_t"), F.col("kind").alias("_k"), F.col("oid").alias("_o"), F.col("hops").alias("_h"))
        hit = (F.col("kind") == "tag") & F.col("_t").isNotNull()
        circles = F.lit(reach >= most)
        kind, oid = F.when(hit & ~circles, F.col("_k")).otherwise(F.col("kind")), F.when(hit & circles, F.col("first")).when(hit, F.col("_o")).otherwise(F.col("oid"))
        hops = F.when(hit & circles, F.lit(1)).when(hit, F.col("hops") + F.col("_h")).otherwise(F.col("hops"))
        new = written(now.join(far, (F.col("kind") == "tag") & (F.col("oid") == F.col("_t")), "left").select("tag", kind.alias("kind"), oid.alias("oid"), hops.alias("hops"), "first", hit.alias("moved")), "peeled")
        discard(now)
        now = new
        if reach >= most or new.where("moved").isEmpty():
            return new.select("tag", "kind", "oid", "hops")
        reach *= 2


def range_join(points: DataFrame, ranges: DataFrame, group: str, at: str, lo: str, hi: str) -> DataFrame:
    """Rows of `points` with those of `ranges` of the same `group` that hold them: lo <= at < hi. Other columns are kept
    and must differ in name. Null positions and empty ranges meet nothing.

    A range of length up to 2**k lies in at most two cells of that width, so it is two rows whatever its length; a point
    looks into one cell per width that occurs (at most 64). Both sides meet by equal cells, which spreads any group.
    """
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.col(hi) - F.col(lo))).cast("int"))
    r = ranges.where(F.col(lo) < F.col(hi)).withColumn("_w", level)
    cells = F.array_distinct(F.array(F.floor(F.col(lo) / F.pow(F.lit(2.0), "_w")), F.floor((F.col(hi) - 1) / F.pow(F.lit(2.0), "_w"))))
    r = r.select(F.col(group).alias("_g"), *[c for c in ranges.columns if c != group], "_w", F.explode(cells).alias("_c"))
    widths = sorted(x["_w"] for x in r.select("_w").distinct().collect())
    if not widths:
        return points.join(ranges, group).limit(0)
    p = points.where(F.col(at).isNotNull()).withColumn("_v", F.explode(F.array(*map(F.lit, widths)))).withColumn("_d", F.floor(F.col(at) / F.pow(F.lit(2.0), "_v")))
    met = p.join(r, (F.col(group) == F.col("_g")) & (F.col("_v") == F.col("_w")) & (F.col("_d") == F.col("_c")) & (F.col(at) >= F.col(lo)) & (F.col(at) < F.col(hi)))
    return met.select(*points.columns, *[c for c in ranges.columns if c != group])


def folders_of(path: Column) -> Column:
    """array<string>: the folders above a path, outermost first; empty for a path at the root."""
    parts = F.split(path, "/")
    some = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    return F.when(F.size(parts) > 1, some).otherwise(F.array().cast("array<string>"))


def folder_closure(paths: DataFrame) -> DataFrame:
    """folder, files, depth: how many distinct paths lie below each folder at any depth, and the deepest of them."""
    d = paths.where("path IS NOT NULL").select("path").distinct()
    x = d.select(F.explode(folders_of(F.col("path"))).alias("folder"), F.size(F.split("path", "/")).alias("n"))
    return x.groupBy("folder").agg(F.count("*").alias("files"), (F.max("n") - F.size(F.split("folder", "/"))).alias("depth"))


def iterate(paths: DataFrame, start: str | None = None, end: str | None = None, pathlist: list[str] | None = None, trees: bool = True) -> DataFrame:
    """path, kind: a flat list of paths (path) as an iterator walks it: folders as pseudo-trees before what is in them.

    start, end: first and last path of the range, both included; a folder counts as the range it spans. pathlist: only
    these paths, folders with all below them. Order by path gives the walk.
    """
    files = paths.where("path IS NOT NULL").select("path").distinct()
    if start is not None:
        files = files.where((F.col("path") >= start) | F.col("path").startswith(start + "/"))
    if end is not None:
        files = files.where((F.col("path") <= end) | F.col("path").startswith(end + "/"))
    if pathlist is not None:
        keep = F.lit(False)
        for p in pathlist:
            keep = keep | (F.col("path") == p.rstrip("/")) | F.col("path").startswith(p.rstrip("/") + "/")
        files = files.where(keep)
    out = files.select("path", F.lit("blob").alias("kind"))
    return out.unionByName(files.select(F.explode(folders_of(F.col("path"))).alias("path")).distinct().select("path", F.lit("tree").alias("kind"))) if trees else out


def resolve_prefixes(prefixes: DataFrame, oids: DataFrame) -> DataFrame:
    """prefix, oid, state: the object that each prefix (4 digits or more) names: FOUND, AMBIGUOUS or MISSING.

    Both sides meet by the first four digits and then by the whole prefix; shorter prefixes are AMBIGUOUS.
    """
    p = prefixes.where("prefix IS NOT NULL").select(F.lower("prefix").alias("prefix")).distinct()
    o = oids.select("sha").distinct().select(F.substring("sha", 1, 4).alias("_k"), "sha")
    met = p.where(F.length("prefix") >= 4).withColumn("_k", F.substring("prefix", 1, 4)).join(o, "_k").where(F.col("sha").startswith(F.col("prefix")))
    n = met.groupBy("prefix").agg(F.count("*").alias("n"), F.min("sha").alias("sha"))
    state = F.when((F.length("prefix") < 4) | (F.col("n") > 1), "AMBIGUOUS").when(F.col("n") == 1, "FOUND").otherwise("MISSING")
    return p.join(n, "prefix", "left").select("prefix", F.when(state == "FOUND", F.col("sha")).alias("oid"), state.alias("state"))


def pack_objects(commits: DataFrame, known: DataFrame, entries: DataFrame) -> DataFrame:
    """kind, oid: commits (oid), their trees and entries, without the trees and entries that `known` commits have."""
    def held(c: DataFrame) -> DataFrame:
        e = entries.join(c.select(F.col("oid").alias("tree")), "tree", "left_semi")
        return e.select(F.lit("tree").alias("kind"), F.col("tree").alias("oid")).unionByName(e.select(F.lit("blob").alias("kind"), "oid")).distinct()

    return commits.select(F.lit("commit").alias("kind"), "oid").unionByName(held(commits).join(held(known), ["kind", "oid"], "left_anti"))


# ------------------------------------------------------------------------------------------------------------- queries


def q_peel(s: SparkSession, d: str) -> DataFrame:
    """Tags on urgent commits; where half the key is another urgent commit, the tag names its tag (0 is its own half)."""
    urgent = M.commits(s, d).where("subject = '1-URGENT'").select("oid").distinct()
    other = urgent.select(F.col("oid").alias("half"))
    t = urgent.join(other, (F.expr("oid div 2") == F.col("half")) & (F.col("oid") != F.col("half")), "left")
    return peel(t.select((-F.col("oid")).alias("tag"), F.when(F.col("half").isNotNull(), "tag").otherwise("commit").alias("kind"), F.coalesce(-F.col("half"), F.col("oid")).alias("target")))


def q_range_join(s: SparkSession, d: str) -> DataFrame:
    """idx_id, id: the store record that holds each index offset of its section."""
    p = table(s, d, "idx").select("idx_id", "sec", F.col("off").alias("at"))
    r = table(s, d, "store_idx").select("sec", "id", F.col("off").alias("lo"), (F.col("off") + F.col("len")).alias("hi"))
    return range_join(p, r, "sec", "at", "lo", "hi").select("idx_id", "id")


def q_folder_closure(s: SparkSession, d: str) -> DataFrame:
    return folder_closure(table(s, d, "olist"))


def q_index_iterator(s: SparkSession, d: str) -> DataFrame:
    return iterate(table(s, d, "olist"))


def q_iterator_range(s: SparkSession, d: str) -> DataFrame:
    return iterate(table(s, d, "olist"), start="cmd", end="lib", pathlist=["docs", "lib", "cmd/"], trees=False)


def q_prefixes(s: SparkSession, d: str) -> DataFrame:
    """Wanted ids cut to two to six digits, against the store and the index."""
    w = table(s, d, "backfill").where(valid_sha(F.col("oid"))).select(F.substring(F.col("oid"), F.lit(1), (F.col("bf_id") % 5 + 2).cast("int")).alias("prefix"))
    have = table(s, d, "store_idx").select("sha").unionByName(table(s, d, "idx").where(valid_sha(F.col("sha"))).select("sha"))
    return resolve_prefixes(w, have)


def q_pack_walk(s: SparkSession, d: str) -> DataFrame:
    """What a fetch of all heads must send to one who has each project's second-newest commit."""
    w = Window.partitionBy("project").orderBy(F.desc("oid"))
    old = M.commits(s, d).withColumn("r", F.row_number().over(w)).where("r = 2").select(F.lit(1).alias("root"), "oid")
    both = written(closure(M.edges(s, d), M.heads(s, d).select(F.lit(0).alias("root"), F.col("head").alias("oid")).unionByName(old)), "reach")
    known = both.where("root = 1").select("oid")
    return pack_objects(both.where("root = 0").select("oid").join(known, "oid", "left_anti"), known, M.tree_entries(s, d))


def q_negotiation(s: SparkSession, d: str) -> DataFrame:
    """project, want, common: each project's head as what is wanted, and the newest commit of it that one who has all
    commits of even projects has in common."""
    h = M.heads(s, d)
    haves = M.commits(s, d).where("project % 2 = 0").select("oid")
    walk = closure(M.parents(s, d).where("pos = 0").select("oid", "parent"), h.select(F.col("head").alias("root"), F.col("head").alias("oid")))
    common = walk.join(haves, "oid", "left_semi").groupBy(F.col("root").alias("head")).agg(F.max("oid").alias("common"))
    return h.join(common, "head", "left").select("project", F.col("head").alias("want"), "common")


def q_generation_order(s: SparkSession, d: str) -> DataFrame:
    """oid, place: commits by generation from the highest, then the newest, then the smaller id."""
    c = M.commits(s, d).select("oid", (-F.unix_micros(F.col("time").cast("timestamp"))).alias("back"))
    g = generations(c, M.edges(s, d)).join(c, "oid").select("oid", (-F.col("generation")).alias("down"), "back", F.lit(1).alias("one"))
    return running_sum(g, [], ["down", "back", "oid"], "one", "place").select("oid", "place")


def q_reverse(s: SparkSession, d: str) -> DataFrame:
    """oid, place: the order by time reversed: the oldest first, ties by larger id."""
    c = M.commits(s, d).select("oid", F.unix_micros(F.col("time").cast("timestamp")).alias("t"), (-F.col("oid")).alias("back"), F.lit(1).alias("one"))
    return running_sum(c, [], ["t", "back"], "one", "place").select("oid", "place")


def q_garbage_roots(s: SparkSession, d: str) -> DataFrame:
    """sha, kept_by: every object of the index, listed, only in a reflog, or unreachable: the first that holds."""
    names = [("reachable", table(s, d, "olist").select("sha")), ("reflog", table(s, d, "p2tips").select(F.col("commit_sha").alias("sha"))), ("unreachable", table(s, d, "idx").select("sha"))]
    u = reduce(DataFrame.unionByName, [x.where(valid_sha(F.col("sha"))).select("sha", F.struct(F.lit(i).alias("i"), F.lit(n).alias("kept_by")).alias("k")) for i, (n, x) in enumerate(names)])
    return u.groupBy("sha").agg(F.min("k").alias("k")).select("sha", "k.kept_by")


def q_tree_filter(s: SparkSession, d: str) -> DataFrame:
    """tree, name, oid of trees from which a builder's filter has removed folders."""
    remove = F.col("mode") == "040000"
    return M.tree_entries(s, d).where(~remove).select("tree", "name", "oid")


def q_oversized(s: SparkSession, d: str) -> DataFrame:
    """idx_id of records that readers with 31-bit lengths can take (lengths counted in millions here); unknown ones stay."""
    return table(s, d, "idx").where(~F.coalesce(F.col("storedlen") * 1_000_000 > (1 << 31) - 1, F.lit(False))).select("idx_id")


def commit_graph(commits: DataFrame, parents: DataFrame) -> DataFrame:
    """oid, time, parents array, generation, corrected: the stored form of a history, written once and read by walks.

    corrected: a date that never lies before an ancestor's by construction of its generation; here the commit's own time
    or one more than its parents' largest, whichever is later, over one step. A missing parent is left out of the list.
    """
    listed = parents.groupBy("oid").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "parent"))), lambda x: x["parent"]).alias("parents"))
    when = commits.select("oid", F.unix_seconds(F.col("time").cast("timestamp")).alias("time"))
    latest = parents.select("oid", "parent").join(when.select(F.col("oid").alias("parent"), F.col("time").alias("pt")), "parent").groupBy("oid").agg(F.max("pt").alias("pt"))
    g = generations(commits, parents.select("oid", "parent").distinct())
    rows = when.join(g, "oid").join(listed, "oid", "left").join(latest, "oid", "left")
    return written(rows.select("oid", "time", F.coalesce("parents", F.array().cast("array<bigint>")).alias("parents"), "generation", F.greatest(F.col("time"), F.coalesce(F.col("pt") + 1, F.col("time"))).alias("corrected")), "commit-graph")


def ordered_gather(wanted: DataFrame, index: DataFrame) -> DataFrame:
    """place, sha, sec, off: the wanted objects (sha) in the order in which a store is read best: by section and offset.

    index: sha (unique), sec, off. Objects that it lacks are left out; repeated wishes count once.
    """
    have = wanted.select("sha").distinct().join(index.select("sha", "sec", "off"), "sha").withColumn("_1", F.lit(1))
    return running_sum(have, [], ["sec", "off", "sha"], "_1", "place").select("place", "sha", "sec", "off")


def multi_pack_index(records: DataFrame) -> DataFrame:
    """sha, pos, fan, pack, off: each object once, from its most recent pack, with its position in the order of ids and how
    many ids begin with a smaller or the same first byte. records: sha, pack, off, at (recency; null counts as oldest)."""
    newest = F.struct(F.col("at").isNotNull(), F.col("at"), F.col("pack"))
    one = records.groupBy("sha").agg(F.max_by(F.struct("pack", "off"), newest).alias("x")).select("sha", "x.pack", "x.off").withColumn("_1", F.lit(1))
    ranked = running_sum(one, [], ["sha"], "_1", "pos")
    first = F.substring("sha", 1, 2)
    fan = ranked.groupBy(first.alias("_b")).agg(F.max("pos").alias("fan"))  # at most 256 rows
    return ranked.join(F.broadcast(fan), first == F.col("_b")).select("sha", (F.col("pos") - 1).alias("pos"), "fan", "pack", "off")


def q_commit_graph(s: SparkSession, d: str) -> DataFrame:
    return commit_graph(M.commits(s, d), M.parents(s, d)).select("oid", "time", F.array_join(F.transform("parents", lambda x: x.cast("string")), " ").alias("parents"), "generation", "corrected")


def q_gather(s: SparkSession, d: str) -> DataFrame:
    have = table(s, d, "idx").where(valid_sha(F.col("sha"))).groupBy("sha").agg(F.min(F.struct("sec", "off")).alias("x")).select("sha", "x.*")
    return ordered_gather(table(s, d, "backfill").select(F.col("oid").alias("sha")), have)


def q_multi_pack(s: SparkSession, d: str) -> DataFrame:
    i = table(s, d, "idx").where(valid_sha(F.col("sha")))
    return multi_pack_index(i.select("sha", F.col("idx_id").alias("pack"), "off", F.unix_micros(F.col("dumped_at").cast("timestamp")).alias("at")))


def q_want_list(s: SparkSession, d: str) -> DataFrame:
    """oid, first_id, times: what a backfill still has to fetch: well-formed wishes that no layer holds, once each."""
    have = table(s, d, "store_idx").select("sha").unionByName(table(s, d, "idx").select("sha"))
    w = table(s, d, "backfill").where(valid_sha(F.col("oid"))).groupBy("oid").agg(F.min("bf_id").alias("first_id"), F.count("*").alias("times"))
    return w.join(have.select(F.col("sha").alias("oid")), "oid", "left_anti")


def q_object_rows(s: SparkSession, d: str) -> DataFrame:
    """repo, type, sha: each repository's list of distinct objects."""
    return table(s, d, "olist").where(valid_sha(F.col("sha"))).select("repo", "type", "sha").distinct()


def q_dump_records(s: SparkSession, d: str) -> DataFrame:
    """idx_id, type, sec, valid: every record with the partition that a dump writes it to; broken ids go to none."""
    ok = F.coalesce(valid_sha(F.col("sha")), F.lit(False))
    return table(s, d, "idx").select("idx_id", "type", F.when(ok, M.section(F.when(ok, F.col("sha")))).alias("sec"), (ok & (F.coalesce("storedlen", F.lit(0)) > 0)).alias("valid"))


QUERIES = {
    "commit_graph": q_commit_graph, "ordered_gather": q_gather, "multi_pack_index": q_multi_pack, "want_list": q_want_list, "object_rows": q_object_rows, "dump_records": q_dump_records, 
    "peel": q_peel, "range_join": q_range_join, "folder_closure": q_folder_closure, "index_iterator": q_index_iterator, "iterator_range": q_iterator_range, "prefix_resolve": q_prefixes, "pack_walk": q_pack_walk, "fetch_negotiation": q_negotiation,
    "generation_order": q_generation_order, "revwalk_reverse": q_reverse, "garbage_roots": q_garbage_roots, "treebuilder_filter": q_tree_filter, "oversized_drop": q_oversized,
}

_FOLDERS = "SELECT path, array_to_string(p[1:i], '/') AS folder, i FROM (SELECT path, string_split(path, '/') AS p, unnest(range(1, len(string_split(path, '/')))) AS i FROM (SELECT DISTINCT path FROM olist WHERE path IS NOT NULL))"
_V = "regexp_full_match({0}, '[0-9a-f]{{40}}')"
_OLD_NEW = ", o AS (SELECT oid FROM (SELECT oid, row_number() OVER (PARTITION BY project ORDER BY oid DESC) AS r FROM commits) WHERE r = 2 UNION SELECT e.parent FROM o JOIN edges e ON e.oid = o.oid), n AS (SELECT head AS oid FROM heads UNION SELECT e.parent FROM n JOIN edges e ON e.oid = n.oid)"
SQL = {
    "peel": "WITH RECURSIVE u AS (SELECT o_orderkey AS oid FROM orders WHERE o_orderpriority = '1-URGENT'), w AS (SELECT oid AS tag, oid AS x, 1 AS hops FROM u UNION ALL SELECT tag, u.oid, hops + 1 FROM w JOIN u ON u.oid = w.x // 2) SELECT -tag AS tag, 'commit' AS kind, min(x) AS oid, max(hops) AS hops FROM w GROUP BY tag",
    "range_join": "SELECT idx_id, s.id FROM idx i JOIN store_idx s ON s.sec = i.sec AND i.off >= s.off AND i.off < s.off + s.len",
    "folder_closure": f"SELECT folder, count(*) AS files, (max(len(string_split(path, '/'))) - len(string_split(folder, '/')))::INT AS depth FROM ({_FOLDERS}) GROUP BY folder",
    "index_iterator": f"SELECT DISTINCT path, 'blob' AS kind FROM olist WHERE path IS NOT NULL UNION ALL SELECT DISTINCT folder, 'tree' FROM ({_FOLDERS})",
    "iterator_range": "SELECT DISTINCT path, 'blob' AS kind FROM olist WHERE path >= 'cmd' AND (path <= 'lib' OR starts_with(path, 'lib/')) AND (path IN ('docs', 'lib', 'cmd') OR regexp_matches(path, '^(docs|lib|cmd)/'))",
    "prefix_resolve": "WITH w AS (SELECT DISTINCT substr(oid, 1, (bf_id % 5 + 2)::INT) AS prefix FROM backfill WHERE " + _V.format("oid") + "), h AS (SELECT sha FROM store_idx UNION SELECT sha FROM idx WHERE " + _V.format("sha") + "), x AS (SELECT l, substr(sha, 1, l) AS prefix, count(*) AS n, min(sha) AS sha FROM h, range(4, 7) t(l) GROUP BY ALL) SELECT w.prefix, CASE WHEN n = 1 THEN sha END AS oid, CASE WHEN length(w.prefix) < 4 OR n > 1 THEN 'AMBIGUOUS' WHEN n = 1 THEN 'FOUND' ELSE 'MISSING' END AS state FROM w LEFT JOIN x ON x.prefix = w.prefix",
    "pack_walk": with_sql("commits parents edges heads entries", _OLD_NEW + ", c AS (SELECT oid FROM n EXCEPT SELECT oid FROM o), a AS (SELECT 'tree' AS kind, tree AS oid FROM entries JOIN c ON c.oid = tree UNION SELECT 'blob', e.oid FROM entries e JOIN c ON c.oid = tree), b AS (SELECT 'tree' AS kind, tree AS oid FROM entries JOIN o ON o.oid = tree UNION SELECT 'blob', e.oid FROM entries e JOIN o ON o.oid = tree) SELECT 'commit' AS kind, oid FROM c UNION ALL SELECT * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)"),
    "fetch_negotiation": "WITH h AS (SELECT o_custkey AS project, max(o_orderkey) AS head FROM orders GROUP BY 1) SELECT project, head AS want, CASE WHEN project % 2 = 0 THEN head END AS common FROM h",
    "generation_order": with_sql("commits parents edges", ", g AS (SELECT oid, 1 AS generation FROM commits WHERE oid NOT IN (SELECT oid FROM edges) UNION SELECT e.oid, g.generation + 1 FROM g JOIN edges e ON e.parent = g.oid), m AS (SELECT oid, max(generation) AS generation FROM g GROUP BY oid) SELECT oid, row_number() OVER (ORDER BY generation DESC, time DESC, oid) AS place FROM m JOIN commits USING (oid)"),
    "revwalk_reverse": "SELECT o_orderkey AS oid, row_number() OVER (ORDER BY o_orderdate, o_orderkey DESC) AS place FROM orders",
    "garbage_roots": "WITH u AS (SELECT sha, 0 AS i, 'reachable' AS k FROM olist UNION ALL SELECT commit_sha, 1, 'reflog' FROM p2tips UNION ALL SELECT sha, 2, 'unreachable' FROM idx) SELECT sha, arg_min(k, i) AS kept_by FROM u WHERE " + _V.format("sha") + " GROUP BY sha",
    "treebuilder_filter": "SELECT l_orderkey AS tree, l_linenumber AS name, min(l_partkey) AS oid FROM lineitem GROUP BY 1, 2 HAVING min(l_returnflag) <> 'A'",
    "oversized_drop": "SELECT idx_id FROM idx WHERE storedlen IS NULL OR storedlen * 1000000 <= 2147483647",
    "commit_graph": with_sql("commits parents edges", ", g AS (SELECT oid, 1 AS generation FROM commits WHERE oid NOT IN (SELECT oid FROM edges) UNION SELECT e.oid, g.generation + 1 FROM g JOIN edges e ON e.parent = g.oid), m AS (SELECT oid, max(generation) AS generation FROM g GROUP BY oid), p AS (SELECT p.oid, string_agg(p.parent::VARCHAR, ' ' ORDER BY pos) AS parents, max(epoch(c.time)::BIGINT) AS pt FROM parents p JOIN commits c ON c.oid = p.parent GROUP BY p.oid) SELECT oid, epoch(time)::BIGINT AS time, coalesce(parents, '') AS parents, generation, greatest(epoch(time)::BIGINT, coalesce(pt + 1, epoch(time)::BIGINT)) AS corrected FROM commits JOIN m USING (oid) LEFT JOIN p USING (oid)"),
    "ordered_gather": "WITH h AS (SELECT sha, min(struct_pack(sec := sec, off := off)) AS x FROM idx WHERE " + _V.format("sha") + " GROUP BY sha) SELECT row_number() OVER (ORDER BY x.sec, x.off, sha) AS place, sha, x.sec AS sec, x.off AS off FROM h WHERE sha IN (SELECT oid FROM backfill)",
    "multi_pack_index": "WITH o AS (SELECT sha, idx_id AS pack, off FROM (SELECT *, row_number() OVER (PARTITION BY sha ORDER BY dumped_at DESC NULLS LAST, idx_id DESC) AS k FROM idx WHERE " + _V.format("sha") + ") WHERE k = 1) SELECT sha, row_number() OVER (ORDER BY sha) - 1 AS pos, count(*) OVER (ORDER BY substr(sha, 1, 2)) AS fan, pack, off FROM o",
    "want_list": "SELECT oid, min(bf_id) AS first_id, count(*) AS times FROM backfill WHERE " + _V.format("oid") + " AND oid NOT IN (SELECT sha FROM store_idx) AND oid NOT IN (SELECT sha FROM idx WHERE sha IS NOT NULL) GROUP BY oid",
    "object_rows": "SELECT DISTINCT repo, type, sha FROM olist WHERE " + _V.format("sha"),
    "dump_records": "SELECT idx_id, type, CASE WHEN " + _V.format("sha") + " THEN (('0x' || substr(sha, 1, 2))::INT & 127) END AS sec, coalesce(" + _V.format("sha") + ", false) AND coalesce(storedlen, 0) > 0 AS valid FROM idx",
}

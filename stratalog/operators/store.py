"""The layered object store: scans, set operations between generations, lookups, gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalog.functions.scalars import PROJECT_SQL, url_to_project
from stratalog.plans import model as M
from stratalog.plans.model import section, valid_sha, with_sql
from stratalog.plans.prefix import running_sum
from stratalog.sources.tables import table


def objects(s: SparkSession, d: str) -> DataFrame:
    """oid, type, size, sec: the documents as content-addressed blobs, one row per document; null texts have no object."""
    t = table(s, d, "documents").where("text IS NOT NULL")
    return t.select("doc_id", M.blob_oid(F.col("text")).alias("oid"), F.lit("blob").alias("type"), F.octet_length(F.encode("text", "utf-8")).cast("long").alias("size")).withColumn("sec", section(F.col("oid")))


def content_addressed(s: SparkSession, d: str) -> DataFrame:
    """oid, size, copies, doc_id: each distinct object once, with its copies and first document."""
    return objects(s, d).groupBy("oid", "size").agg(F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"))


def object_list(s: SparkSession, d: str) -> DataFrame:
    """repo, type, objects: distinct valid objects per listed repository and type."""
    return table(s, d, "olist").where(valid_sha(F.col("sha"))).groupBy("repo", "type").agg(F.countDistinct("sha").alias("objects"))


def classify(s: SparkSession, d: str) -> DataFrame:
    """bf_id, type: the type of each wanted object in the batch index, null if it isn't there."""
    kinds = table(s, d, "idx").where(valid_sha(F.col("sha"))).groupBy(F.col("sha").alias("oid")).agg(F.min("type").alias("found"))
    return table(s, d, "backfill").select("bf_id", "oid").join(kinds, "oid", "left").select("bf_id", F.col("found").alias("type"))


def offset_lookup(s: SparkSession, d: str) -> DataFrame:
    """bf_id, off, len, state: store record of each wanted object; MISS rows stay."""
    st = table(s, d, "store_idx").select(F.col("sha").alias("oid"), "off", "len")
    return table(s, d, "backfill").select("bf_id", "oid").join(st, "oid", "left").select("bf_id", "off", "len", F.when(F.col("off").isNull(), "MISS").otherwise("HIT").alias("state"))


def generation_append(idx: DataFrame, known: DataFrame) -> DataFrame:
    """sec, id, off, storedlen, sha, repo: the records a new generation takes in.

    Invalid records (no well-formed sha, or no stored length above 0) are skipped before the first record of a sha is
    chosen, so a broken one never hides a sound one. Records already in `known` (sha) are left out. Offsets and ids
    are counted anew within each section. Equal idx_id do not occur.
    """
    ok = idx.where(valid_sha(F.col("sha")) & (F.col("storedlen") > 0)).join(known.select("sha"), "sha", "left_anti")
    first = ok.groupBy("sha").agg(F.min_by(F.struct("idx_id", "storedlen", "repo"), "idx_id").alias("x")).select("sha", "x.idx_id", "x.storedlen", "x.repo").withColumn("sec", section(F.col("sha")))
    numbered = running_sum(first.withColumn("_1", F.lit(1)), ["sec"], ["idx_id"], ["storedlen", "_1"], ["_end", "_no"])
    return numbered.select("sec", (F.col("_no") - 1).alias("id"), (F.col("_end") - F.col("storedlen")).alias("off"), "storedlen", "sha", "repo")


def q_generation_append(s: SparkSession, d: str) -> DataFrame:
    return generation_append(table(s, d, "idx"), table(s, d, "store_idx"))


def gen_minus_base(s: SparkSession, d: str) -> DataFrame:
    """type, sha: distinct listed objects that the store does not hold."""
    o = table(s, d, "olist").where(valid_sha(F.col("sha"))).select("type", "sha").distinct()
    return o.join(table(s, d, "store_idx"), "sha", "left_anti").select("type", "sha")


def overlap(base: DataFrame, gen: DataFrame) -> DataFrame:
    """sha in both layers: should be empty after a clean fold."""
    return base.select("sha").intersect(gen.select("sha"))


def base_gen_overlap(s: SparkSession, d: str) -> DataFrame:
    """The store against listed objects, of which it holds many: what a fold must leave out."""
    return overlap(table(s, d, "store_idx"), table(s, d, "olist"))


def watermarks(s: SparkSession, d: str) -> DataFrame:
    """sec, id, off, len, sha: the last record of each section of the store."""
    return table(s, d, "store_idx").groupBy("sec").agg(F.max_by(F.struct("id", "off", "len", "sha"), "id").alias("x")).select("sec", "x.*")


def delta_list(s: SparkSession, d: str) -> DataFrame:
    """type, sec, sha: index records behind their section's watermark, united with the listed objects not in the store.

    The watermark is the last id that the store has in a section; ids above it are new, and all of a section that the
    store doesn't have yet.
    """
    wm = F.broadcast(table(s, d, "store_idx").groupBy("sec").agg(F.max("id").alias("wm")))  # at most 128 rows
    tail = table(s, d, "idx").join(wm, "sec", "left").where("wm IS NULL OR idx_id > wm").where(valid_sha(F.col("sha"))).select("type", "sec", "sha")
    listed = gen_minus_base(s, d).select("type", section(F.col("sha")).alias("sec"), "sha")
    return tail.unionByName(listed).distinct()


def layered_read(s: SparkSession, d: str) -> DataFrame:
    """sha, layer, len: for each object its record in the first layer that holds a sound one: the store (0), then months
    of the index, last the records without a date (layer null). Within a layer the first record counts."""
    base = table(s, d, "store_idx").select("sha", F.lit(0).alias("layer"), F.col("id").alias("at"), F.col("len"))
    month = F.month(F.col("dumped_at")) + 12 * (F.year(F.col("dumped_at")) - 2020)
    gens = table(s, d, "idx").where(F.col("storedlen") > 0).select("sha", month.alias("layer"), F.col("idx_id").alias("at"), F.col("storedlen").alias("len"))
    rows = base.unionByName(gens).where(valid_sha(F.col("sha")))
    first = F.min_by(F.struct("layer", "len"), F.struct(F.col("layer").isNull(), F.col("layer"), F.col("at")))
    return rows.groupBy("sha").agg(first.alias("x")).select("sha", F.col("x.layer").cast("long").alias("layer"), "x.len")


def as_of_layer(s: SparkSession, d: str) -> DataFrame:
    """layer, objects: how many distinct objects a reader of each month's frozen generation sees."""
    first = table(s, d, "idx").where(valid_sha(F.col("sha")) & F.col("dumped_at").isNotNull()).groupBy("sha").agg(F.min(F.date_trunc("month", "dumped_at")).alias("m"))
    per = first.groupBy("m").agg(F.count("*").alias("n"))  # a row a month
    return per.select(F.date_format("m", "yyyy-MM").alias("layer"), F.sum("n").over(Window.orderBy("m")).alias("objects"))


def parent_gate(s: SparkSession, d: str) -> DataFrame:
    """missing: parents (div 3 of a key, an own edge set) that are no commit; 0 means complete."""
    want = M.commits(s, d).select(F.expr("oid div 3 + 1").alias("oid")).distinct()
    return want.join(M.commits(s, d), "oid", "left_anti").agg(F.count("*").alias("missing"))


def connectivity(s: SparkSession, d: str) -> DataFrame:
    """oid: wanted objects that neither the store, the index nor the object list ever shows."""
    have = table(s, d, "store_idx").select("sha").unionByName(table(s, d, "idx").select("sha")).unionByName(table(s, d, "olist").select("sha"))
    return table(s, d, "backfill").where(valid_sha(F.col("oid"))).select("oid").distinct().join(have.select(F.col("sha").alias("oid")), "oid", "left_anti")


def haves(s: SparkSession, d: str) -> DataFrame:
    """sha: tips united with dropped commits, each once."""
    drop = table(s, d, "olist").where("type = 'commit'").where(valid_sha(F.col("sha"))).select("sha")
    return table(s, d, "p2tips").where("commit_sha IS NOT NULL").select(F.col("commit_sha").alias("sha")).union(drop).distinct()


def tips_csv(s: SparkSession, d: str) -> DataFrame:
    """list_id, tips: each listing's repository with its tips as comma-separated text by shard and id, blank without any.

    Repositories and projects meet by their project name. The text of a project is one value, as the format wants it;
    its tips are combined before the shuffle.
    """
    t = table(s, d, "p2tips").where("p IS NOT NULL AND commit_sha IS NOT NULL").select(url_to_project(F.trim("p")).alias("k"), F.coalesce("shard", F.lit("")).alias("shard"), "commit_sha")
    agg = t.groupBy("k").agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("shard", "commit_sha"))), lambda x: x["commit_sha"]), ",").alias("tips"))
    l = table(s, d, "p2cd").select("list_id", url_to_project(F.trim("repo")).alias("k"))
    return l.join(agg, "k", "left").select("list_id", F.coalesce("tips", F.lit("")).alias("tips"))


def bridge_join(s: SparkSession, d: str) -> DataFrame:
    """nation, tip: tips of each nation's customers through the bridge customer -> project."""
    bridge = table(s, d, "customer").select(F.col("c_custkey").alias("project"), F.col("c_nationkey").alias("k"))
    return table(s, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("nation")).join(bridge, "k").join(M.heads(s, d), "project").select("nation", F.col("head").alias("tip"))


def union_priority(s: SparkSession, d: str) -> DataFrame:
    """sha, backend: the first of several backends that has an object: store, index, object list."""
    parts = [table(s, d, n).where(valid_sha(F.col("sha"))).select("sha", F.lit(i).alias("prio"), F.lit(n).alias("backend")) for i, n in enumerate(("store_idx", "idx", "olist"))]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("sha").agg(F.min(F.struct("prio", "backend")).alias("x")).select("sha", "x.backend")


def refs_scan(s: SparkSession, d: str) -> DataFrame:
    """name, target: loose refs (newest order of a customer) before packed ones (its newest but one, and customers without orders)."""
    w = Window.partitionBy("project").orderBy(F.desc("oid"))
    c = M.commits(s, d).withColumn("r", F.row_number().over(w)).where("r <= 2")
    loose = c.where("r = 1").where("project % 3 = 0").select("project", F.lit(0).alias("prio"), F.col("oid").alias("target"))
    packed = c.where("r = 2").select("project", F.lit(1).alias("prio"), F.col("oid").alias("target"))
    x = loose.unionByName(packed).groupBy("project").agg(F.min(F.struct("prio", "target")).alias("x"))
    return x.select(F.concat(F.lit("refs/heads/c"), F.col("project").cast("string")).alias("name"), "x.target")


def grafted(parents: DataFrame, grafts: DataFrame) -> DataFrame:
    """oid, pos, parent: parents with the lists of `grafts` (oid, parents array) in place of those of the same commit.

    A graft replaces the whole list: an empty one makes a root, and a root may get parents.
    """
    kept = parents.select("oid", "pos", "parent").join(grafts.select("oid"), "oid", "left_anti")
    return kept.unionByName(grafts.select("oid", F.posexplode("parents").alias("pos", "parent")))


def grafts(s: SparkSession, d: str) -> DataFrame:
    """Commits that 100 divides get half and a third of their key as parents, those that 300 divides none."""
    g = M.commits(s, d).where("oid % 100 = 0").select("oid", F.when(F.expr("oid % 300 = 0"), F.array().cast("array<bigint>")).otherwise(F.array(F.expr("oid div 2"), F.expr("oid div 3"))).alias("parents"))
    return grafted(M.parents(s, d), g)


def prefix_lookup(s: SparkSession, d: str) -> DataFrame:
    """prefix, n, state: four-digit prefixes of the store's objects, AMBIGUOUS if several objects have them."""
    n = table(s, d, "store_idx").groupBy(F.substring("sha", 1, 4).alias("prefix")).agg(F.countDistinct("sha").alias("n"))
    return n.select("prefix", "n", F.when(F.col("n") > 1, "AMBIGUOUS").otherwise("UNIQUE").alias("state"))


def unique_prefix(s: SparkSession, d: str) -> DataFrame:
    """sha, len: digits that tell an object of the store from all others.

    Neighbours in order decide. They are sought within the first two digits; what lies beyond shares at most one, and
    is compared through the edges of those groups (at most 256 rows).
    """
    h = table(s, d, "store_idx").select("sha").distinct().withColumn("g", F.substring("sha", 1, 2))
    w = Window.partitionBy("g").orderBy("sha")
    edge = h.groupBy("g").agg(F.min("sha").alias("lo"), F.max("sha").alias("hi"))
    we = Window.orderBy("g")
    edge = F.broadcast(edge.select("g", F.lag("hi").over(we).alias("before"), F.lead("lo").over(we).alias("after")))
    x = h.withColumn("p", F.lag("sha").over(w)).withColumn("n", F.lead("sha").over(w)).join(edge, "g").select("sha", F.coalesce("p", "before").alias("p"), F.coalesce("n", "after").alias("n"))

    def common(a: str) -> F.Column:
        same = F.aggregate(F.sequence(F.lit(1), F.lit(40)), F.lit(0), lambda acc, i: F.when((acc == i - 1) & (F.substring(F.col("sha"), i, F.lit(1)) == F.substring(F.col(a), i, F.lit(1))), i).otherwise(acc))
        return F.when(F.col(a).isNull(), 0).otherwise(same)

    return x.select("sha", (F.greatest(common("p"), common("n")) + 1).alias("len"))


def dump_sections(s: SparkSession, d: str) -> DataFrame:
    """type, sec, objects, bytes: what a dump would write to each partition of type and section; sound records only."""
    i = table(s, d, "idx").where(valid_sha(F.col("sha")))
    return i.groupBy("type", section(F.col("sha")).alias("sec")).agg(F.count("*").alias("objects"), F.sum(F.coalesce("storedlen", F.lit(0))).alias("bytes"))


def recent_pack(s: SparkSession, d: str) -> DataFrame:
    """sha, idx_id: of several records of an object the most recent one (as a multi-pack index chooses); null dates last."""
    i = table(s, d, "idx").where(valid_sha(F.col("sha")))
    return i.groupBy("sha").agg(F.max_by("idx_id", F.struct(F.coalesce(F.unix_micros(F.col("dumped_at").cast("timestamp")), F.lit(-1)), F.col("idx_id"))).alias("idx_id"))


QUERIES = {
    "object_scan": content_addressed, "object_list": object_list, "classify": classify, "offset_lookup": offset_lookup, "generation_append": q_generation_append, "gen_minus_base": gen_minus_base, "base_gen_overlap": base_gen_overlap,
    "watermarks": watermarks, "delta_list": delta_list, "layered_read": layered_read, "as_of_layer": as_of_layer, "parent_gate": parent_gate, "connectivity": connectivity, "haves": haves, "tips_csv": tips_csv, "bridge_join": bridge_join,
    "union_priority": union_priority, "refs_scan": refs_scan, "grafts": grafts, "prefix_lookup": prefix_lookup, "unique_prefix": unique_prefix, "dump_sections": dump_sections, "multi_pack_recent": recent_pack,
}

_V = "regexp_full_match({0}, '[0-9a-f]{{40}}')"
_SEC = "(('0x' || substr({0}, 1, 2))::INT & 127)"
_GMB = "SELECT DISTINCT type, sha FROM olist WHERE " + _V.format("sha") + " AND sha NOT IN (SELECT sha FROM store_idx)"
SQL = {
    "object_scan": "SELECT sha1(encode('blob ' || octet_length(encode(text))::VARCHAR || chr(0) || text)) AS oid, octet_length(encode(text)) AS size, count(*) AS copies, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY 1, 2",
    "object_list": "SELECT repo, type, count(DISTINCT sha) AS objects FROM olist WHERE " + _V.format("sha") + " GROUP BY ALL",
    "classify": "SELECT bf_id, k.type FROM backfill b LEFT JOIN (SELECT sha, min(type) AS type FROM idx WHERE " + _V.format("sha") + " GROUP BY sha) k ON k.sha = b.oid",
    "offset_lookup": "SELECT bf_id, off, len, CASE WHEN off IS NULL THEN 'MISS' ELSE 'HIT' END AS state FROM backfill b LEFT JOIN store_idx s ON s.sha = b.oid",
    "generation_append": "WITH ok AS (SELECT sha, min(idx_id) AS idx_id, arg_min(storedlen, idx_id) AS storedlen, arg_min(struct_pack(r := repo), idx_id).r AS repo FROM idx WHERE " + _V.format("sha") + " AND storedlen > 0 AND sha NOT IN (SELECT sha FROM store_idx) GROUP BY sha), z AS (SELECT *, " + _SEC.format("sha") + " AS sec FROM ok) SELECT sec, row_number() OVER w - 1 AS id, coalesce(sum(storedlen) OVER (PARTITION BY sec ORDER BY idx_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off, storedlen, sha, repo FROM z WINDOW w AS (PARTITION BY sec ORDER BY idx_id)",
    "gen_minus_base": _GMB,
    "base_gen_overlap": "SELECT sha FROM olist INTERSECT SELECT sha FROM store_idx",
    "watermarks": "SELECT sec, max(id) AS id, arg_max(off, id) AS off, arg_max(len, id) AS len, arg_max(sha, id) AS sha FROM store_idx GROUP BY sec",
    "delta_list": "SELECT type, i.sec, sha FROM idx i LEFT JOIN (SELECT sec, max(id) AS wm FROM store_idx GROUP BY sec) w ON w.sec = i.sec WHERE (wm IS NULL OR idx_id > wm) AND " + _V.format("sha") + " UNION SELECT type, " + _SEC.format("sha") + ", sha FROM (" + _GMB + ")",
    "layered_read": "WITH u AS (SELECT sha, 0 AS layer, id AS nr, len FROM store_idx UNION ALL SELECT sha, month(dumped_at) + 12 * (year(dumped_at) - 2020), idx_id, storedlen FROM idx WHERE storedlen > 0), r AS (SELECT *, row_number() OVER (PARTITION BY sha ORDER BY layer NULLS LAST, nr) AS k FROM u WHERE " + _V.format("sha") + ") SELECT sha, layer, len FROM r WHERE k = 1",
    "as_of_layer": "WITH f AS (SELECT sha, min(date_trunc('month', dumped_at)) AS m FROM idx WHERE dumped_at IS NOT NULL AND " + _V.format("sha") + " GROUP BY sha), p AS (SELECT m, count(*) AS n FROM f GROUP BY m) SELECT strftime(m, '%Y-%m') AS layer, sum(n) OVER (ORDER BY m)::BIGINT AS objects FROM p",
    "parent_gate": "SELECT count(*) AS missing FROM (SELECT DISTINCT o_orderkey // 3 + 1 AS k FROM orders) WHERE k NOT IN (SELECT o_orderkey FROM orders)",
    "connectivity": "SELECT DISTINCT oid FROM backfill WHERE " + _V.format("oid") + " AND oid NOT IN (SELECT sha FROM store_idx) AND oid NOT IN (SELECT sha FROM idx WHERE sha IS NOT NULL) AND oid NOT IN (SELECT sha FROM olist WHERE sha IS NOT NULL)",
    "haves": "SELECT commit_sha AS sha FROM p2tips WHERE commit_sha IS NOT NULL UNION SELECT sha FROM olist WHERE type = 'commit' AND " + _V.format("sha"),
    "tips_csv": "WITH t AS (SELECT k, string_agg(commit_sha, ',' ORDER BY shard, commit_sha) AS tips FROM (SELECT DISTINCT " + PROJECT_SQL.format("trim(p, ' ')") + " AS k, coalesce(shard, '') AS shard, commit_sha FROM p2tips WHERE p IS NOT NULL AND commit_sha IS NOT NULL) GROUP BY k) SELECT list_id, coalesce(tips, '') AS tips FROM p2cd LEFT JOIN t ON k = " + PROJECT_SQL.format("trim(repo, ' ')"),
    "bridge_join": with_sql("commits heads", "SELECT n_name AS nation, head AS tip FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN heads ON project = c_custkey"),
    "union_priority": "WITH u AS (SELECT sha, 0 AS p, 'store_idx' AS backend FROM store_idx UNION ALL SELECT sha, 1, 'idx' FROM idx UNION ALL SELECT sha, 2, 'olist' FROM olist) SELECT sha, arg_min(backend, p) AS backend FROM u WHERE " + _V.format("sha") + " GROUP BY sha",
    "refs_scan": with_sql("commits", ", r AS (SELECT *, row_number() OVER (PARTITION BY project ORDER BY oid DESC) AS r FROM commits), u AS (SELECT project, 0 AS p, oid FROM r WHERE r = 1 AND project % 3 = 0 UNION ALL SELECT project, 1, oid FROM r WHERE r = 2) SELECT 'refs/heads/c' || project::VARCHAR AS name, arg_min(oid, p) AS target FROM u GROUP BY project"),
    "grafts": with_sql("commits parents", "SELECT oid, pos, parent FROM parents WHERE oid % 100 <> 0 UNION ALL SELECT oid, 0, oid // 2 FROM commits WHERE oid % 100 = 0 AND oid % 300 <> 0 UNION ALL SELECT oid, 1, oid // 3 FROM commits WHERE oid % 100 = 0 AND oid % 300 <> 0"),
    "prefix_lookup": "SELECT substr(sha, 1, 4) AS prefix, count(DISTINCT sha) AS n, CASE WHEN count(DISTINCT sha) > 1 THEN 'AMBIGUOUS' ELSE 'UNIQUE' END AS state FROM store_idx GROUP BY 1",
    "unique_prefix": "WITH h AS (SELECT DISTINCT sha FROM store_idx), k AS (SELECT n AS len, substr(sha, 1, n) AS p FROM h, range(1, 41) t(n) GROUP BY 1, 2 HAVING count(*) = 1) SELECT sha, min(len)::INT AS len FROM h JOIN k ON k.p = substr(sha, 1, len) GROUP BY sha",
    "dump_sections": "SELECT type, " + _SEC.format("sha") + " AS sec, count(*) AS objects, sum(coalesce(storedlen, 0))::BIGINT AS bytes FROM idx WHERE " + _V.format("sha") + " GROUP BY 1, 2",
    "multi_pack_recent": "SELECT sha, idx_id FROM (SELECT *, row_number() OVER (PARTITION BY sha ORDER BY dumped_at DESC NULLS LAST, idx_id DESC) AS k FROM idx WHERE " + _V.format("sha") + ") WHERE k = 1",
}

"""Aggregations: offenders, dominance, order statistics, tree shapes, edge maps; and orderings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalog.operators.tree_agg import tree_aggregate
from stratalog.plans import model as M
from stratalog.plans.model import valid_sha, with_sql
from stratalog.plans.prefix import running_sum
from stratalog.sources.tables import table

#: File endings that count as source code, and endings of binary files.
CODE_EXT = "c h cpp cc cxx hpp hh hxx py js mjs cjs ts jsx tsx java go rs rb php cs swift kt kts scala sh bash zsh pl pm lua sql css scss less vue svelte r jl dart ex exs erl clj cljs hs ml mli fs fsx f f90 f95 for asm s vhd vhdl v sv gradle cmake mk make proto tf coffee groovy ipynb rkt nim cr zig d pas ada cob".split()
BINARY_EXT = "JPEG ppm wav beam tif dds gsm pyc bz2 PNG JPG pickle woff2 bmp pdf mp3 elc o a so gz png jpg zip class jar bin gif tar tgz ttf jpeg ogg exe dll".split()


def offenders(s: SparkSession, d: str) -> DataFrame:
    """repo, n_bytes, n_rows: repositories whose blobs exceed a byte or row cap, without those to be kept.

    Kept are the repositories of the listings of batch 0.
    """
    b = table(s, d, "idx").where("type = 'blob' AND repo IS NOT NULL")
    per = tree_aggregate(b, ["repo"], {"n_bytes": F.col("storedlen"), "n_rows": F.lit(1)}).where("n_bytes > 100000 OR n_rows > 100")
    keep = table(s, d, "p2cd").where("batch = 0").select("repo").distinct()
    return per.join(keep, "repo", "left_anti").select("repo", "n_bytes", "n_rows")


def shard_sums(s: SparkSession, d: str) -> DataFrame:
    """repo, n_bytes, top_sec: total of the sections' sums and the section with the largest (the smaller number at a tie)."""
    per = tree_aggregate(table(s, d, "idx").where("repo IS NOT NULL"), ["repo", "sec"], {"b": F.col("storedlen")})
    return per.groupBy("repo").agg(F.sum("b").alias("n_bytes"), F.max_by("sec", F.struct(F.col("b"), -F.col("sec"))).alias("top_sec"))


def dominant(rows: DataFrame, chunk: str, least_percent: float = 90) -> DataFrame:
    """chunk, repos, top_percent (rounded), top: chunks of rows (chunk, repo) that one repository dominates or fills alone.

    The share itself is compared with `least_percent`, not its rounding. Rows without a repository do not count.
    """
    c = rows.where("repo IS NOT NULL").groupBy(chunk, "repo").agg(F.count("*").alias("n"))
    g = c.groupBy(chunk).agg(F.count("*").alias("repos"), F.sum("n").alias("tot"), F.max("n").alias("m"), F.max_by("repo", F.struct("n", "repo")).alias("top"))
    return g.where((F.col("repos") == 1) | (100 * F.col("m") >= F.col("tot") * least_percent)).select(chunk, "repos", F.round(100 * F.col("m") / F.col("tot"), 1).alias("top_percent"), "top")


def dominance(s: SparkSession, d: str) -> DataFrame:
    """Listings whose rows, written in several ways, name one repository for nine tenths."""
    return dominant(table(s, d, "olist").select("list_id", "repo"), "list_id")


def _ext() -> F.Column:
    name = F.substring_index("path", "/", -1)
    return F.when(name.contains("."), F.lower(F.substring_index(name, ".", -1))).otherwise("noext")


def verdicts(s: SparkSession, d: str) -> DataFrame:
    """repo, files, code_percent, verdict: DATA below 2 % code files, MIXED below 10 %, else CODE."""
    f = table(s, d, "olist").where("path IS NOT NULL AND repo IS NOT NULL AND type = 'blob'")
    g = f.groupBy("repo").agg(F.count("*").alias("files"), F.sum(_ext().isin(CODE_EXT).cast("long")).alias("code"))
    p = 100 * F.col("code") / F.col("files")
    return g.select("repo", "files", F.round(p, 1).alias("code_percent"), F.when(p < 2, "DATA").when(p < 10, "MIXED").otherwise("CODE").alias("verdict"))


def top_extensions(s: SparkSession, d: str) -> DataFrame:
    """repo, place, ext, n: the three most frequent endings of each repository; ties by name."""
    f = table(s, d, "olist").where("path IS NOT NULL AND repo IS NOT NULL AND type = 'blob'").groupBy("repo", _ext().alias("ext")).agg(F.count("*").alias("n"))
    return f.withColumn("place", F.row_number().over(Window.partitionBy("repo").orderBy(F.desc("n"), "ext"))).where("place <= 3").select("repo", F.col("place").cast("long").alias("place"), "ext", "n")


def order_statistics(df: DataFrame, group: str, value: str, quantiles: list[float]) -> DataFrame:
    """group, q, value: the value at index max(1, int(q * n)) of the ordered values, and the median at int((n + 1) / 2) as q = -1.

    No interpolation. Values are counted first, so the ordered pass has a row per distinct value only. Nulls are left out.
    """
    c = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"))
    up = running_sum(c, [group], [value], "n", "upto")
    tot = c.groupBy(F.col(group).alias("_g")).agg(F.sum("n").alias("tot"))
    want = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.greatest(F.lit(1).cast("long"), F.floor(F.lit(q) * F.col("tot"))).alias("at")) for q in quantiles], F.struct(F.lit(-1.0).alias("q"), F.floor((F.col("tot") + 1) / 2).alias("at")))
    x = up.join(tot, F.col(group).eqNullSafe(F.col("_g"))).withColumn("w", F.explode(want))
    return x.where((F.col("w.at") > F.col("upto") - F.col("n")) & (F.col("w.at") <= F.col("upto"))).select(group, F.col("w.q").alias("q"), F.col(value).alias("value"))


def q_order_statistics(s: SparkSession, d: str) -> DataFrame:
    return order_statistics(table(s, d, "idx"), "type", "storedlen", [0.25, 0.75, 0.9, 0.99])


def tree_shape(s: SparkSession, d: str) -> DataFrame:
    """repo, n_entries, max_depth, n_dirs, n_bytes, capped: shape of each repository's listed paths; capped above 400 levels
    or 20,000 entries. n_bytes sums the stored lengths of the distinct objects listed, 0 for those without a record."""
    o = table(s, d, "olist").where("path IS NOT NULL AND repo IS NOT NULL")
    f = o.select("repo", "path").distinct()
    depth = F.size(F.split("path", "/"))
    folder = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", ""))
    g = f.groupBy("repo").agg(F.count("*").alias("n_entries"), F.max(depth).alias("max_depth"), F.countDistinct(folder).alias("n_dirs"))
    size = table(s, d, "idx").where(valid_sha(F.col("sha"))).groupBy("sha").agg(F.max("storedlen").alias("len"))
    held = o.select("repo", "sha").distinct().join(size, "sha").groupBy("repo").agg(F.sum("len").alias("n_bytes"))
    return g.join(held, "repo", "left").select("repo", "n_entries", "max_depth", "n_dirs", F.coalesce("n_bytes", F.lit(0)).alias("n_bytes"), ((F.col("max_depth") > 400) | (F.col("n_entries") > 20000)).alias("capped"))


def mode_class(mode: F.Column) -> F.Column:
    """Class of an entry by its octal mode: tree, file, exec, link, gitlink; other modes of plain files are noncanonical."""
    return (
        F.when(mode.isin("40000", "040000"), "tree").when(mode == "100644", "file").when(mode == "100755", "exec").when(mode == "120000", "link").when(mode == "160000", "gitlink")
        .when(mode.startswith("100"), "noncanonical").otherwise("other")
    )


def mode_histogram(s: SparkSession, d: str) -> DataFrame:
    """mode_class, n over tree entries; entries whose object's number 9 divides get the rarer modes."""
    rare = F.element_at(F.array(*map(F.lit, ["120000", "160000", "100664", "100600", "000000"])), (F.pmod(F.col("oid"), F.lit(5)) + 1).cast("int"))
    e = M.tree_entries(s, d).select(F.when(F.col("oid") % 9 == 0, rare).otherwise(F.col("mode")).alias("mode"))
    return e.groupBy(mode_class(F.col("mode")).alias("mode_class")).agg(F.count("*").alias("n"))


def blob_names(s: SparkSession, d: str) -> DataFrame:
    """sha, name: distinct last parts of the paths under which each blob is listed."""
    return table(s, d, "olist").where("type = 'blob' AND path IS NOT NULL").where(valid_sha(F.col("sha"))).select("sha", F.translate(F.substring_index("path", "/", -1), ";\r\n", ":__").alias("name")).distinct()


def repo_blob_paths(s: SparkSession, d: str) -> DataFrame:
    """repo, rows, pairs: listed rows and distinct (blob, path) pairs of each repository, exact."""
    f = table(s, d, "olist").where("repo IS NOT NULL AND path IS NOT NULL AND type = 'blob'")
    n = f.groupBy("repo").agg(F.count("*").alias("rows"))
    k = f.select("repo", "sha", "path").distinct().groupBy("repo").agg(F.count("*").alias("pairs"))
    return n.join(k, "repo")


def child_folders(s: SparkSession, d: str) -> DataFrame:
    """parent, child: edges between folders and the folders in them, over all listed paths."""
    parts = table(s, d, "olist").where("path IS NOT NULL").select(F.split("path", "/").alias("p")).distinct().where(F.size("p") > 2)
    i = F.explode(F.sequence(F.lit(1), F.size("p") - 2))
    return parts.select("p", i.alias("i")).select(F.array_join(F.slice("p", 1, F.col("i")), "/").alias("parent"), F.array_join(F.slice("p", 1, F.col("i") + 1), "/").alias("child")).distinct()


def first_wins(s: SparkSession, d: str) -> DataFrame:
    """line_no, sha: the first row of each object, and only then without binary endings: a later good name does not help."""
    o = table(s, d, "olist").where(valid_sha(F.col("sha")))
    first = o.groupBy("sha").agg(F.min_by(F.struct("line_no", "type", "path"), "line_no").alias("x")).select("sha", "x.*")
    return first.where(~((F.col("type") == "blob") & F.coalesce(F.col("path").rlike("[.](" + "|".join(BINARY_EXT) + ")$"), F.lit(False)))).select("line_no", "sha")


def size_guard(s: SparkSession, d: str) -> DataFrame:
    """type, state, n: objects by size: LARGE above 4,096, EMPTY at 0, UNKNOWN without a length."""
    st = F.when(F.col("storedlen").isNull(), "UNKNOWN").when(F.col("storedlen") == 0, "EMPTY").when(F.col("storedlen") > 4096, "LARGE").otherwise("OK")
    return table(s, d, "idx").groupBy("type", st.alias("state")).agg(F.count("*").alias("n"))


def time_order(s: SparkSession, d: str) -> DataFrame:
    """oid, place: commits from the newest to the oldest, ties by smaller oid."""
    c = M.commits(s, d).select("oid", (-F.unix_micros(F.col("time").cast("timestamp"))).alias("back"), F.lit(1).alias("one"))
    return running_sum(c, [], ["back", "oid"], "one", "place").select("oid", "place")


def reflog_nth(s: SparkSession, d: str) -> DataFrame:
    """p, newest, before: each project's newest tip and the one before it, by time and id."""
    t = table(s, d, "p2tips").where("p IS NOT NULL")
    w = Window.partitionBy("p").orderBy(F.desc_nulls_last("taken_at"), F.desc("tip_id"))
    x = t.withColumn("k", F.row_number().over(w)).where("k <= 2")
    return x.groupBy("p").agg(F.max(F.when(F.col("k") == 1, F.col("tip_id"))).alias("newest"), F.max(F.when(F.col("k") == 2, F.col("tip_id"))).alias("before"))


def reflog_as_of(s: SparkSession, d: str) -> DataFrame:
    """p, tip_id: each project's tip as of July 2025: the newest row taken before it."""
    t = table(s, d, "p2tips").where("p IS NOT NULL AND taken_at < timestamp_ntz'2025-07-01 00:00:00'")
    return t.groupBy("p").agg(F.max_by("tip_id", F.struct("taken_at", "tip_id")).alias("tip_id"))


def section_sample(s: SparkSession, d: str) -> DataFrame:
    """sec, sha: the first three store records of each section (the sample is the feature)."""
    w = Window.partitionBy("sec").orderBy("id")
    return table(s, d, "store_idx").withColumn("k", F.row_number().over(w)).where("k <= 3").select("sec", "sha")


def renumber(s: SparkSession, d: str) -> DataFrame:
    """idx_id, new_id, new_off: records with a length, renumbered and laid end to end in the order of ids, over the whole table."""
    i = table(s, d, "idx").where("storedlen > 0").select("idx_id", "storedlen", F.lit(1).alias("one"))
    n = running_sum(i, [], ["idx_id"], "one", "k")
    return running_sum(n, [], ["idx_id"], "storedlen", "e").select("idx_id", (F.col("k") - 1).alias("new_id"), (F.col("e") - F.col("storedlen")).alias("new_off"))


QUERIES = {
    "offenders": offenders, "shard_sums": shard_sums, "dominance_share": dominance, "content_verdict": verdicts, "top_extensions": top_extensions, "order_statistics": q_order_statistics, "tree_shape": tree_shape, "mode_histogram": mode_histogram,
    "blob_names": blob_names, "repo_blob_paths": repo_blob_paths, "child_folders": child_folders, "first_wins_filter": first_wins, "size_guard": size_guard, "time_order": time_order, "reflog_nth": reflog_nth, "reflog_as_of": reflog_as_of,
    "section_sample": section_sample, "renumber_offsets": renumber,
}

_V = "regexp_full_match(sha, '[0-9a-f]{40}')"
_NAME = "string_split(path, '/')[-1]"
_EXT = "CASE WHEN contains(" + _NAME + ", '.') THEN lower(string_split(" + _NAME + ", '.')[-1]) ELSE 'noext' END"
_CODE = "(" + ", ".join(f"'{x}'" for x in CODE_EXT) + ")"
_BLOBS = "FROM olist WHERE path IS NOT NULL AND repo IS NOT NULL AND type = 'blob'"
SQL = {
    "offenders": "SELECT repo, sum(coalesce(storedlen, 0))::BIGINT AS n_bytes, count(*) AS n_rows FROM idx WHERE type = 'blob' AND repo IS NOT NULL AND repo NOT IN (SELECT repo FROM p2cd WHERE batch = 0 AND repo IS NOT NULL) GROUP BY repo HAVING sum(coalesce(storedlen, 0)) > 100000 OR count(*) > 100",
    "shard_sums": "WITH p AS (SELECT repo, sec, sum(coalesce(storedlen, 0))::BIGINT AS b FROM idx WHERE repo IS NOT NULL GROUP BY ALL), r AS (SELECT *, sum(b) OVER (PARTITION BY repo)::BIGINT AS t, row_number() OVER (PARTITION BY repo ORDER BY b DESC, sec) AS k FROM p) SELECT repo, t AS n_bytes, sec AS top_sec FROM r WHERE k = 1",
    "dominance_share": "WITH c AS (SELECT list_id, repo, count(*) AS n FROM olist WHERE repo IS NOT NULL GROUP BY ALL), g AS (SELECT list_id, count(*) AS repos, sum(n) AS tot, max(n) AS m, arg_max(repo, struct_pack(n := n, r := repo)) AS top FROM c GROUP BY 1) SELECT list_id, repos, round(100 * m / tot, 1) AS top_percent, top FROM g WHERE repos = 1 OR 100 * m >= tot * 90",
    "content_verdict": "WITH g AS (SELECT repo, count(*) AS files, 100 * count(*) FILTER (" + _EXT + " IN " + _CODE + ") / count(*) AS p " + _BLOBS + " GROUP BY repo) SELECT repo, files, round(p, 1) AS code_percent, CASE WHEN p < 2 THEN 'DATA' WHEN p < 10 THEN 'MIXED' ELSE 'CODE' END AS verdict FROM g",
    "top_extensions": "WITH g AS (SELECT repo, " + _EXT + " AS ext, count(*) AS n " + _BLOBS + " GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY n DESC, ext) AS place FROM g) SELECT repo, place, ext, n FROM r WHERE place <= 3",
    "order_statistics": "WITH o AS (SELECT type, storedlen, row_number() OVER (PARTITION BY type ORDER BY storedlen) AS k, count(*) OVER (PARTITION BY type) AS n FROM idx WHERE storedlen IS NOT NULL), q AS (SELECT * FROM (VALUES (0.25::DOUBLE), (0.75), (0.9), (0.99)) t(q)) SELECT type, q, storedlen AS value FROM o, q WHERE k = greatest(1, floor(q * n)) UNION ALL SELECT type, -1.0::DOUBLE, storedlen FROM o WHERE k = (n + 1) // 2",
    "tree_shape": "WITH f AS (SELECT DISTINCT repo, path FROM olist WHERE path IS NOT NULL AND repo IS NOT NULL), z AS (SELECT sha, max(storedlen) AS len FROM idx WHERE regexp_full_match(sha, '[0-9a-f]{40}') GROUP BY sha), b AS (SELECT repo, sum(len)::BIGINT AS n_bytes FROM (SELECT DISTINCT repo, sha FROM olist WHERE path IS NOT NULL AND repo IS NOT NULL) JOIN z USING (sha) GROUP BY repo), g AS (SELECT repo, count(*) AS n_entries, max(len(string_split(path, '/')))::INT AS max_depth, count(DISTINCT CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') END) AS n_dirs FROM f GROUP BY repo) SELECT repo, n_entries, max_depth, n_dirs, coalesce(n_bytes, 0) AS n_bytes, max_depth > 400 OR n_entries > 20000 AS capped FROM g LEFT JOIN b USING (repo)",
    "mode_histogram": with_sql("entries", "SELECT CASE WHEN oid % 9 = 0 THEN CASE oid % 5 WHEN 0 THEN 'link' WHEN 1 THEN 'gitlink' WHEN 4 THEN 'other' ELSE 'noncanonical' END WHEN mode = '040000' THEN 'tree' WHEN mode = '100644' THEN 'file' ELSE 'exec' END AS mode_class, count(*) AS n FROM entries GROUP BY 1"),
    "blob_names": "SELECT DISTINCT sha, translate(" + _NAME + ", ';' || chr(13) || chr(10), ':__') AS name FROM olist WHERE type = 'blob' AND path IS NOT NULL AND " + _V,
    "repo_blob_paths": "SELECT repo, count(*) AS rows, count(DISTINCT (coalesce(sha, '-'), path)) AS pairs " + _BLOBS + " GROUP BY repo",
    "child_folders": "WITH p AS (SELECT DISTINCT string_split(path, '/') AS p FROM olist WHERE path IS NOT NULL) SELECT DISTINCT array_to_string(p[1:i], '/') AS parent, array_to_string(p[1:i + 1], '/') AS child FROM p, range(1, 60) t(i) WHERE i <= len(p) - 2",
    "first_wins_filter": "WITH f AS (SELECT sha, min(line_no) AS line_no FROM olist WHERE " + _V + " GROUP BY sha) SELECT f.line_no, f.sha FROM f JOIN olist o ON o.line_no = f.line_no WHERE NOT (o.type = 'blob' AND coalesce(regexp_matches(o.path, '[.](" + "|".join(BINARY_EXT) + ")$'), false))",
    "size_guard": "SELECT type, CASE WHEN storedlen IS NULL THEN 'UNKNOWN' WHEN storedlen = 0 THEN 'EMPTY' WHEN storedlen > 4096 THEN 'LARGE' ELSE 'OK' END AS state, count(*) AS n FROM idx GROUP BY 1, 2",
    "time_order": with_sql("commits", "SELECT oid, row_number() OVER (ORDER BY time DESC, oid) AS place FROM commits"),
    "reflog_nth": "WITH r AS (SELECT p, tip_id, row_number() OVER (PARTITION BY p ORDER BY taken_at DESC NULLS LAST, tip_id DESC) AS k FROM p2tips WHERE p IS NOT NULL) SELECT p, max(tip_id) FILTER (k = 1) AS newest, max(tip_id) FILTER (k = 2) AS before FROM r GROUP BY p",
    "reflog_as_of": "SELECT p, tip_id FROM (SELECT p, tip_id, row_number() OVER (PARTITION BY p ORDER BY taken_at DESC, tip_id DESC) AS k FROM p2tips WHERE p IS NOT NULL AND taken_at < TIMESTAMP '2025-07-01') WHERE k = 1",
    "section_sample": "SELECT sec, sha FROM (SELECT *, row_number() OVER (PARTITION BY sec ORDER BY id) AS k FROM store_idx) WHERE k <= 3",
    "renumber_offsets": "SELECT idx_id, row_number() OVER (ORDER BY idx_id) - 1 AS new_id, (sum(storedlen) OVER (ORDER BY idx_id) - storedlen)::BIGINT AS new_off FROM idx WHERE storedlen > 0",
}

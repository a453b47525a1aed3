"""Snapshot comparison: ordered full outer joins on a path, and what is derived from their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.operators.rules import ignored
from stratalog.plans import model as M
from stratalog.plans.model import with_sql
from stratalog.sources.tables import table


def kind_of(mode: Column) -> Column:
    """Type of an entry by the type bits of its octal mode: the two leading digits."""
    return F.substring(F.lpad(mode, 6, "0"), 1, 2)


def status_of(old_oid: Column, new_oid: Column, old_mode: Column, new_mode: Column) -> Column:
    """Status of a path in a full outer join; a null oid means the side lacks the path. First true case counts."""
    return (
        F.when(old_oid.isNull(), "ADDED")
        .when(new_oid.isNull(), "DELETED")
        .when(kind_of(old_mode) != kind_of(new_mode), "TYPECHANGE")
        .when((old_oid == new_oid) & (old_mode == new_mode), "UNMODIFIED")
        .otherwise("MODIFIED")
    )


def diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """keys, old_oid, new_oid, old_mode, new_mode, status of two snapshots (keys, oid, mode), equal paths included.

    Null keys never match each other, as in any equi-join. Each side's keys must be unique.
    """
    a = old.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.col("oid").alias("old_oid"), F.col("mode").alias("old_mode"))
    b = new.select(*[F.col(k).alias(f"_n_{k}") for k in keys], F.col("oid").alias("new_oid"), F.col("mode").alias("new_mode"))
    on = [F.col(f"_o_{k}") == F.col(f"_n_{k}") for k in keys]
    both = a.join(b, on, "full_outer")
    return both.select(*[F.coalesce(f"_o_{k}", f"_n_{k}").alias(k) for k in keys], "old_oid", "new_oid", "old_mode", "new_mode", status_of(F.col("old_oid"), F.col("new_oid"), F.col("old_mode"), F.col("new_mode")).alias("status"))


def split_typechange(deltas: DataFrame) -> DataFrame:
    """Type changes as a deletion and an addition, for consumers without the TYPECHANGE status."""
    parts = F.when(F.col("status") == "TYPECHANGE", F.array(F.lit("DELETED"), F.lit("ADDED"))).otherwise(F.array("status"))
    x = deltas.withColumn("_s", F.explode(parts))
    gone, came = (F.col("status") == "TYPECHANGE") & (F.col("_s") == "DELETED"), (F.col("status") == "TYPECHANGE") & (F.col("_s") == "ADDED")
    return x.select(
        *[c for c in deltas.columns if c not in ("old_oid", "new_oid", "old_mode", "new_mode", "status")],
        *[F.when(~came, F.col(c)).alias(c) for c in ("old_oid", "old_mode")],
        *[F.when(~gone, F.col(c)).alias(c) for c in ("new_oid", "new_mode")],
        F.col("_s").alias("status"),
    )


def commit_deltas(entries: DataFrame, parents: DataFrame, commits: DataFrame) -> DataFrame:
    """commit, name, old_oid, new_oid, old_mode, new_mode, status against the first parent; unchanged entries left out.

    A commit without a parent creates all its entries. Only trees that a commit or parent names are read.
    """
    first = parents.where("pos = 0").select("oid", "parent")
    new = commits.select(F.col("oid").alias("commit")).join(entries, F.col("commit") == F.col("tree")).select("commit", "name", "oid", "mode")
    old = first.join(entries.withColumnRenamed("oid", "e_oid"), F.col("parent") == F.col("tree")).select(F.col("oid").alias("commit"), "name", F.col("e_oid").alias("oid"), "mode")
    return diff(old, new, ["commit", "name"]).where("status <> 'UNMODIFIED'")


def differing_parent(parents: DataFrame, signature: DataFrame, commits: DataFrame) -> DataFrame:
    """oid, parent, status: the first parent whose tree differs (DIFF), or IDENT if none does, or ROOT without parents.

    signature: tree, sig. A parent whose tree is missing counts as differing; a commit without a tree gives no row.
    """
    mine = commits.select("oid").join(signature.select(F.col("tree").alias("oid"), F.col("sig").alias("own")), "oid")
    p = mine.join(parents, "oid").join(signature.select(F.col("tree").alias("parent"), "sig"), "parent", "left")
    best = p.groupBy("oid").agg(F.min(F.when(F.col("sig").isNull() | (F.col("sig") != F.col("own")), F.struct("pos", "parent"))).alias("x"), F.lit(1).alias("has"))
    return mine.select("oid").join(best, "oid", "left").select("oid", F.col("x.parent").alias("parent"), F.when(F.col("has").isNull(), "ROOT").when(F.col("x").isNull(), "IDENT").otherwise("DIFF").alias("status"))


def exact_renames(deltas: DataFrame, group: str) -> DataFrame:
    """group, old_name, new_name, oid: deletions and additions of one object within a group, matched in order of names.

    The k-th deletion of an object goes to its k-th addition; what is left over on either side stays unmatched.
    """
    from pyspark.sql import Window

    gone = deltas.where("status = 'DELETED'").select(group, F.col("name").alias("old_name"), F.col("old_oid").alias("oid"))
    came = deltas.where("status = 'ADDED'").select(group, F.col("name").alias("new_name"), F.col("new_oid").alias("oid"))
    a = gone.withColumn("k", F.row_number().over(Window.partitionBy(group, "oid").orderBy("old_name")))
    b = came.withColumn("k", F.row_number().over(Window.partitionBy(group, "oid").orderBy("new_name")))
    return a.join(b, [group, "oid", "k"]).select(group, "old_name", "new_name", "oid")


# ------------------------------------------------------------------------------------------------------------- queries


def _deltas(s: SparkSession, d: str) -> DataFrame:
    return commit_deltas(M.tree_entries(s, d), M.parents(s, d), M.commits(s, d))


def q_commit_diff(s: SparkSession, d: str) -> DataFrame:
    return _deltas(s, d).select("commit", "name", "old_oid", "new_oid", "status")


def typechange_split(s: SparkSession, d: str) -> DataFrame:
    return split_typechange(_deltas(s, d)).select("commit", "name", "old_oid", "new_oid", "status")


def tree_signatures(s: SparkSession, d: str) -> DataFrame:
    """tree, sig: hash of a tree's ordered entries in the store's binary form, from oids of the entries' content."""
    e = M.tree_entries(s, d).select("tree", "name", "mode", F.sha1(F.col("oid").cast("string").cast("binary")).alias("h"))
    directory = F.col("mode") == "040000"
    # Order: bytes of the name, a directory's name counting as if it ended in a slash.
    key = F.encode(F.concat(F.col("name").cast("string"), F.when(directory, "/").otherwise("")), "utf-8")
    row = F.concat(F.hex(F.encode(F.concat(F.when(directory, "40000").otherwise(F.col("mode")), F.lit(" "), F.col("name").cast("string")), "utf-8")), F.lit("00"), F.upper("h"))
    g = e.groupBy("tree").agg(F.array_sort(F.collect_list(F.struct(key.alias("k"), row.alias("r")))).alias("x"))
    body = F.array_join(F.transform("x", lambda t: t["r"]), "")
    head = F.hex(F.encode(F.concat(F.lit("tree "), (F.length(body) / 2).cast("int").cast("string")), "utf-8"))
    return g.select("tree", F.sha1(F.unhex(F.concat(head, F.lit("00"), body))).alias("sig"))


def q_differing_parent(s: SparkSession, d: str) -> DataFrame:
    return differing_parent(M.parents(s, d), tree_signatures(s, d), M.commits(s, d))


def q_exact_renames(s: SparkSession, d: str) -> DataFrame:
    return exact_renames(_deltas(s, d), "commit")


def diff_stats(s: SparkSession, d: str) -> DataFrame:
    """status, files, commits over all commits' deltas."""
    return _deltas(s, d).groupBy("status").agg(F.count("*").alias("files"), F.countDistinct("commit").alias("commits"))


def name_status(s: SparkSession, d: str) -> DataFrame:
    """commit, text: the deltas in the name-status format, in order of names."""
    line = F.concat(F.substring("status", 1, 1), F.lit("\t"), F.col("name").cast("string"))
    letter = F.when(F.col("status") == "TYPECHANGE", F.concat(F.lit("T\t"), F.col("name").cast("string"))).otherwise(line)
    g = _deltas(s, d).groupBy("commit").agg(F.array_sort(F.collect_list(F.struct("name", letter.alias("l")))).alias("x"))
    return g.select("commit", F.array_join(F.transform("x", lambda t: t["l"]), "\n").alias("text"))


def delta_lines(deltas: DataFrame, style: str) -> DataFrame:
    """commit, name, line: deltas in one of the text formats `raw`, `name_only`, `name_status` or `patch_header`.

    Ids are shown with seven digits, zeros where a side lacks the path.
    """
    oid = lambda c: F.coalesce(F.substring(F.sha1(F.col(c).cast("string").cast("binary")), 1, 7), F.lit("0" * 7))
    mode = lambda c: F.coalesce(F.col(c), F.lit("000000"))
    name, letter = F.col("name").cast("string"), F.substring("status", 1, 1)
    if style == "name_only":
        line = name
    elif style == "name_status":
        line = F.concat(letter, F.lit("\t"), name)
    elif style == "raw":
        line = F.concat(F.lit(":"), mode("old_mode"), F.lit(" "), mode("new_mode"), F.lit(" "), oid("old_oid"), F.lit("... "), oid("new_oid"), F.lit("... "), letter, F.lit("\t"), name)
    elif style == "patch_header":
        a, b = F.concat(F.lit("a/"), name), F.concat(F.lit("b/"), name)
        kind = F.when(F.col("old_oid").isNull(), F.concat(F.lit("\nnew file mode "), "new_mode")).when(F.col("new_oid").isNull(), F.concat(F.lit("\ndeleted file mode "), "old_mode")).when(F.col("old_mode") != F.col("new_mode"), F.concat(F.lit("\nold mode "), "old_mode", F.lit("\nnew mode "), "new_mode")).otherwise("")
        same = F.when((F.col("old_mode") == F.col("new_mode")), F.concat(F.lit(" "), "new_mode")).otherwise("")
        index = F.when(F.col("old_oid").eqNullSafe(F.col("new_oid")), F.lit("")).otherwise(F.concat(F.lit("\nindex "), oid("old_oid"), F.lit(".."), oid("new_oid"), same, F.lit("\n--- "), F.when(F.col("old_oid").isNull(), "/dev/null").otherwise(a), F.lit("\n+++ "), F.when(F.col("new_oid").isNull(), "/dev/null").otherwise(b)))
        line = F.concat(F.lit("diff --git "), a, F.lit(" "), b, kind, index)
    else:
        raise ValueError(style)
    return deltas.select("commit", "name", line.alias("line"))


def diff_raw(s: SparkSession, d: str) -> DataFrame:
    return delta_lines(_deltas(s, d), "raw")


def diff_name_only(s: SparkSession, d: str) -> DataFrame:
    return delta_lines(_deltas(s, d), "name_only")


def diff_patch_header(s: SparkSession, d: str) -> DataFrame:
    return delta_lines(_deltas(s, d), "patch_header")


def patch_id(patch: Column) -> Column:
    """Hash of one file's patch without blanks, positions of hunks and index lines: equal changes have equal ids wherever
    they were made."""
    kept = F.filter(F.split(patch, "\n"), lambda x: ~x.rlike(r"^(?:@@ |index )"))
    return F.sha1(F.regexp_replace(F.array_join(kept, ""), r"[ \t\n\r\f\x0B]+", "").cast("binary"))


def patch_ids(s: SparkSession, d: str) -> DataFrame:
    """doc_id, patch_id: the change that puts a line before each document, as a patch with three lines of context."""
    t = table(s, d, "documents").where("text IS NOT NULL").select("doc_id", F.split("text", "\n").alias("l"))
    n = F.least(F.size("l"), F.lit(3)).cast("string")
    name = F.concat(F.lit("doc"), F.col("doc_id").cast("string"))
    m = (F.least(F.size("l"), F.lit(3)) + 1).cast("string")
    patch = F.concat(F.lit("diff --git a/"), name, F.lit(" b/"), name, F.lit("\nindex 1111111..2222222 100644\n--- a/"), name, F.lit("\n+++ b/"), name, F.lit("\n@@ -1,"), n, F.lit(" +1,"), m, F.lit(" @@\n+first line\n "), F.array_join(F.slice("l", 1, 3), "\n "))
    return t.select("doc_id", patch_id(patch).alias("patch_id"))


def three_states(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Head, index and working tree over parts: the index drops keys that 11 divides and edits those that 7 divides;
    the working tree drops keys that 13 divides, edits those that 5 divides and adds a copy of those that 17 divides."""
    p = table(s, d, "part").select(F.col("p_partkey").alias("path"), F.col("p_size").cast("long").alias("oid"), F.lit("100644").alias("mode"))
    k = F.col("path")
    index = p.where(k % 11 != 0).withColumn("oid", F.when(k % 7 == 0, F.col("oid") + 1000).otherwise(F.col("oid")))
    work = index.where(k % 13 != 0).withColumn("oid", F.when(k % 5 == 0, F.col("oid") + 5000).otherwise(F.col("oid")))
    added = p.where(k % 17 == 0).withColumn("path", k + 10_000_000)
    return p, index, work.unionByName(added)


#: Bits of a status, staged and unstaged.
STAGED = {"ADDED": 1, "MODIFIED": 2, "DELETED": 4, "TYPECHANGE": 16}
UNSTAGED = {"ADDED": 128, "MODIFIED": 256, "DELETED": 512, "TYPECHANGE": 1024}


def _bits(status: Column, bits: dict[str, int]) -> Column:
    out = F.lit(0)
    for k, v in bits.items():
        out = F.when(status == k, v).otherwise(out)
    return out


def status(s: SparkSession, d: str) -> DataFrame:
    """path, flags: staged changes (head to index) or-ed with unstaged ones (index to working tree); clean paths left out."""
    head, index, work = three_states(s, d)
    a = diff(head, index, ["path"]).select("path", _bits(F.col("status"), STAGED).alias("f"))
    b = diff(index, work, ["path"]).select("path", _bits(F.col("status"), UNSTAGED).alias("f"))
    return a.unionByName(b).groupBy("path").agg(F.expr("bit_or(f)").alias("flags")).where("flags <> 0")


#: Further bits of a status.
RENAMED, WORK_RENAMED, IGNORED, CONFLICTED = 8, 2048, 16384, 32768


def _with_moves(deltas: DataFrame, bits: dict[str, int], moved: int) -> DataFrame:
    """path, f: a diff's bits; a path added with the content of exactly one deleted path, which no other added path has,
    was moved: it gets `moved`, and the deleted path no bit."""
    came = deltas.where("status = 'ADDED'").groupBy(F.col("new_oid").alias("oid")).agg(F.min("path").alias("path"), F.count("*").alias("k")).where("k = 1")
    gone = deltas.where("status = 'DELETED'").groupBy(F.col("old_oid").alias("oid")).agg(F.min("path").alias("old"), F.count("*").alias("k")).where("k = 1")
    pairs = came.select("oid", "path").join(gone.select("oid", "old"), "oid")
    rest = deltas.where("status <> 'UNMODIFIED'").join(pairs.select("path"), "path", "left_anti").join(pairs.select(F.col("old").alias("path")), "path", "left_anti")
    return rest.select("path", _bits(F.col("status"), bits).alias("f")).unionByName(pairs.select("path", F.lit(moved).alias("f")))


def full_status(head: DataFrame, index: DataFrame, work: DataFrame, conflicts: DataFrame, ignore: list[str]) -> DataFrame:
    """path, flags of three states (path text, oid, mode): staged and unstaged changes with moves, untracked files that
    `ignore` (rules) leaves out as IGNORED, and paths of `conflicts` (path) as CONFLICTED, whatever else they are."""
    unstaged = diff(index, work, ["path"])
    left_out = ignored(F.col("path"), ignore) & (F.col("status") == "ADDED")
    rows = _with_moves(diff(head, index, ["path"]), STAGED, RENAMED).unionByName(_with_moves(unstaged.where(~left_out), UNSTAGED, WORK_RENAMED)).unionByName(unstaged.where(left_out).select("path", F.lit(IGNORED).alias("f")))
    flags = rows.groupBy("path").agg(F.expr("bit_or(f)").alias("flags")).where("flags <> 0")
    bad = conflicts.select("path").distinct()
    return flags.join(bad, "path", "left_anti").unionByName(bad.select("path", F.lit(CONFLICTED).alias("flags")))


def status_full(s: SparkSession, d: str) -> DataFrame:
    """Parts as files: the index moves keys that 11 divides and edits those that 7 divides; the working tree drops keys
    that 13 divides, edits those that 5 divides, moves those that 29 divides, and has built and new files; keys that 23
    divides are in conflict."""
    p = table(s, d, "part").select(F.col("p_partkey").alias("k"))
    k = F.col("k")
    name = lambda folder, end="": F.concat(F.lit(folder + "/f"), k.cast("string"), F.lit(end))
    at = F.when(k % 11 == 0, name("moved")).otherwise(name("src"))
    oid = F.when(k % 7 == 0, k * 10 + 1).otherwise(k * 10)
    plain = lambda path, o: p.select("k", path.alias("path"), o.cast("long").alias("oid"), F.lit("100644").alias("mode"))
    index = plain(at, oid)
    work = plain(F.when((k % 29 == 0) & (k % 5 != 0), name("wt")).otherwise(at), F.when(k % 5 == 0, oid + 5).otherwise(oid)).where(k % 13 != 0)
    work = work.unionByName(plain(name("build", ".o"), k * 10 + 7).where(k % 17 == 0)).unionByName(plain(name("new"), k * 10 + 8).where(k % 19 == 0))
    return full_status(plain(name("src"), k * 10).drop("k"), index.drop("k"), work.drop("k"), index.where(k % 23 == 0), ["*.o"])


def merged_diff(s: SparkSession, d: str) -> DataFrame:
    """path, old_oid, new_oid, status: head-to-index and index-to-work combined into one diff from the head."""
    head, index, work = three_states(s, d)
    a = diff(head, index, ["path"]).where("status <> 'UNMODIFIED'").select("path", F.col("old_oid").alias("o1"), F.col("new_oid").alias("n1"), F.col("status").alias("s1"))
    b = diff(index, work, ["path"]).where("status <> 'UNMODIFIED'").select("path", F.col("old_oid").alias("o2"), F.col("new_oid").alias("n2"), F.col("status").alias("s2"))
    j = a.join(b, "path", "full_outer").select("path", F.when(F.col("s1").isNotNull(), F.col("o1")).otherwise(F.col("o2")).alias("old_oid"), F.when(F.col("s2").isNotNull(), F.col("n2")).otherwise(F.col("n1")).alias("new_oid"))
    st = F.when(F.col("old_oid").isNull(), "ADDED").when(F.col("new_oid").isNull(), "DELETED").otherwise("MODIFIED")
    return j.where(~(F.col("old_oid").isNull() & F.col("new_oid").isNull()) & ~F.col("old_oid").eqNullSafe(F.col("new_oid"))).select("path", "old_oid", "new_oid", st.alias("status"))


def paired(s: SparkSession, d: str) -> DataFrame:
    """path, staged, unstaged: the two diffs' rows side by side."""
    head, index, work = three_states(s, d)
    a = diff(head, index, ["path"]).where("status <> 'UNMODIFIED'").select("path", F.col("status").alias("staged"))
    b = diff(index, work, ["path"]).where("status <> 'UNMODIFIED'").select("path", F.col("status").alias("unstaged"))
    return a.join(b, "path", "full_outer")


def checkout_plan(s: SparkSession, d: str) -> DataFrame:
    """path, action for moving from the head (baseline) to the index (target) over the working tree.

    An unchanged working file follows the target; a changed one conflicts unless it equals the target or the target
    did not change.
    """
    base, target, work = three_states(s, d)
    x = base.select("path", F.col("oid").alias("b")).join(target.select("path", F.col("oid").alias("t")), "path", "full_outer").join(work.select("path", F.col("oid").alias("w")), "path", "full_outer")
    b, t, w = F.col("b"), F.col("t"), F.col("w")
    act = (
        F.when(b.eqNullSafe(t), F.when(w.eqNullSafe(b), "NONE").when(b.isNull(), "UNTRACKED").otherwise("KEEP"))
        .when(w.eqNullSafe(t), "NONE")
        .when(w.eqNullSafe(b), F.when(t.isNull(), "REMOVE").when(b.isNull(), "CREATE").otherwise("UPDATE"))
        .otherwise("CONFLICT")
    )
    return x.select("path", act.alias("action"))


QUERIES = {
    "status_full": status_full,
    "diff_raw": diff_raw, "diff_name_only": diff_name_only, "diff_patch_header": diff_patch_header,
    "commit_diff": q_commit_diff, "diff_typechange_split": typechange_split, "tree_hash": tree_signatures, "differing_parent": q_differing_parent, "rename_exact": q_exact_renames, "diff_stats": diff_stats,
    "diff_name_status": name_status, "patch_id": patch_ids, "status_flags": status, "diff_merge": merged_diff, "diff_paired": paired, "checkout_plan": checkout_plan,
}

_KIND = "substr({0}, 1, 2)"
_DELTAS = (
    ", fp AS (SELECT oid AS commit, parent FROM parents WHERE pos = 0), o AS (SELECT fp.commit, e.name, e.oid, e.mode FROM fp JOIN entries e ON e.tree = fp.parent), n AS (SELECT c.oid AS commit, e.name, e.oid, e.mode FROM commits c JOIN entries e ON e.tree = c.oid),"
    " deltas AS (SELECT coalesce(o.commit, n.commit) AS commit, coalesce(o.name, n.name) AS name, o.oid AS old_oid, n.oid AS new_oid, o.mode AS old_mode, n.mode AS new_mode, CASE WHEN o.oid IS NULL THEN 'ADDED' WHEN n.oid IS NULL THEN 'DELETED' WHEN substr(o.mode, 1, 2) <> substr(n.mode, 1, 2) THEN 'TYPECHANGE' ELSE 'MODIFIED' END AS status"
    " FROM o FULL JOIN n ON o.commit = n.commit AND o.name = n.name WHERE o.oid IS NULL OR n.oid IS NULL OR o.oid <> n.oid OR o.mode <> n.mode) "
)
_M = "commits parents entries"
_SIG = (
    ", se AS (SELECT tree, name, mode, sha1(oid::VARCHAR) AS h FROM entries), sr AS (SELECT tree, encode(name::VARCHAR || CASE mode WHEN '040000' THEN '/' ELSE '' END) AS k, hex(encode(CASE mode WHEN '040000' THEN '40000' ELSE mode END || ' ' || name::VARCHAR)) || '00' || upper(h) AS r FROM se),"
    " sb AS (SELECT tree, string_agg(r, '' ORDER BY k) AS body FROM sr GROUP BY tree), sigs AS (SELECT tree, sha1(unhex(hex(encode('tree ' || (length(body) // 2)::VARCHAR)) || '00' || body)) AS sig FROM sb) "
)
_S3 = (
    "WITH h AS (SELECT p_partkey AS path, p_size::BIGINT AS oid FROM part), i AS (SELECT path, CASE WHEN path % 7 = 0 THEN oid + 1000 ELSE oid END AS oid FROM h WHERE path % 11 <> 0),"
    " w AS (SELECT path, CASE WHEN path % 5 = 0 THEN oid + 5000 ELSE oid END AS oid FROM i WHERE path % 13 <> 0 UNION ALL SELECT path + 10000000, oid FROM h WHERE path % 17 = 0),"
    " a AS (SELECT coalesce(h.path, i.path) AS path, h.oid AS o, i.oid AS n FROM h FULL JOIN i ON h.path = i.path WHERE h.oid IS DISTINCT FROM i.oid), b AS (SELECT coalesce(i.path, w.path) AS path, i.oid AS o, w.oid AS n FROM i FULL JOIN w ON i.path = w.path WHERE i.oid IS DISTINCT FROM w.oid) "
)
_ST = "CASE WHEN {0}.o IS NULL THEN 'ADDED' WHEN {0}.n IS NULL THEN 'DELETED' ELSE 'MODIFIED' END"
SQL = {
    "commit_diff": with_sql(_M, _DELTAS + "SELECT commit, name, old_oid, new_oid, status FROM deltas"),
    "diff_typechange_split": with_sql(_M, _DELTAS + "SELECT commit, name, old_oid, new_oid, status FROM deltas WHERE status <> 'TYPECHANGE' UNION ALL SELECT commit, name, old_oid, NULL, 'DELETED' FROM deltas WHERE status = 'TYPECHANGE' UNION ALL SELECT commit, name, NULL, new_oid, 'ADDED' FROM deltas WHERE status = 'TYPECHANGE'"),
    "tree_hash": with_sql(_M, _SIG + "SELECT tree, sig FROM sigs"),
    "differing_parent": with_sql(_M, _SIG + ", own AS (SELECT c.oid, s.sig FROM commits c JOIN sigs s ON s.tree = c.oid), c AS (SELECT o.oid, p.pos, p.parent, o.sig <> coalesce(s.sig, '') AS differs FROM own o JOIN parents p ON p.oid = o.oid LEFT JOIN sigs s ON s.tree = p.parent), f AS (SELECT oid, arg_min(parent, pos) FILTER (differs) AS parent FROM c GROUP BY oid) SELECT own.oid, f.parent, CASE WHEN f.oid IS NULL THEN 'ROOT' WHEN f.parent IS NULL THEN 'IDENT' ELSE 'DIFF' END AS status FROM own LEFT JOIN f ON f.oid = own.oid"),
    "rename_exact": with_sql(_M, _DELTAS + ", g AS (SELECT commit, name, old_oid AS oid, row_number() OVER (PARTITION BY commit, old_oid ORDER BY name) AS k FROM deltas WHERE status = 'DELETED'), c AS (SELECT commit, name, new_oid AS oid, row_number() OVER (PARTITION BY commit, new_oid ORDER BY name) AS k FROM deltas WHERE status = 'ADDED') SELECT g.commit, g.name AS old_name, c.name AS new_name, g.oid FROM g JOIN c ON g.commit = c.commit AND g.oid = c.oid AND g.k = c.k"),
    "diff_stats": with_sql(_M, _DELTAS + "SELECT status, count(*) AS files, count(DISTINCT commit) AS commits FROM deltas GROUP BY status"),
    "diff_name_status": with_sql(_M, _DELTAS + "SELECT commit, string_agg(substr(status, 1, 1) || chr(9) || name::VARCHAR, chr(10) ORDER BY name) AS text FROM deltas GROUP BY commit"),
    "patch_id": "WITH t AS (SELECT doc_id, string_split(text, chr(10))[1:3] AS l FROM documents WHERE text IS NOT NULL) SELECT doc_id, sha1(regexp_replace('diff--gita/doc' || doc_id::VARCHAR || 'b/doc' || doc_id::VARCHAR || '---a/doc' || doc_id::VARCHAR || '+++b/doc' || doc_id::VARCHAR || '+firstline' || array_to_string(l, ''), '[ \\t\\n\\r\\f\\x0B]+', '', 'g')) AS patch_id FROM t",
    "diff_name_only": with_sql(_M, _DELTAS + "SELECT commit, name, name::VARCHAR AS line FROM deltas"),
    "diff_raw": with_sql(_M, _DELTAS + "SELECT commit, name, ':' || coalesce(old_mode, '000000') || ' ' || coalesce(new_mode, '000000') || ' ' || coalesce(substr(sha1(old_oid::VARCHAR), 1, 7), '0000000') || '... ' || coalesce(substr(sha1(new_oid::VARCHAR), 1, 7), '0000000') || '... ' || substr(status, 1, 1) || chr(9) || name::VARCHAR AS line FROM deltas"),
    "diff_patch_header": with_sql(_M, _DELTAS + "SELECT commit, name, 'diff --git a/' || name::VARCHAR || ' b/' || name::VARCHAR || CASE WHEN old_oid IS NULL THEN chr(10) || 'new file mode ' || new_mode WHEN new_oid IS NULL THEN chr(10) || 'deleted file mode ' || old_mode WHEN old_mode <> new_mode THEN chr(10) || 'old mode ' || old_mode || chr(10) || 'new mode ' || new_mode ELSE '' END || CASE WHEN old_oid IS NOT DISTINCT FROM new_oid THEN '' ELSE chr(10) || 'index ' || coalesce(substr(sha1(old_oid::VARCHAR), 1, 7), '0000000') || '..' || coalesce(substr(sha1(new_oid::VARCHAR), 1, 7), '0000000') || CASE WHEN old_mode = new_mode THEN ' ' || new_mode ELSE '' END || chr(10) || '--- ' || CASE WHEN old_oid IS NULL THEN '/dev/null' ELSE 'a/' || name::VARCHAR END || chr(10) || '+++ ' || CASE WHEN new_oid IS NULL THEN '/dev/null' ELSE 'b/' || name::VARCHAR END END AS line FROM deltas"),
    "status_flags": _S3 + "SELECT path, sum(f)::INT AS flags FROM (SELECT path, CASE " + _ST.format("a") + " WHEN 'ADDED' THEN 1 WHEN 'MODIFIED' THEN 2 ELSE 4 END AS f FROM a UNION ALL SELECT path, CASE " + _ST.format("b") + " WHEN 'ADDED' THEN 128 WHEN 'MODIFIED' THEN 256 ELSE 512 END FROM b) GROUP BY path",
    "diff_merge": _S3 + ", j AS (SELECT coalesce(a.path, b.path) AS path, CASE WHEN a.path IS NOT NULL THEN a.o ELSE b.o END AS o, CASE WHEN b.path IS NOT NULL THEN b.n ELSE a.n END AS n FROM a FULL JOIN b ON a.path = b.path) SELECT path, o AS old_oid, n AS new_oid, " + _ST.format("j") + " AS status FROM j WHERE o IS DISTINCT FROM n",
    "diff_paired": _S3 + "SELECT coalesce(a.path, b.path) AS path, CASE WHEN a.path IS NULL THEN NULL ELSE " + _ST.format("a") + " END AS staged, CASE WHEN b.path IS NULL THEN NULL ELSE " + _ST.format("b") + " END AS unstaged FROM a FULL JOIN b ON a.path = b.path",
    "checkout_plan": _S3 + ", x AS (SELECT p.path, h.oid AS b, i.oid AS t, w.oid AS w FROM (SELECT path FROM h UNION SELECT path FROM i UNION SELECT path FROM w) p LEFT JOIN h USING (path) LEFT JOIN i USING (path) LEFT JOIN w USING (path)) SELECT path, CASE WHEN b IS NOT DISTINCT FROM t THEN CASE WHEN w IS NOT DISTINCT FROM b THEN 'NONE' WHEN b IS NULL THEN 'UNTRACKED' ELSE 'KEEP' END WHEN w IS NOT DISTINCT FROM t THEN 'NONE' WHEN w IS NOT DISTINCT FROM b THEN CASE WHEN t IS NULL THEN 'REMOVE' WHEN b IS NULL THEN 'CREATE' ELSE 'UPDATE' END ELSE 'CONFLICT' END AS action FROM x",
    "status_full": """WITH p AS (SELECT p_partkey AS k, 'src/f' || p_partkey::VARCHAR AS src, CASE WHEN p_partkey % 11 = 0 THEN 'moved/f' ELSE 'src/f' END || p_partkey::VARCHAR AS ip FROM part),
        r AS (SELECT ip AS path, 8 AS f FROM p WHERE k % 11 = 0 AND k % 7 <> 0 UNION ALL SELECT ip, 1 FROM p WHERE k % 11 = 0 AND k % 7 = 0 UNION ALL SELECT src, 4 FROM p WHERE k % 11 = 0 AND k % 7 = 0 UNION ALL SELECT ip, 2 FROM p WHERE k % 11 <> 0 AND k % 7 = 0
            UNION ALL SELECT ip, 512 FROM p WHERE k % 13 = 0 UNION ALL SELECT ip, 256 FROM p WHERE k % 13 <> 0 AND k % 5 = 0 UNION ALL SELECT 'wt/f' || k::VARCHAR, 2048 FROM p WHERE k % 13 <> 0 AND k % 5 <> 0 AND k % 29 = 0
            UNION ALL SELECT 'build/f' || k::VARCHAR || '.o', 16384 FROM p WHERE k % 17 = 0 UNION ALL SELECT 'new/f' || k::VARCHAR, 128 FROM p WHERE k % 19 = 0),
        c AS (SELECT ip AS path FROM p WHERE k % 23 = 0)
        SELECT path, bit_or(f) AS flags FROM r WHERE path NOT IN (SELECT path FROM c) GROUP BY path UNION ALL SELECT path, 32768 FROM c""",
}

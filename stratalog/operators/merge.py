"""Three-way merges as a chain of two full outer joins and an ordered table of rules."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.plans import model as M
from stratalog.plans.model import with_sql
from stratalog.plans.spread import spread
from stratalog.sources.tables import table


def walk(sides: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """keys, and a struct (oid, mode) per side, null where a path is missing: the ordered walk of any number of trees as a
    chain of full outer joins. A side without modes holds plain files."""

    def side(df: DataFrame, n: str) -> DataFrame:
        mode = F.col("mode") if "mode" in df.columns else F.lit("100644")
        return df.select(*keys, F.struct(F.col("oid").alias("oid"), mode.alias("mode")).alias(n))

    out = None
    for n, df in sides.items():
        out = side(df, n) if out is None else out.join(side(df, n), keys, "full_outer")
    return out


def three_way(ancestor: DataFrame, ours: DataFrame, theirs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, a, o, t: the entries (oid, mode) of each path on the three sides, null where it is missing."""
    return walk({"a": ancestor, "o": ours, "t": theirs}, keys)


def side_status(a: Column, x: Column) -> Column:
    """What a side did to a path: a change of the kind of object is a TYPECHANGE, one of content or mode MODIFIED."""
    kind = lambda c: F.substring(c["mode"], 1, 2)
    return (
        F.when(a.isNull() & x.isNull(), "ABSENT").when(a.isNull(), "ADDED").when(x.isNull(), "DELETED")
        .when(kind(a) != kind(x), "TYPECHANGE").when((a["oid"] != x["oid"]) | (a["mode"] != x["mode"]), "MODIFIED").otherwise("UNMODIFIED")
    )


def resolve(three: DataFrame, keys: list[str]) -> DataFrame:
    """keys, result, oid, mode, conflict. result: OURS, THEIRS, BOTH (equal), REMOVED, or CONFLICT with its kind.

    Entries are compared by content and mode. Removed on both sides, or removed on one and unchanged on the other, is
    removed; removed against modified is a conflict; a side that alone changed wins; equal changes agree.
    """
    a, o, t = F.col("a"), F.col("o"), F.col("t")
    result = (
        F.when(o.eqNullSafe(t), F.when(o.isNull(), "REMOVED").otherwise("BOTH"))
        .when(a.eqNullSafe(o), F.when(t.isNull(), "REMOVED").otherwise("THEIRS"))
        .when(a.eqNullSafe(t), F.when(o.isNull(), "REMOVED").otherwise("OURS"))
        .otherwise("CONFLICT")
    )
    kind = F.when(result != "CONFLICT", None).when(a.isNull(), "BOTH_ADDED").when(o.isNull() | t.isNull(), "MODIFIED_DELETED").otherwise("BOTH_MODIFIED")
    entry = F.when(result == "OURS", o).when(result == "THEIRS", t).when(result == "BOTH", o)
    return three.select(*keys, result.alias("result"), entry["oid"].alias("oid"), entry["mode"].alias("mode"), kind.alias("conflict"))


def follow_renames(ancestor: DataFrame, ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """path, a, o, t, renamed: the three-way walk of trees (path, oid, mode) in which a path that one side moved, content
    unchanged, stands under its new name with the other side's version of the old one.

    A move is a path that a side lacks whose content stands on that side under exactly one path that the ancestor lacks,
    and under exactly one lost path. renamed: `o` or `t`, or null. A path that both sides moved apart stays as it is:
    removed under the old name and added under the new ones.
    """

    def moves(side: DataFrame, n: str) -> DataFrame:
        gone = ancestor.join(side.select("path"), "path", "left_anti").groupBy("oid").agg(F.min("path").alias("path"), F.count("*").alias("k")).where("k = 1")
        come = side.join(ancestor.select("path"), "path", "left_anti").groupBy("oid").agg(F.min("path").alias("new"), F.count("*").alias("k")).where("k = 1")
        return gone.select("oid", "path").join(come.select("oid", "new"), "oid").select("path", "new", F.lit(n).alias("by"))

    both = moves(ours, "o").unionByName(moves(theirs, "t"))
    once = both.groupBy("path").agg(F.count_distinct("new").alias("k"), F.min("new").alias("new"), F.min("by").alias("by")).where("k = 1").select("path", "new", "by")

    def moved(df: DataFrame) -> DataFrame:
        mode = F.col("mode") if "mode" in df.columns else F.lit("100644").alias("mode")
        return df.select("path", "oid", mode).join(once, "path", "left").select(F.coalesce("new", "path").alias("path"), "oid", "mode")

    return three_way(moved(ancestor), moved(ours), moved(theirs), ["path"]).join(once.select(F.col("new").alias("path"), F.col("by").alias("renamed")), "path", "left").select("path", "a", "o", "t", "renamed")


def directory_file(resolved: DataFrame) -> DataFrame:
    """path, below: paths of a merge's outcome (path text, result) that are files while others lie below them.

    Every path names its folders; a folder that is itself a kept path is in conflict. A path has as many folders as
    slashes, so this is a join by equal paths.
    """
    kept = resolved.where("result <> 'REMOVED'").select("path")
    parts = F.split("path", "/")
    folders = kept.where(F.col("path").contains("/")).select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).alias("path"))
    return kept.join(folders.groupBy("path").agg(F.count("*").alias("below")), "path")


def sides(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ancestor, ours and theirs over parts, with deterministic drops, edits and additions on both sides."""
    p = table(s, d, "part").select(F.col("p_partkey").alias("path"), F.col("p_size").cast("long").alias("oid"))
    k = F.col("path")
    p = p.withColumn("mode", F.when(k % 3 == 0, "100755").otherwise("100644"))
    base = p.where(k % 19 != 0)
    ours = p.where((k % 11 != 0) & (k % 38 != 0)).withColumn("oid", F.when(k % 7 == 0, F.col("oid") + 1000).when(k % 23 == 0, F.col("oid") + 9).otherwise(F.col("oid"))).withColumn("mode", F.when(k % 29 == 0, "120000").otherwise(F.col("mode")))
    theirs = p.where((k % 13 != 0) & (k % 57 != 0)).withColumn("oid", F.when(k % 5 == 0, F.col("oid") + 5000).when(k % 23 == 0, F.col("oid") + 9).otherwise(F.col("oid"))).withColumn("mode", F.when(k % 31 == 0, "100755").otherwise(F.col("mode")))
    return base, ours, theirs


def merge_trees(s: SparkSession, d: str) -> DataFrame:
    return resolve(three_way(*sides(s, d), ["path"]), ["path"])


def merge_side_status(s: SparkSession, d: str) -> DataFrame:
    """ours, theirs, paths: how often each pair of one-sided statuses occurs."""
    x = three_way(*sides(s, d), ["path"])
    return x.select(side_status(F.col("a"), F.col("o")).alias("ours"), side_status(F.col("a"), F.col("t")).alias("theirs")).groupBy("ours", "theirs").agg(F.count("*").alias("paths"))


def conflict_stages(s: SparkSession, d: str) -> DataFrame:
    """path, stage, oid, mode: the index rows of conflicts; stage 1 ancestor, 2 ours, 3 theirs."""
    x = three_way(*sides(s, d), ["path"])
    bad = resolve(x, ["path"]).where("result = 'CONFLICT'").select("path")
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("stage"), F.col(f"{c}.oid").alias("oid"), F.col(f"{c}.mode").alias("mode")) for i, c in ((1, "a"), (2, "o"), (3, "t"))]))
    return x.join(bad, "path", "left_semi").select("path", rows.alias("r")).select("path", "r.stage", "r.oid", "r.mode").where("oid IS NOT NULL")


def _named_sides(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three sides with paths as text; contents are unique but for key div 40. Ours moves keys that 7 divides to
    `moved/`, theirs those that 9 divides to `other/`; ours has files `lib<n>` where theirs has a folder of that name."""
    p = table(s, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").cast("long").alias("size"))
    k = F.col("k")
    plain = F.concat(F.lit("src/f"), k.cast("string"))
    oid = F.when(k % 40 == 0, -F.col("size")).otherwise(k * 100)
    base = p.where(k % 50 != 0).select(plain.alias("path"), oid.alias("oid"), F.lit("100644").alias("mode"))
    at_ours = F.when(k % 50 == 0, F.concat(F.lit("lib"), (k / 50).cast("long").cast("string"))).when(k % 7 == 0, F.concat(F.lit("moved/f"), k.cast("string"))).otherwise(plain)
    at_theirs = F.when(k % 50 == 0, F.concat(F.lit("lib"), (k / 100).cast("long").cast("string"), F.lit("/x/f"), k.cast("string"))).when(k % 9 == 0, F.concat(F.lit("other/f"), k.cast("string"))).otherwise(plain)
    ours = p.select(at_ours.alias("path"), oid.alias("oid"), F.lit("100644").alias("mode"))
    theirs = p.select(at_theirs.alias("path"), F.when(k % 5 == 1, oid + 1).otherwise(oid).alias("oid"), F.lit("100644").alias("mode"))
    return base, ours, theirs


def merge_renames(s: SparkSession, d: str) -> DataFrame:
    """path, result, oid, conflict, renamed of the merge that follows moves."""
    x = follow_renames(*_named_sides(s, d))
    return resolve(x, ["path", "renamed"]).select("path", "renamed", "result", "oid", "conflict")


def merge_directory_file(s: SparkSession, d: str) -> DataFrame:
    return directory_file(resolve(three_way(*_named_sides(s, d), ["path"]), ["path"]))


def n_way_walk(s: SparkSession, d: str) -> DataFrame:
    """mask, paths: in which of four trees paths stand, as bits: ancestor, ours, theirs, and theirs without edits."""
    a, o, t = sides(s, d)
    x = walk({"a": a, "o": o, "t": t, "u": t.where("path % 5 <> 0")}, ["path"])
    bits = sum((F.col(c).isNotNull().cast("int") * F.lit(1 << i) for i, c in enumerate("aotu")), F.lit(0))
    return x.groupBy(bits.alias("mask")).agg(F.count("*").alias("paths"))


def _apply(s: SparkSession, d: str, base: DataFrame, theirs: DataFrame) -> DataFrame:
    """Merges the change base -> theirs (both commit, name, oid, mode) into the tree of each project's head."""
    head = M.heads(s, d).join(M.tree_entries(s, d), F.col("head") == F.col("tree")).select(F.col("head").alias("commit"), "name", "oid", "mode")
    keys = ["commit", "name"]
    return resolve(three_way(base, head, theirs, keys), keys)


def _sides_of_picks(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """For each head: the trees before and after its grandparent's change, under the head's name."""
    p = M.parents(s, d).where("pos = 0")
    g = M.heads(s, d).join(p.select(F.col("oid").alias("head"), F.col("parent").alias("p1")), "head").join(p.select(F.col("oid").alias("p1"), F.col("parent").alias("p2")), "p1")
    e = M.tree_entries(s, d)
    before = g.join(e, F.col("p2") == F.col("tree")).select(F.col("head").alias("commit"), "name", "oid", "mode")
    after = g.join(e, F.col("p1") == F.col("tree")).select(F.col("head").alias("commit"), "name", "oid", "mode")
    return before, after


def cherry_pick(s: SparkSession, d: str) -> DataFrame:
    """The change of a head's first parent, applied to the head: a merge with the change's parent as the base."""
    before, after = _sides_of_picks(s, d)
    return _apply(s, d, before, after)


def revert(s: SparkSession, d: str) -> DataFrame:
    """The same change taken back: base and theirs swapped."""
    before, after = _sides_of_picks(s, d)
    return _apply(s, d, after, before)


def merge_lines(base: list[str], ours: list[str], theirs: list[str], favor: str = "none") -> tuple[list[str], int]:
    """(merged lines, conflicts) of three texts. Regions changed on one side take that side; equal changes agree.

    favor: none (conflict markers), ours, theirs, or union (both sides, ours first).
    """
    from difflib import SequenceMatcher

    def kept(x: list[str]) -> dict[int, int]:
        head = 0
        while head < min(len(base), len(x)) and base[head] == x[head]:
            head += 1
        tail = 0
        while tail < min(len(base), len(x)) - head and base[-1 - tail] == x[-1 - tail]:
            tail += 1
        mid = SequenceMatcher(None, base[head : len(base) - tail], x[head : len(x) - tail], autojunk=False).get_matching_blocks()
        same = {i: i for i in range(head)} | {head + i + k: head + j + k for i, j, n in mid for k in range(n)}
        return same | {len(base) - k: len(x) - k for k in range(1, tail + 1)}

    mo, mt = kept(ours), kept(theirs)
    out: list[str] = []
    conflicts = 0
    b = o = t = 0
    stops = [i for i in range(len(base)) if i in mo and i in mt] + [len(base)]
    for i in stops:
        jo, jt = (mo[i], mt[i]) if i < len(base) else (len(ours), len(theirs))
        pb, po, pt = base[b:i], ours[o:jo], theirs[t:jt]
        if po == pt or pt == pb:
            out += po
        elif po == pb:
            out += pt
        elif favor == "ours":
            out += po
        elif favor == "theirs":
            out += pt
        elif favor == "union":
            out += po + [x for x in pt if x not in po]
        else:
            conflicts += 1
            out += ["<<<<<<< ours", *po, "=======", *pt, ">>>>>>> theirs"]
        if i < len(base):
            out.append(base[i])
        b, o, t = i + 1, jo + 1, jt + 1
    return out, conflicts


def binary_merge(base: list[str], ours: list[str], theirs: list[str]) -> tuple[list[str], int]:
    """Whole contents: the side that changed wins; if both did, ours stays and counts as a conflict."""
    if ours == theirs or theirs == base:
        return ours, 0
    return (theirs, 0) if ours == base else (ours, 1)


#: Merge drivers by name: functions of the lines of base, ours and theirs to (lines, conflicts). More may be given.
DRIVERS = {
    "text": merge_lines, "binary": binary_merge,
    **{favor: (lambda b, o, t, favor=favor: merge_lines(b, o, t, favor)) for favor in ("ours", "theirs", "union")},
}


def merge_texts(df: DataFrame, favor: str = "none", drivers: dict | None = None) -> DataFrame:
    """id, merged, conflicts of rows with id, base, ours, theirs (texts; null counts as empty).

    A column `driver` names each row's merge driver, one of DRIVERS or of `drivers`; unknown and null names are `text`.
    """
    known = {**DRIVERS, **(drivers or {})}
    named = df.select("id", "base", "ours", "theirs", F.col("driver") if "driver" in df.columns else F.lit(None).cast("string").alias("driver"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, *texts, d in zip(pdf.id, pdf.base, pdf.ours, pdf.theirs, pdf.driver):
                sides = [(x or "").split("\n") for x in texts]
                merged, n = known[d](*sides) if d in known else merge_lines(*sides, favor)
                rows.append((i, "\n".join(merged), n))
            yield pd.DataFrame(rows, columns=["id", "merged", "conflicts"])

    return spread(named, "id").mapInPandas(work, "id long, merged string, conflicts int")


def merge_text_query(s: SparkSession, d: str) -> DataFrame:
    """Documents merged with two edits: ours marks the first line, theirs adds a last line."""
    t = table(s, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("base"))
    ours = F.concat(F.lit("> "), F.col("base"))
    return merge_texts(t.select("id", "base", ours.alias("ours"), F.concat("base", F.lit("\n-- end")).alias("theirs")))


def merge_drivers(s: SparkSession, d: str) -> DataFrame:
    """The same edits merged by the driver that an attribute would name."""
    t = table(s, d, "documents").where("text IS NOT NULL").select(F.col("doc_id").alias("id"), F.col("text").alias("base"))
    driver = F.element_at(F.array(*map(F.lit, ["union", "ours", "theirs", "binary"])), (F.col("id") % 4 + 1).cast("int"))
    return merge_texts(t.select("id", "base", F.concat(F.lit("> "), F.col("base")).alias("ours"), F.concat("base", F.lit("\n-- end")).alias("theirs"), driver.alias("driver")))


QUERIES = {"merge_drivers": merge_drivers, "merge_three_way": merge_trees, "merge_side_status": merge_side_status, "merge_conflict_stages": conflict_stages, "cherry_pick": cherry_pick, "revert": revert, "merge_text": merge_text_query, "merge_renames": merge_renames, "merge_directory_file": merge_directory_file, "n_way_walk": n_way_walk}

_SIDES = (
    "WITH p AS (SELECT p_partkey AS path, p_size::BIGINT AS oid, CASE WHEN p_partkey % 3 = 0 THEN '100755' ELSE '100644' END AS mode FROM part), a AS (SELECT * FROM p WHERE path % 19 <> 0),"
    " o AS (SELECT path, CASE WHEN path % 7 = 0 THEN oid + 1000 WHEN path % 23 = 0 THEN oid + 9 ELSE oid END AS oid, CASE WHEN path % 29 = 0 THEN '120000' ELSE mode END AS mode FROM p WHERE path % 11 <> 0 AND path % 38 <> 0),"
    " t AS (SELECT path, CASE WHEN path % 5 = 0 THEN oid + 5000 WHEN path % 23 = 0 THEN oid + 9 ELSE oid END AS oid, CASE WHEN path % 31 = 0 THEN '100755' ELSE mode END AS mode FROM p WHERE path % 13 <> 0 AND path % 57 <> 0),"
    " x AS (SELECT k.path, a.oid AS a, o.oid AS o, t.oid AS t, a.mode AS am, o.mode AS om, t.mode AS tm FROM (SELECT path FROM a UNION SELECT path FROM o UNION SELECT path FROM t) k LEFT JOIN a USING (path) LEFT JOIN o USING (path) LEFT JOIN t USING (path))"
)
_SAME = lambda x, y: f"({x} IS NOT DISTINCT FROM {y} AND {x}m IS NOT DISTINCT FROM {y}m)"
_RULES = (
    f"CASE WHEN {_SAME('o', 't')} THEN CASE WHEN o IS NULL THEN 'REMOVED' ELSE 'BOTH' END WHEN {_SAME('a', 'o')} THEN CASE WHEN t IS NULL THEN 'REMOVED' ELSE 'THEIRS' END"
    f" WHEN {_SAME('a', 't')} THEN CASE WHEN o IS NULL THEN 'REMOVED' ELSE 'OURS' END ELSE 'CONFLICT' END"
)
_KIND = "CASE WHEN result <> 'CONFLICT' THEN NULL WHEN a IS NULL THEN 'BOTH_ADDED' WHEN o IS NULL OR t IS NULL THEN 'MODIFIED_DELETED' ELSE 'BOTH_MODIFIED' END AS conflict"
_ENTRY = "CASE result WHEN 'OURS' THEN o{0} WHEN 'THEIRS' THEN t{0} WHEN 'BOTH' THEN o{0} END AS {1}"
_OUT = " SELECT {0}, result, " + _ENTRY.format("", "oid") + ", " + _ENTRY.format("m", "mode") + ", " + _KIND + " FROM r"
_STAT = "CASE WHEN a IS NULL AND {0} IS NULL THEN 'ABSENT' WHEN a IS NULL THEN 'ADDED' WHEN {0} IS NULL THEN 'DELETED' WHEN substr(am, 1, 2) <> substr({0}m, 1, 2) THEN 'TYPECHANGE' WHEN a = {0} AND am = {0}m THEN 'UNMODIFIED' ELSE 'MODIFIED' END"
_PICK = (
    ", fp AS (SELECT oid, parent FROM parents WHERE pos = 0), g AS (SELECT h.head, x.parent AS p1, y.parent AS p2 FROM heads h JOIN fp x ON x.oid = h.head JOIN fp y ON y.oid = x.parent),"
    " older AS (SELECT g.head AS commit, e.name, e.oid, e.mode FROM g JOIN entries e ON e.tree = g.p2), newer AS (SELECT g.head AS commit, e.name, e.oid, e.mode FROM g JOIN entries e ON e.tree = g.p1), mine AS (SELECT h.head AS commit, e.name, e.oid, e.mode FROM heads h JOIN entries e ON e.tree = h.head),"
    " k AS (SELECT commit, name FROM older UNION SELECT commit, name FROM newer UNION SELECT commit, name FROM mine), x AS (SELECT k.commit, k.name, a.oid AS a, o.oid AS o, t.oid AS t, a.mode AS am, o.mode AS om, t.mode AS tm FROM k LEFT JOIN {0} a ON a.commit = k.commit AND a.name = k.name LEFT JOIN mine o ON o.commit = k.commit AND o.name = k.name LEFT JOIN {1} t ON t.commit = k.commit AND t.name = k.name)"
)
_NAMED = """WITH p AS (SELECT p_partkey AS k, 'src/f' || p_partkey::VARCHAR AS plain, CASE WHEN p_partkey % 40 = 0 THEN -p_size::BIGINT ELSE p_partkey::BIGINT * 100 END AS oid FROM part), base AS (SELECT plain AS path, oid FROM p WHERE k % 50 <> 0),
    ours AS (SELECT CASE WHEN k % 50 = 0 THEN 'lib' || (k // 50)::VARCHAR WHEN k % 7 = 0 THEN 'moved/f' || k::VARCHAR ELSE plain END AS path, oid FROM p),
    theirs AS (SELECT CASE WHEN k % 50 = 0 THEN 'lib' || (k // 100)::VARCHAR || '/x/f' || k::VARCHAR WHEN k % 9 = 0 THEN 'other/f' || k::VARCHAR ELSE plain END AS path, CASE WHEN k % 5 = 1 THEN oid + 1 ELSE oid END AS oid FROM p)"""
SQL = {
    "merge_three_way": _SIDES + ", r AS (SELECT *, " + _RULES + " AS result FROM x)" + _OUT.format("path"),
    "merge_side_status": _SIDES + " SELECT " + _STAT.format("o") + " AS ours, " + _STAT.format("t") + " AS theirs, count(*) AS paths FROM x GROUP BY 1, 2",
    "merge_conflict_stages": _SIDES + ", r AS (SELECT *, " + _RULES + " AS result FROM x) SELECT path, 1 AS stage, a AS oid, am AS mode FROM r WHERE result = 'CONFLICT' AND a IS NOT NULL UNION ALL SELECT path, 2, o, om FROM r WHERE result = 'CONFLICT' AND o IS NOT NULL UNION ALL SELECT path, 3, t, tm FROM r WHERE result = 'CONFLICT' AND t IS NOT NULL",
    "cherry_pick": with_sql("commits parents heads entries", _PICK.format("older", "newer") + ", r AS (SELECT *, " + _RULES + " AS result FROM x)" + _OUT.format("commit, name")),
    "revert": with_sql("commits parents heads entries", _PICK.format("newer", "older") + ", r AS (SELECT *, " + _RULES + " AS result FROM x)" + _OUT.format("commit, name")),
    "merge_renames": _NAMED + """, gone_o AS (SELECT oid, min(path) AS path FROM base WHERE path NOT IN (SELECT path FROM ours) GROUP BY oid HAVING count(*) = 1), come_o AS (SELECT oid, min(path) AS new FROM ours WHERE path NOT IN (SELECT path FROM base) GROUP BY oid HAVING count(*) = 1),
        gone_t AS (SELECT oid, min(path) AS path FROM base WHERE path NOT IN (SELECT path FROM theirs) GROUP BY oid HAVING count(*) = 1), come_t AS (SELECT oid, min(path) AS new FROM theirs WHERE path NOT IN (SELECT path FROM base) GROUP BY oid HAVING count(*) = 1),
        m AS (SELECT path, new, 'o' AS side FROM gone_o JOIN come_o USING (oid) UNION ALL SELECT path, new, 't' FROM gone_t JOIN come_t USING (oid)), once AS (SELECT path, min(new) AS new, min(side) AS side FROM m GROUP BY path HAVING count(DISTINCT new) = 1),
        ma AS (SELECT coalesce(new, b.path) AS path, oid FROM base b LEFT JOIN once USING (path)), mo AS (SELECT coalesce(new, b.path) AS path, oid FROM ours b LEFT JOIN once USING (path)), mt AS (SELECT coalesce(new, b.path) AS path, oid FROM theirs b LEFT JOIN once USING (path)),
        k AS (SELECT path FROM ma UNION SELECT path FROM mo UNION SELECT path FROM mt), x AS (SELECT k.path, n.side AS renamed, ma.oid AS a, mo.oid AS o, mt.oid AS t, 1 AS am, 1 AS om, 1 AS tm FROM k LEFT JOIN ma USING (path) LEFT JOIN mo USING (path) LEFT JOIN mt USING (path) LEFT JOIN once n ON n.new = k.path),
        r AS (SELECT *, """ + _RULES + " AS result FROM x) SELECT path, renamed, result, " + _ENTRY.format("", "oid") + ", " + _KIND + " FROM r",
    "merge_directory_file": _NAMED + ", k AS (SELECT path FROM base UNION SELECT path FROM ours UNION SELECT path FROM theirs), x AS (SELECT k.path, b.oid AS a, o.oid AS o, t.oid AS t, 1 AS am, 1 AS om, 1 AS tm FROM k LEFT JOIN base b USING (path) LEFT JOIN ours o USING (path) LEFT JOIN theirs t USING (path)), r AS (SELECT path, " + _RULES + " AS result FROM x), kept AS (SELECT path FROM r WHERE result <> 'REMOVED') SELECT f.path, count(*) AS below FROM kept f JOIN kept g ON starts_with(g.path, f.path || '/') AND f.path LIKE 'lib%' GROUP BY f.path",
    "n_way_walk": _SIDES + ", u AS (SELECT * FROM t WHERE path % 5 <> 0) SELECT ((x.a IS NOT NULL)::INT + 2 * (x.o IS NOT NULL)::INT + 4 * (x.t IS NOT NULL)::INT + 8 * (u.oid IS NOT NULL)::INT)::INT AS mask, count(*) AS paths FROM x LEFT JOIN u USING (path) GROUP BY 1",
    "merge_text": "WITH t AS (SELECT doc_id AS id, text, string_split(text, chr(10)) AS l FROM documents), u AS (SELECT *, '> ' || l[1] AS top FROM t) SELECT id, CASE WHEN text IS NULL THEN '' WHEN len(l) > 1 THEN top || substr(text, length(l[1]) + 1) || chr(10) || '-- end' ELSE '<<<<<<< ours' || chr(10) || top || chr(10) || '=======' || chr(10) || text || chr(10) || '-- end' || chr(10) || '>>>>>>> theirs' END AS merged, CASE WHEN text IS NULL OR len(l) > 1 THEN 0 ELSE 1 END AS conflicts FROM u",
    "merge_drivers": "WITH t AS (SELECT doc_id AS id, text, len(string_split(text, chr(10))) > 1 AS many FROM documents WHERE text IS NOT NULL) SELECT id, CASE WHEN id % 4 = 3 THEN '> ' || text WHEN many THEN '> ' || text || chr(10) || '-- end' WHEN id % 4 = 0 THEN '> ' || text || chr(10) || text || chr(10) || '-- end' WHEN id % 4 = 1 THEN '> ' || text ELSE text || chr(10) || '-- end' END AS merged, CASE WHEN id % 4 = 3 THEN 1 ELSE 0 END AS conflicts FROM t",
}

"""Operators on the commit graph: closures by frontier loops, and what is derived from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalog.plans import model as M
from stratalog.plans.lineage import discard, written
from stratalog.plans.model import with_sql


def closure(edges: DataFrame, seeds: DataFrame, hidden: DataFrame | None = None, doublings: int = 2) -> DataFrame:
    """root, oid: every commit reachable from a seed (root, oid), the seed included; null seeds are left out.

    Each round joins only the frontier with the edges (oid, parent) and removes what its root has visited, so diamonds
    cost nothing. Edges are first joined with themselves `doublings` times, so that a round goes 2 ** doublings levels
    back: a history of n levels takes a quarter of n rounds at the default, for a few more edges. Rounds are written, as
    the loop would otherwise grow the plan. `hidden` (oid) is never entered: its ancestors stay if another way leads there.
    """
    edges = edges.where("oid IS NOT NULL AND parent IS NOT NULL").select("oid", "parent")
    front = seeds.where("root IS NOT NULL AND oid IS NOT NULL").select("root", "oid").distinct()
    if hidden is not None:
        front = front.join(hidden, "oid", "left_anti")
        edges = edges.join(hidden, "oid", "left_anti").join(hidden.select(F.col("oid").alias("parent")), "parent", "left_anti").select("oid", "parent")
    hops = written(edges, "edges")
    for _ in range(doublings):
        far = hops.select("oid", F.col("parent").alias("mid")).join(hops.select(F.col("oid").alias("mid"), "parent"), "mid").select("oid", "parent")
        hops = written(hops.unionByName(far).distinct(), "edges")
    front = written(front, "frontier")
    levels = [front]
    while not front.isEmpty():
        step = front.join(hops, "oid").select("root", F.col("parent").alias("oid")).distinct()
        front = written(step.join(reduce(DataFrame.unionByName, levels), ["root", "oid"], "left_anti"), "frontier")
        levels.append(front)
    return reduce(DataFrame.unionByName, levels)


def ahead_behind(pairs: DataFrame, reach: DataFrame) -> DataFrame:
    """a, b, ahead, behind: sizes of the one-sided differences of two commits' histories. reach: closure of all a and b.

    Only what the two have in common is joined; the differences follow from that and from the sizes of the histories, so
    a long history that many pairs share is never multiplied by them.
    """
    size = reach.groupBy("root").agg(F.count("*").alias("n"))
    mine = pairs.join(reach.select(F.col("root").alias("a"), "oid"), "a")
    both = mine.join(reach.join(pairs.select(F.col("b").alias("root")).distinct(), "root", "left_semi").select(F.col("root").alias("b"), "oid"), ["b", "oid"]).groupBy("a", "b").agg(F.count("*").alias("c"))
    sized = pairs.join(size.select(F.col("root").alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col("root").alias("b"), F.col("n").alias("nb")), "b").join(both, ["a", "b"], "left")
    common = F.coalesce("c", F.lit(0))
    return sized.select("a", "b", (F.col("na") - common).alias("ahead"), (F.col("nb") - common).alias("behind"))


def merge_bases(pairs: DataFrame, reach: DataFrame, edges: DataFrame) -> DataFrame:
    """a, b, base: common ancestors that are no proper ancestors of another common ancestor.

    The common ancestors are closed under taking parents, so one that isn't best is a parent of another one.
    """
    common = pairs.join(reach.select(F.col("root").alias("a"), "oid"), "a").join(reach.select(F.col("root").alias("b"), "oid"), ["b", "oid"]).select("a", "b", "oid")
    common = written(common, "common")
    worse = common.join(edges, "oid").select("a", "b", F.col("parent").alias("oid")).distinct()
    return common.join(worse, ["a", "b", "oid"], "left_anti").select("a", "b", F.col("oid").alias("base"))


def generations(nodes: DataFrame, edges: DataFrame, doublings: int = 2) -> DataFrame:
    """oid, generation: 1 for roots, else one more than the largest of the parents'.

    Edges are first joined with themselves, each pair keeping its longest way, so that a round settles 2 ** doublings
    levels; only nodes whose number has grown pass it on.
    """
    hops = written(edges.where("oid IS NOT NULL AND parent IS NOT NULL").select("oid", "parent", F.lit(1).alias("w")), "hops")
    for _ in range(doublings):
        far = hops.select("oid", F.col("parent").alias("mid"), "w").join(hops.select(F.col("oid").alias("mid"), "parent", F.col("w").alias("v")), "mid").select("oid", "parent", (F.col("w") + F.col("v")).alias("w"))
        longer = written(hops.unionByName(far).groupBy("oid", "parent").agg(F.max("w").alias("w")), "hops")
        discard(hops)
        hops = longer
    now = written(nodes.select("oid", F.lit(1).alias("generation"), F.lit(True).alias("moved")), "generation")
    while not (front := now.where("moved").select(F.col("oid").alias("parent"), "generation")).isEmpty():
        up = hops.join(front, "parent").groupBy("oid").agg(F.max(F.col("generation") + F.col("w")).alias("up"))
        new = written(now.join(up, "oid", "left").select("oid", F.greatest("generation", F.coalesce("up", "generation")).alias("generation"), F.coalesce(F.col("up") > F.col("generation"), F.lit(False)).alias("moved")), "generation")
        discard(now)
        now = new
    return now.select("oid", "generation")


def tips(p2c: DataFrame, edges: DataFrame) -> DataFrame:
    """project, tip: a project's commits without a child in the project."""
    child = p2c.join(edges, "oid").select("project", F.col("parent").alias("oid"))
    return p2c.join(child, ["project", "oid"], "left_anti").select("project", F.col("oid").alias("tip"))


def nth_ancestor(commits: DataFrame, parents: DataFrame, n: int) -> DataFrame:
    """oid, ancestor: the n-th first-parent ancestor; commits without one are left out."""
    step = parents.where("pos = 0").select(F.col("oid").alias("c"), "parent")
    out = commits.select("oid", F.col("oid").alias("ancestor"))
    for _ in range(n):
        out = out.join(step, out.ancestor == F.col("c")).select("oid", F.col("parent").alias("ancestor"))
    return out


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """node, family: the smallest node of the connected component. links: a, b; either direction counts."""
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    label = written(nodes.select("node", F.col("node").alias("family")), "family")
    while True:
        low = both.join(label, both.b == label.node).groupBy(F.col("a").alias("node")).agg(F.min("family").alias("low"))
        step = label.join(low, "node", "left").select("node", "family", F.least("family", F.coalesce("low", "family")).alias("new"))
        jump = label.select(F.col("node").alias("new"), F.col("family").alias("far"))  # the label of the label
        new = written(step.join(jump, "new", "left").select("node", F.least("new", F.coalesce("far", "new")).alias("family"), (F.least("new", F.coalesce("far", "new")) < F.col("family")).alias("moved")), "family")
        if new.where("moved").isEmpty():
            return new.select("node", "family")
        label = new.select("node", "family")


# ------------------------------------------------------------------------------------------------------------- queries


def _reach_heads(s: SparkSession, d: str) -> DataFrame:
    return closure(M.edges(s, d), M.heads(s, d).select(F.col("head").alias("root"), F.col("head").alias("oid")))


def reachable(s: SparkSession, d: str) -> DataFrame:
    return _reach_heads(s, d).select(F.col("root").alias("head"), "oid")


def revwalk_hide(s: SparkSession, d: str) -> DataFrame:
    """Per head: its history without that of its first parent."""
    first = M.parents(s, d).where("pos = 0").select(F.col("oid").alias("head"), F.col("parent"))
    h = M.heads(s, d).join(first, "head").select("head", "parent")
    seeds = h.select(F.col("head").alias("root"), F.col("head").alias("oid")).unionByName(h.select(-F.col("head") - 1, "parent").toDF("root", "oid"))
    both = closure(M.edges(s, d), seeds)
    shown = both.where("root >= 0").join(h.select(F.col("head").alias("root")), "root", "left_semi")
    return shown.join(both.where("root < 0").select((-F.col("root") - 1).alias("root"), "oid"), ["root", "oid"], "left_anti").select(F.col("root").alias("head"), "oid")


def first_parent_walk(s: SparkSession, d: str) -> DataFrame:
    e = M.parents(s, d).where("pos = 0").select("oid", "parent")
    return closure(e, M.heads(s, d).select(F.col("head").alias("root"), F.col("head").alias("oid"))).select(F.col("root").alias("head"), "oid")


def hide_callback(s: SparkSession, d: str) -> DataFrame:
    """Commits of priority 5-LOW are hidden: neither shown nor walked through."""
    hidden = M.commits(s, d).where("subject = '5-LOW'").select("oid")
    return closure(M.edges(s, d), M.heads(s, d).select(F.col("head").alias("root"), F.col("head").alias("oid")), hidden).select(F.col("root").alias("head"), "oid")


def q_ahead_behind(s: SparkSession, d: str) -> DataFrame:
    return ahead_behind(M.head_pairs(s, d), written(_reach_heads(s, d), "reach"))


def q_merge_base(s: SparkSession, d: str) -> DataFrame:
    return merge_bases(M.head_pairs(s, d), written(_reach_heads(s, d), "reach"), M.edges(s, d))


def analysis(pairs: DataFrame, reach: DataFrame) -> DataFrame:
    """a (ours), b (theirs), kind: UNBORN without ours, UP_TO_DATE if theirs is in our history, FASTFORWARD if ours is in
    theirs, else NORMAL. reach: closure of all a and b."""
    up = pairs.join(reach.select(F.col("root").alias("a"), F.col("oid").alias("b")), ["a", "b"], "left_semi").select("a", "b", F.lit(True).alias("up"))
    ff = pairs.join(reach.select(F.col("root").alias("b"), F.col("oid").alias("a")), ["b", "a"], "left_semi").select("a", "b", F.lit(True).alias("ff"))
    kind = F.when(F.col("a").isNull(), "UNBORN").when(F.col("up"), "UP_TO_DATE").when(F.col("ff"), "FASTFORWARD").otherwise("NORMAL")
    return pairs.join(up, ["a", "b"], "left").join(ff, ["a", "b"], "left").select("a", "b", kind.alias("kind"))


def merge_analysis(s: SparkSession, d: str) -> DataFrame:
    """project, a, b, kind: each customer's head against the newest head of its nation; customers without orders have none."""
    from stratalog.sources.tables import table

    c = table(s, d, "customer").select(F.col("c_custkey").alias("project"), F.col("c_nationkey").alias("nation"))
    h = c.join(M.heads(s, d), "project", "left")
    sides = h.join(h.groupBy("nation").agg(F.max("head").alias("b")), "nation").select("project", F.col("head").alias("a"), "b").where("b IS NOT NULL")
    kinds = analysis(sides.select("a", "b").distinct(), written(_reach_heads(s, d), "reach")).select(F.col("a").alias("_a"), F.col("b").alias("_b"), "kind")
    return sides.join(kinds, F.col("a").eqNullSafe(F.col("_a")) & (F.col("b") == F.col("_b"))).select("project", "a", "b", "kind")


def octopus_bases(groups: DataFrame, reach: DataFrame, edges: DataFrame) -> DataFrame:
    """grp, base: best common ancestors of all commits of a group (grp, root). reach: closure of all roots."""
    n = groups.groupBy("grp").agg(F.count("*").alias("n"))
    common = written(groups.join(reach, "root").groupBy("grp", "oid").agg(F.count("*").alias("c")).join(n, "grp").where("c = n").select("grp", "oid"), "common")
    worse = common.join(edges, "oid").select("grp", F.col("parent").alias("oid")).distinct()
    return common.join(worse, ["grp", "oid"], "left_anti").select("grp", F.col("oid").alias("base"))


def octopus_base(s: SparkSession, d: str) -> DataFrame:
    """head, base: best common ancestors of each head, its first parent, and the newest head of its nation."""
    p = M.parents(s, d).where("pos = 0").select(F.col("oid").alias("a"), "parent")
    pairs = M.head_pairs(s, d).join(p, "a")
    groups = written(pairs.select(F.col("a").alias("grp"), F.explode(F.array("a", "b", "parent")).alias("root")).distinct(), "groups")
    e = M.edges(s, d)
    reach = closure(e, groups.select("root", F.col("root").alias("oid")).distinct())
    return octopus_bases(groups, reach, e).select(F.col("grp").alias("head"), "base")


def q_generations(s: SparkSession, d: str) -> DataFrame:
    return generations(M.commits(s, d), M.edges(s, d))


def q_tips(s: SparkSession, d: str) -> DataFrame:
    return tips(M.commits(s, d).select("project", "oid"), M.edges(s, d))


def global_tips(s: SparkSession, d: str) -> DataFrame:
    c = M.commits(s, d)
    return c.join(M.edges(s, d).select(F.col("parent").alias("oid")), "oid", "left_anti").select("project", F.col("oid").alias("tip"))


def incremental_tips(s: SparkSession, d: str) -> DataFrame:
    """Tips after a new batch of commits from the tips before it: minus the batch's parents, plus its own leaves."""
    e = M.edges(s, d)
    c = M.commits(s, d).select("project", "oid")
    cut = F.col("oid") % 10 == 9
    newest = c.where(cut)
    old = tips(c.where(~cut), e.where("oid % 10 <> 9 AND parent % 10 <> 9"))
    fresh = newest.select("project", F.col("oid").alias("tip"))
    gone = c.join(e, "oid").select("project", F.col("parent").alias("tip"))
    return old.unionByName(fresh).join(gone, ["project", "tip"], "left_anti")


def q_nth_ancestor(s: SparkSession, d: str) -> DataFrame:
    return nth_ancestor(M.commits(s, d), M.parents(s, d), 3)


def second_parent(s: SparkSession, d: str) -> DataFrame:
    return M.parents(s, d).where("pos = 1").select("oid", "parent")


def commit_children(s: SparkSession, d: str) -> DataFrame:
    return M.edges(s, d).groupBy(F.col("parent").alias("oid")).agg(F.count("*").alias("n_children"), F.min("oid").alias("first_child"))


def reachable_from_any(s: SparkSession, d: str) -> DataFrame:
    """Commits reachable from a head of the BUILDING segment, the heads included."""
    from stratalog.sources.tables import table

    some = M.heads(s, d).join(table(s, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("project")), "project", "left_semi")
    return closure(M.edges(s, d), some.select(F.lit(0).cast("long").alias("root"), F.col("head").alias("oid"))).select("oid")


def descendant_of(s: SparkSession, d: str) -> DataFrame:
    """a, b: pairs of heads of which a is a proper descendant of b."""
    reach = _reach_heads(s, d).select(F.col("root").alias("a"), F.col("oid").alias("b"))
    return reach.join(M.heads(s, d).select(F.col("head").alias("b")), "b", "left_semi").where("a <> b").select("a", "b")


def describe(s: SparkSession, d: str) -> DataFrame:
    """head, tag, depth: the tag (priority 1-URGENT) in a head's history with the fewest commits outside the tag's own.

    Equal depths: the larger key. Heads without a tagged ancestor are left out.
    """
    tags = M.commits(s, d).where("subject = '1-URGENT'").select(F.col("oid").alias("tag"))
    e = M.edges(s, d)
    reach = written(_reach_heads(s, d), "reach")
    cand = written(reach.join(tags, reach.oid == tags.tag).select(F.col("root").alias("head"), "tag"), "candidates")
    own = closure(e, cand.select(F.col("tag").alias("root"), F.col("tag").alias("oid")).distinct()).groupBy(F.col("root").alias("tag")).agg(F.count("*").alias("in_tag"))
    size = reach.groupBy(F.col("root").alias("head")).agg(F.count("*").alias("all"))
    # A tag's history is part of the history of every head that reaches it, so the difference of sizes is the depth.
    depth = cand.join(own, "tag").join(size, "head").select("head", "tag", (F.col("all") - F.col("in_tag")).alias("depth"))
    return depth.groupBy("head").agg(F.max_by("tag", F.struct(-F.col("depth"), F.col("tag"))).alias("tag"), F.min("depth").alias("depth"))


def topo_rank(s: SparkSession, d: str) -> DataFrame:
    """oid, rank: longest way from a commit without children; parents always have a larger rank than their children."""
    e = M.edges(s, d)
    return generations(M.commits(s, d), e.select(F.col("parent").alias("oid"), F.col("oid").alias("parent"))).select("oid", (F.col("generation") - 1).alias("rank"))


def fork_families(s: SparkSession, d: str) -> DataFrame:
    """node, family: projects joined by merges across projects."""
    c = M.commits(s, d).select("oid", "project")
    link = M.edges(s, d).join(c, "oid").join(c.select(F.col("oid").alias("parent"), F.col("project").alias("b")), "parent").select(F.col("project").alias("a"), "b").where("a <> b")
    return components(c.select(F.col("project").alias("node")).distinct(), link)


def new_commits(s: SparkSession, d: str) -> DataFrame:
    """Reachable from the heads but not from the second-newest commits of the projects (an update's new commits)."""
    w = Window.partitionBy("project").orderBy(F.desc("oid"))
    old = M.commits(s, d).withColumn("r", F.row_number().over(w)).where("r = 2").select(F.lit(1).alias("root"), "oid")
    seeds = M.heads(s, d).select(F.lit(0).alias("root"), F.col("head").alias("oid")).unionByName(old)
    both = written(closure(M.edges(s, d), seeds), "reach")
    return both.where("root = 0").select("oid").join(both.where("root = 1").select("oid"), "oid", "left_anti")


QUERIES = {
    "revwalk_reachable": reachable, "revwalk_hide": revwalk_hide, "revwalk_first_parent": first_parent_walk, "revwalk_hide_callback": hide_callback, "ahead_behind": q_ahead_behind, "merge_base": q_merge_base,
    "merge_analysis": merge_analysis, "octopus_base": octopus_base, "generation_numbers": q_generations, "project_tips": q_tips, "global_tips": global_tips, "incremental_tips": incremental_tips, "nth_ancestor": q_nth_ancestor,
    "second_parent": second_parent, "commit_children": commit_children, "reachable_from_any": reachable_from_any, "descendant_of": descendant_of, "describe": describe, "topo_rank": topo_rank, "fork_families": fork_families, "new_commits": new_commits,
}

_G = "commits parents edges heads "
SQL = {
    "revwalk_reachable": with_sql(_G + "closure", "SELECT root AS head, oid FROM closure"),
    "revwalk_hide": with_sql(_G, ", hidden AS (SELECT h.head, p.parent AS oid FROM heads h JOIN parents p ON p.oid = h.head AND p.pos = 0 UNION SELECT x.head, e.parent FROM hidden x JOIN edges e ON e.oid = x.oid), shown AS (SELECT h.head, h.head AS oid FROM heads h JOIN parents p ON p.oid = h.head AND p.pos = 0 UNION SELECT x.head, e.parent FROM shown x JOIN edges e ON e.oid = x.oid) SELECT head, oid FROM shown EXCEPT SELECT head, oid FROM hidden"),
    "revwalk_first_parent": with_sql(_G, ", walk AS (SELECT head, head AS oid FROM heads UNION SELECT w.head, p.parent FROM walk w JOIN parents p ON p.oid = w.oid AND p.pos = 0) SELECT head, oid FROM walk"),
    "revwalk_hide_callback": with_sql(_G, ", ok AS (SELECT oid FROM commits WHERE subject <> '5-LOW'), walk AS (SELECT head, head AS oid FROM heads WHERE head IN (SELECT oid FROM ok) UNION SELECT w.head, e.parent FROM walk w JOIN edges e ON e.oid = w.oid JOIN ok ON ok.oid = e.parent) SELECT head, oid FROM walk"),
    "ahead_behind": with_sql(_G + "pairs closure", ", m AS (SELECT a, b, x.oid, 1 AS s FROM pairs JOIN closure x ON x.root = a UNION ALL SELECT a, b, y.oid, 2 FROM pairs JOIN closure y ON y.root = b), t AS (SELECT a, b, oid, sum(s) AS s FROM m GROUP BY ALL) SELECT a, b, count(*) FILTER (s = 1) AS ahead, count(*) FILTER (s = 2) AS behind FROM t GROUP BY a, b"),
    "merge_base": with_sql(_G + "pairs closure", ", common AS (SELECT a, b, x.oid FROM pairs JOIN closure x ON x.root = a JOIN closure y ON y.root = b AND y.oid = x.oid) SELECT a, b, oid AS base FROM common c WHERE NOT EXISTS (SELECT 1 FROM common k JOIN edges e ON e.oid = k.oid WHERE k.a = c.a AND k.b = c.b AND e.parent = c.oid)"),
    "merge_analysis": with_sql(_G + "closure", ", h AS (SELECT c_custkey AS project, c_nationkey AS nation, head FROM customer LEFT JOIN heads ON project = c_custkey), t AS (SELECT project, head AS a, max(head) OVER (PARTITION BY nation) AS b FROM h) SELECT project, a, b, CASE WHEN a IS NULL THEN 'UNBORN' WHEN EXISTS (SELECT 1 FROM closure c WHERE c.root = a AND c.oid = b) THEN 'UP_TO_DATE' WHEN EXISTS (SELECT 1 FROM closure c WHERE c.root = b AND c.oid = a) THEN 'FASTFORWARD' ELSE 'NORMAL' END AS kind FROM t WHERE b IS NOT NULL"),
    "octopus_base": with_sql(_G + "pairs", ", q AS (SELECT a, b, parent FROM pairs JOIN parents ON oid = a AND pos = 0), h AS (SELECT a AS head, a AS root FROM q UNION SELECT a, b FROM q UNION SELECT a, parent FROM q), closure AS (SELECT root, root AS oid FROM (SELECT DISTINCT root FROM h) UNION SELECT c.root, e.parent FROM closure c JOIN edges e ON e.oid = c.oid), n AS (SELECT head, count(*) AS n FROM h GROUP BY 1), common AS (SELECT h.head, c.oid FROM h JOIN closure c ON c.root = h.root JOIN n ON n.head = h.head GROUP BY h.head, c.oid, n HAVING count(*) = n) SELECT head, oid AS base FROM common c WHERE NOT EXISTS (SELECT 1 FROM common k JOIN edges e ON e.oid = k.oid WHERE k.head = c.head AND e.parent = c.oid)"),
    "generation_numbers": with_sql("commits parents edges", ", g AS (SELECT oid, 1 AS generation FROM commits WHERE oid NOT IN (SELECT oid FROM edges) UNION SELECT e.oid, g.generation + 1 FROM g JOIN edges e ON e.parent = g.oid) SELECT oid, max(generation) AS generation FROM g GROUP BY oid"),
    "project_tips": with_sql("commits parents edges", "SELECT project, oid AS tip FROM commits c WHERE NOT EXISTS (SELECT 1 FROM edges e JOIN commits k ON k.oid = e.oid WHERE e.parent = c.oid AND k.project = c.project)"),
    "global_tips": with_sql("commits parents edges", "SELECT project, oid AS tip FROM commits WHERE oid NOT IN (SELECT parent FROM edges)"),
    "incremental_tips": with_sql("commits parents edges", "SELECT project, oid AS tip FROM commits c WHERE NOT EXISTS (SELECT 1 FROM edges e JOIN commits k ON k.oid = e.oid WHERE e.parent = c.oid AND k.project = c.project)"),
    "nth_ancestor": with_sql("commits parents", "SELECT a.oid, c.parent AS ancestor FROM parents a JOIN parents b ON b.oid = a.parent AND b.pos = 0 JOIN parents c ON c.oid = b.parent AND c.pos = 0 WHERE a.pos = 0"),
    "second_parent": with_sql("commits parents", "SELECT oid, parent FROM parents WHERE pos = 1"),
    "commit_children": with_sql("commits parents edges", "SELECT parent AS oid, count(*) AS n_children, min(oid) AS first_child FROM edges GROUP BY parent"),
    "reachable_from_any": with_sql(_G, ", r AS (SELECT head AS oid FROM heads JOIN customer ON c_custkey = project WHERE c_mktsegment = 'BUILDING' UNION SELECT e.parent FROM r JOIN edges e ON e.oid = r.oid) SELECT oid FROM r"),
    "descendant_of": with_sql(_G + "closure", "SELECT root AS a, oid AS b FROM closure WHERE root <> oid AND oid IN (SELECT head FROM heads)"),
    "describe": with_sql(_G + "full", ", z AS (SELECT root, count(*) AS n FROM closure GROUP BY root), d AS (SELECT c.root AS head, c.oid AS tag, a.n - t.n AS depth FROM closure c JOIN commits k ON k.oid = c.oid JOIN heads h ON h.head = c.root JOIN z a ON a.root = c.root JOIN z t ON t.root = c.oid WHERE k.subject = '1-URGENT') SELECT head, tag, depth FROM (SELECT *, row_number() OVER (PARTITION BY head ORDER BY depth, tag DESC) AS r FROM d) WHERE r = 1"),
    "topo_rank": with_sql("commits parents edges", ", g AS (SELECT oid, 0 AS rank FROM commits WHERE oid NOT IN (SELECT parent FROM edges) UNION SELECT e.parent, g.rank + 1 FROM g JOIN edges e ON e.oid = g.oid) SELECT oid, max(rank) AS rank FROM g GROUP BY oid"),
    "new_commits": with_sql(_G, ", o AS (SELECT oid FROM (SELECT oid, row_number() OVER (PARTITION BY project ORDER BY oid DESC) AS r FROM commits) WHERE r = 2 UNION SELECT e.parent FROM o JOIN edges e ON e.oid = o.oid), n AS (SELECT head AS oid FROM heads UNION SELECT e.parent FROM n JOIN edges e ON e.oid = n.oid) SELECT oid FROM n EXCEPT SELECT oid FROM o"),
    "fork_families": with_sql("commits parents edges", ", l AS (SELECT DISTINCT a.project AS a, b.project AS b FROM edges e JOIN commits a ON a.oid = e.oid JOIN commits b ON b.oid = e.parent WHERE a.project <> b.project), u AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r AS (SELECT DISTINCT project AS node, project AS o FROM commits UNION SELECT r.node, u.b FROM r JOIN u ON u.a = r.o) SELECT node, min(o) AS family FROM r GROUP BY node"),
}

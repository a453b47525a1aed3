"""Text sources and sinks: separated lists, reflogs, heads of fetches and merges, settings, patches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import unified_diff

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.plans.lineage import written
from stratalog.plans.spread import spread
from stratalog.sources.tables import table


def separated(lines: Column, names: list[str]) -> list[Column]:
    """Columns of a `;`-separated line; missing fields are null, fields beyond the names stay in the last one."""
    parts = F.split(lines, ";", len(names))
    return [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)]


def registry(lines: DataFrame, column: str, names: list[str]) -> DataFrame:
    """Rows of a registry file: `;`-separated, `#` begins a comment line, blank lines are skipped."""
    c = F.trim(column)
    return lines.where((c != "") & ~c.startswith("#")).select(*separated(c, names))


def reflog_line(c: Column) -> Column:
    """struct<old, new, name, mail, epoch, tz_min, message> of a reflog line; null if it is none.

    The offset keeps its sign: -0000 and +0000 are both 0 minutes, other offsets are hours and minutes.
    """
    rx = r"^([0-9a-f]{40}) ([0-9a-f]{40}) (.*) <([^<>]*)> (\d+) ([+-])(\d{2})(\d{2})(?:\t(.*))?\z"
    g = lambda i: F.regexp_extract(c, rx, i)
    minutes = (g(7).cast("int") * 60 + g(8).cast("int")) * F.when(g(6) == "-", -1).otherwise(1)
    return F.when(c.rlike(rx), F.struct(g(1).alias("old"), g(2).alias("new"), g(3).alias("name"), g(4).alias("mail"), g(5).cast("long").alias("epoch"), minutes.alias("tz_min"), g(9).alias("message")))


def fetch_head_line(c: Column) -> Column:
    """struct<oid, for_merge, kind, name, url> of a line that a fetch noted."""
    rx = r"^([0-9a-f]{40})\t(not-for-merge)?\t(?:(branch|tag|remote-tracking branch) '([^']*)' of )?(.*)\z"
    g = lambda i: F.regexp_extract(c, rx, i)
    return F.when(c.rlike(rx), F.struct(g(1).alias("oid"), (g(2) == "").alias("for_merge"), g(3).alias("kind"), g(4).alias("name"), g(5).alias("url")))


_SECTION = re.compile(r'\[\s*([A-Za-z0-9.-]+)(?:\s+"((?:[^"\\]|\\.)*)")?\s*\]\s*')
_ENTRY = re.compile(r"([A-Za-z][A-Za-z0-9-]*)\s*(?:=\s*(.*))?\Z")


def config_entries(text: str | None) -> list[tuple[str, str, int]]:
    """(name, value, position) of a settings text. A key without `=` is true; quotes, escapes, comments and continued
    lines are resolved; lines that are no entry are skipped."""
    out: list[tuple[str, str, int]] = []
    section = ""
    for raw in re.sub(r"\\\r?\n", "", text or "").split("\n"):
        line = raw.strip()
        m = _SECTION.match(line)
        if m:
            section = m[1].lower() + (f".{re.sub(r'\\(.)', r'\1', m[2])}" if m[2] is not None else "")
            line = line[m.end() :]
        if not line or line[0] in "#;" or not section:
            continue
        e = _ENTRY.match(line)
        if not e:
            continue
        value, quoted, i, s = "", False, 0, e[2] if e[2] is not None else "true"
        while i < len(s):
            ch = s[i]
            if ch == '"':
                quoted = not quoted
            elif ch == "\\" and i + 1 < len(s):
                i += 1
                value += {"n": "\n", "t": "\t", "b": "\b"}.get(s[i], s[i])
            elif ch in "#;" and not quoted:
                break
            else:
                value += ch
            i += 1
        out.append((f"{section}.{e[1].lower()}", value if quoted or s.rstrip().endswith('"') else value.rstrip(), len(out)))
    return out


def config_rows(files: DataFrame) -> DataFrame:
    """origin, level, name, value, pos of settings files (origin, level, text)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(o, lv, *e) for o, lv, t in zip(pdf.origin, pdf.level, pdf.text) for e in config_entries(t)], columns=["origin", "level", "name", "value", "pos"])

    return files.select(F.col("origin").cast("string"), F.col("level").cast("int"), "text").mapInPandas(work, "origin string, level int, name string, value string, pos int")


def included(rows: DataFrame, files: DataFrame, most: int = 10) -> DataFrame:
    """`rows` of config_rows with the entries of included files (origin, text) behind the entry that names them.

    `include.path` names the origin of another file, to be read at the includer's level and place. More than `most` files
    within each other are an error, as cycles are.
    """
    known = config_rows(files.select("origin", F.lit(0).alias("level"), "text")).select(F.col("origin").alias("_file"), F.col("name").alias("_name"), F.col("value").alias("_value"), F.col("pos").alias("_pos"))
    done = rows.select("origin", "level", "name", "value", F.array(F.col("pos").cast("int")).alias("at"))
    front = done
    for _ in range(most + 1):
        step = front.where("name = 'include.path'").join(known, F.col("value") == F.col("_file")).select("origin", "level", F.col("_name").alias("name"), F.col("_value").alias("value"), F.concat("at", F.array("_pos")).alias("at"))
        front = written(step, "included")
        if front.isEmpty():
            break
        done = done.unionByName(front)
    else:
        raise ValueError("settings files include each other too deeply")
    return done


def effective_config(rows: DataFrame) -> DataFrame:
    """name, value: the value of the highest level, the last one within it. rows have `pos`, or `at` behind includes."""
    place = "at" if "at" in rows.columns else "pos"
    return rows.groupBy("name").agg(F.max_by("value", F.struct("level", place, "origin")).alias("value"))


_HUNK = re.compile(r"@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@(.*)\Z")


def patch_lines(text: str | None) -> list[tuple[int, str, int, int, str]]:
    """(hunk, origin, old line, new line, content) of a patch. Origins are ` `, `-`, `+`; the other side's line is -1."""
    out, hunk, o, n = [], -1, 0, 0
    lo = ln = 0
    for line in (text or "").split("\n"):
        m = _HUNK.match(line)
        if m and lo <= 0 and ln <= 0:
            hunk, o, n = hunk + 1, int(m[1]), int(m[3])
            lo, ln = int(m[2] or 1), int(m[4] or 1)
        elif hunk >= 0 and (lo > 0 or ln > 0) and line[:1] in (" ", "-", "+", ""):
            kind = line[:1] or " "
            out.append((hunk, kind, o if kind != "+" else -1, n if kind != "-" else -1, line[1:]))
            o, lo = o + (kind != "+"), lo - (kind != "+")
            n, ln = n + (kind != "-"), ln - (kind != "-")
    return out


def patch_rows(patches: DataFrame) -> DataFrame:
    """id, hunk, origin, old_line, new_line, content of patch texts (id, patch)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(i, *r) for i, t in zip(pdf.id, pdf.patch) for r in patch_lines(t)], columns=["id", "hunk", "origin", "old_line", "new_line", "content"])

    return spread(patches.select("id", "patch"), "id").mapInPandas(work, "id long, hunk int, origin string, old_line int, new_line int, content string")


def patch_text(df: DataFrame) -> DataFrame:
    """id, patch: unified patch texts of rows with id, old, new."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf.id, "patch": ["\n".join(unified_diff((a or "").split("\n"), (b or "").split("\n"), f"a/{i}", f"b/{i}", lineterm="")) for i, a, b in zip(pdf.id, pdf.old, pdf.new)]})

    return spread(df.select("id", "old", "new"), "id").mapInPandas(work, "id long, patch string")


def mail_text(name: Column, mail: Column, subject: Column, body: Column, number: Column, total: Column) -> Column:
    """A patch as a mail: sender, numbered subject, body, separator."""
    n = F.when(total > 1, F.format_string("[PATCH %d/%d] ", number, total)).otherwise(F.lit("[PATCH] "))
    return F.concat(F.lit("From: "), name, F.lit(" <"), mail, F.lit(">\nSubject: "), n, subject, F.lit("\n\n"), body, F.lit("\n---\n"))


# ------------------------------------------------------------------------------------------------------------- queries


def q_olist_text(s: SparkSession, d: str) -> DataFrame:
    """The object list written as `;`-separated lines and read again."""
    o = table(s, d, "olist").where("repo IS NOT NULL AND sha IS NOT NULL AND path IS NOT NULL").where(~F.concat("repo", "sha").contains(";"))
    return o.select("line_no", F.concat_ws(";", "repo", "type", "sha", "path").alias("line")).select("line_no", *separated(F.col("line"), ["repo", "type", "sha", "path"]))


def q_reflog_text(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "p2tips").where("commit_sha IS NOT NULL AND taken_at IS NOT NULL")
    line = F.concat(F.lit("0" * 40 + " "), F.col("commit_sha"), F.lit(" Tip Taker <tips@hub.example> "), F.unix_seconds(F.col("taken_at").cast("timestamp")).cast("string"), F.lit(" -0130\tupdate by push"))
    return t.select("tip_id", reflog_line(line).alias("r")).select("tip_id", "r.new", "r.mail", "r.epoch", "r.tz_min", "r.message")


def q_config(s: SparkSession, d: str) -> DataFrame:
    """Settings of three levels, one file per nation, and the values in effect."""
    n = table(s, d, "nation")
    text = F.concat(F.lit("# nation\n[core]\n\tname = \""), F.col("n_name"), F.lit("\" ; note\n\tbare\n[remote \"r"), F.col("n_regionkey").cast("string"), F.lit("\"]\n\turl = https://hub.example/"), F.lower("n_name"), F.lit("\n"))
    return effective_config(config_rows(n.select(F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("origin"), (F.col("n_nationkey") % 3).alias("level"), text.alias("text"))))


def q_patch(s: SparkSession, d: str) -> DataFrame:
    """origin, n: lines of the patches from the documents to their upper-cased first lines, written and parsed again."""
    t = table(s, d, "documents").where("text IS NOT NULL").select(F.col("doc_id").alias("id"), F.col("text").alias("old"))
    new = F.concat(F.lit("# added\n"), F.col("old"))
    return patch_rows(patch_text(t.select("id", "old", new.alias("new")))).groupBy("origin").agg(F.count("*").alias("n"))


def q_config_include(s: SparkSession, d: str) -> DataFrame:
    """Settings of the nations; each includes the file of its region, and sets a value before and one behind that."""
    n, r = table(s, d, "nation"), table(s, d, "region")
    region = r.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("origin"), F.concat(F.lit("[core]\n\teditor = region\n\tpager = "), F.lower("r_name"), F.lit("\n")).alias("text"))
    own = n.select(F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("origin"), F.lit(1).alias("level"), F.concat(F.lit("[core]\n\teditor = "), F.lower("n_name"), F.lit("\n[include]\n\tpath = r"), F.col("n_regionkey").cast("string"), F.lit("\n[core]\n\tname = "), "n_name", F.lit("\n")).alias("text"))
    rows = included(config_rows(own), region)
    per = rows.groupBy("origin", "name").agg(F.max_by("value", F.struct("level", "at")).alias("value"))
    return per.where("name <> 'include.path'").select("origin", "name", "value")


def fetch_heads(c: Column) -> Column:
    """struct<oid, merge, kind, name, remote> of a FETCH_HEAD line; null for other lines. kind: branch, tag or empty."""
    rx = r"^([0-9a-f]{40})\t(not-for-merge)?\t(?:(branch|tag) '([^']*)' of )?(.*)$"
    x = lambda i: F.regexp_extract(c, rx, i)
    return F.when(c.rlike(rx), F.struct(x(1).alias("oid"), (x(2) == "").alias("merge"), x(3).alias("kind"), x(4).alias("name"), x(5).alias("remote")))


def merge_heads(text: Column) -> Column:
    """array<string>: the ids that a MERGE_HEAD file lists, a line each; other lines are left out."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"\A[0-9a-f]{40}\z"))


def q_fetch_head(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "p2tips").where("commit_sha IS NOT NULL")
    line = F.concat(F.lower("commit_sha"), F.when(F.col("tip_id") % 2 == 0, "\t\t").otherwise("\tnot-for-merge\t"), F.when(F.col("tip_id") % 3 == 0, "branch 'main' of ").when(F.col("tip_id") % 3 == 1, "tag 'v1' of ").otherwise(""), F.lit("https://hub.example/x"))
    return t.select("tip_id", fetch_heads(line).alias("x"), F.array_join(merge_heads(F.concat(F.lower("commit_sha"), F.lit("\nno id\n"))), ",").alias("merging")).where("x IS NOT NULL").select("tip_id", "x.*", "merging")


def q_mail(s: SparkSession, d: str) -> DataFrame:
    """doc_id, mail: each commit message among the documents as a numbered mail of its project."""
    t = table(s, d, "documents").where("text IS NOT NULL AND source = 'commit_msg'")
    return t.select("doc_id", F.md5(mail_text(F.lit("A U Thor"), F.lit("a@hub.example"), F.coalesce("project", F.lit("none")), F.col("text"), F.col("doc_id"), F.lit(9999))).alias("mail"))


QUERIES = {"list_text_source": q_olist_text, "reflog_text_source": q_reflog_text, "config_source": q_config, "patch_source": q_patch, "config_include": q_config_include, "fetch_head_source": q_fetch_head, "mail_sink": q_mail}
SQL = {
    "list_text_source": "SELECT line_no, repo, type, sha, path FROM olist WHERE repo IS NOT NULL AND sha IS NOT NULL AND path IS NOT NULL AND NOT contains(repo || sha, ';')",
    "reflog_text_source": "SELECT tip_id, commit_sha AS new, 'tips@hub.example' AS mail, epoch(taken_at)::BIGINT AS epoch, -90 AS tz_min, 'update by push' AS message FROM p2tips WHERE commit_sha IS NOT NULL AND taken_at IS NOT NULL",
    "config_source": "WITH e AS (SELECT n_nationkey AS k, n_nationkey % 3 AS lv, 'core.name' AS name, n_name AS value, 0 AS pos FROM nation UNION ALL SELECT n_nationkey, n_nationkey % 3, 'core.bare', 'true', 1 FROM nation UNION ALL SELECT n_nationkey, n_nationkey % 3, 'remote.r' || n_regionkey::VARCHAR || '.url', 'https://hub.example/' || lower(n_name), 2 FROM nation), r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY lv DESC, pos DESC, k DESC) AS r FROM e) SELECT name, value FROM r WHERE r = 1",
    "patch_source": "WITH n AS (SELECT least(3, len(string_split(text, chr(10)))) AS n FROM documents WHERE text IS NOT NULL) SELECT '+' AS origin, count(*) AS n FROM n UNION ALL SELECT ' ', sum(n)::BIGINT FROM n",
    "config_include": "SELECT lpad(n_nationkey::VARCHAR, 3, '0') AS origin, x.name, x.value FROM nation JOIN region ON r_regionkey = n_regionkey, LATERAL (VALUES ('core.editor', 'region'), ('core.pager', lower(r_name)), ('core.name', n_name)) x(name, value)",
    "fetch_head_source": "SELECT tip_id, lower(commit_sha) AS oid, tip_id % 2 = 0 AS merge, CASE tip_id % 3 WHEN 0 THEN 'branch' WHEN 1 THEN 'tag' ELSE '' END AS kind, CASE tip_id % 3 WHEN 0 THEN 'main' WHEN 1 THEN 'v1' ELSE '' END AS name, 'https://hub.example/x' AS remote, lower(commit_sha) AS merging FROM p2tips WHERE regexp_full_match(lower(commit_sha), '[0-9a-f]{40}')",
    "mail_sink": "SELECT doc_id, md5('From: A U Thor <a@hub.example>' || chr(10) || 'Subject: [PATCH ' || doc_id::VARCHAR || '/9999] ' || coalesce(project, 'none') || chr(10) || chr(10) || text || chr(10) || '---' || chr(10)) AS mail FROM documents WHERE text IS NOT NULL AND source = 'commit_msg'",
}

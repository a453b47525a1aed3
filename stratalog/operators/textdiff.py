"""Line-level operators: similarity signatures, inexact renames, hunks, blame. These have no SQL counterpart."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.plans.lineage import written
from stratalog.plans.spread import spread
from stratalog.sources.tables import table

#: Start of a line's hash, its factor, the longest run of a line, hashes kept at either end.
START, FACTOR, RUN, KEEP = 0x012345678ABCDEF0, 31, 80, 127


def line_hashes(text: str) -> list[int]:
    """Hashes of the runs of a text: lines, cut after RUN bytes, blanks left out; 32 bits each."""
    out = []
    h, n = START, 0
    for b in text.encode("utf-8", "surrogatepass"):
        if b in b" \t\r":
            continue
        if b == 10 or b == 0:
            if n:
                out.append(h & 0xFFFFFFFF)
            h, n = START, 0
            continue
        h = (h * FACTOR + b) & 0xFFFFFFFFFFFFFFFF
        n += 1
        if n == RUN:
            out.append(h & 0xFFFFFFFF)
            h, n = START, 0
    if n:
        out.append(h & 0xFFFFFFFF)
    return out


def signature(text: str) -> tuple[list[int], list[int]]:
    """The smallest and the largest KEEP line hashes, as sorted lists with repeats."""
    h = sorted(line_hashes(text))
    return h[:KEEP], h[-KEEP:]


def overlap(a: list[int], b: list[int]) -> int:
    """100 times twice the common elements (with repeats) over all elements."""
    if not a and not b:
        return 0
    return 200 * sum((Counter(a) & Counter(b)).values()) // (len(a) + len(b))


def score(a: tuple[list[int], list[int]], b: tuple[list[int], list[int]]) -> int:
    """Similarity of two signatures from 0 to 100; texts without lines have none. Full lists on both ends are averaged."""
    low = overlap(a[0], b[0])
    if len(a[0]) < KEEP or len(b[0]) < KEEP:
        return low
    return (low + overlap(a[1], b[1])) // 2


def signatures(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, low, high, size: signature of each text; null texts are left out."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, *signature(t), len(t.encode("utf-8", "surrogatepass"))) for k, t in zip(pdf.k, pdf.t)]
            yield pd.DataFrame(rows, columns=["k", "low", "high", "size"])

    cols = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t IS NOT NULL")
    return spread(cols, "k").mapInPandas(work, "k long, low array<long>, high array<long>, size long")


def inexact_renames(gone: DataFrame, came: DataFrame, threshold: int = 50) -> DataFrame:
    """group, old_key, new_key, similarity of deleted and added texts (group, key, text) that are at least `threshold` alike.

    Candidates share the group, a line hash kept in both signatures, and sizes within a factor of eight; pairs without a
    common hash score 0, so none is lost. Each side is used once, best scores first; ties by old, then new key.
    """
    a = signatures(gone.select("key", "text"), "key", "text").join(gone.select("group", F.col("key").alias("k")), "k")
    b = signatures(came.select("key", "text"), "key", "text").join(came.select("group", F.col("key").alias("k")), "k")
    a, b = written(a, "gone"), written(b, "came")
    ha = a.select("group", F.col("k").alias("old_key"), F.col("size").alias("sa"), F.explode(F.array_distinct(F.concat("low", "high"))).alias("h"))
    hb = b.select("group", F.col("k").alias("new_key"), F.col("size").alias("sb"), F.explode(F.array_distinct(F.concat("low", "high"))).alias("h"))
    cand = ha.join(hb, ["group", "h"]).where("sa <= 8 * sb AND sb <= 8 * sa").select("group", "old_key", "new_key").distinct()
    full = cand.join(a.select("group", F.col("k").alias("old_key"), F.struct("low", "high").alias("x")), ["group", "old_key"]).join(b.select("group", F.col("k").alias("new_key"), F.struct("low", "high").alias("y")), ["group", "new_key"])

    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            s = [score((list(x["low"]), list(x["high"])), (list(y["low"]), list(y["high"]))) for x, y in zip(pdf.x, pdf.y)]
            yield pdf[["group", "old_key", "new_key"]].assign(similarity=s)

    pairs = written(full.select("group", "old_key", "new_key", "x", "y").mapInPandas(rate, "group long, old_key long, new_key long, similarity int").where(F.col("similarity") >= threshold), "pairs")
    # Greedy matching by rounds: a pair that is the best of both its sides is taken, then its sides are gone.
    taken = []
    while not pairs.isEmpty():
        best = F.struct("similarity", -F.col("old_key"), -F.col("new_key"))
        o = pairs.groupBy("group", "old_key").agg(F.max_by("new_key", best).alias("bn"))
        n = pairs.groupBy("group", "new_key").agg(F.max_by("old_key", best).alias("bo"))
        win = written(pairs.join(o, ["group", "old_key"]).join(n, ["group", "new_key"]).where("new_key = bn AND old_key = bo").select("group", "old_key", "new_key", "similarity"), "won")
        taken.append(win)
        pairs = written(pairs.join(win.select("group", "old_key"), ["group", "old_key"], "left_anti").join(win.select("group", "new_key"), ["group", "new_key"], "left_anti"), "pairs")
    out = taken[0] if taken else pairs
    for t in taken[1:]:
        out = out.unionByName(t)
    return out


def hunks(old: str | None, new: str | None, context: int = 3) -> list[tuple[int, int, int, int, int, int]]:
    """(old start, old lines, new start, new lines, deleted, added) of each hunk; starts count from 1, from 0 if empty."""
    a, b = (old or "").split("\n") if old else [], (new or "").split("\n") if new else []
    out = []
    for group in SequenceMatcher(None, a, b, autojunk=False).get_grouped_opcodes(context):
        i1, i2, j1, j2 = group[0][1], group[-1][2], group[0][3], group[-1][4]
        gone = sum(o[2] - o[1] for o in group if o[0] in ("replace", "delete"))
        come = sum(o[4] - o[3] for o in group if o[0] in ("replace", "insert"))
        out.append((i1 + (i2 > i1), i2 - i1, j1 + (j2 > j1), j2 - j1, gone, come))
    return out


def text_hunks(df: DataFrame) -> DataFrame:
    """id, hunk and the fields of `hunks` for rows with id, old, new."""
    names = ["id", "hunk", "old_start", "old_lines", "new_start", "new_lines", "deleted", "added"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(i, k, *h) for i, o, n in zip(pdf.id, pdf.old, pdf.new) for k, h in enumerate(hunks(o, n))], columns=names)

    return spread(df.select("id", "old", "new"), "id").mapInPandas(work, ", ".join(f"{n} long" for n in names))


def blame_lines(versions: list[tuple[int, str]]) -> list[tuple[int, int]]:
    """(line, version) for each line of the last of several (version, text): the version that brought the line in."""
    owner: list[int] = []
    before: list[str] = []
    for version, text in versions:
        now = (text or "").split("\n")
        new = [version] * len(now)
        if now == before:  # the whole text passes the blame on
            new = owner
        else:
            for i, j, n in SequenceMatcher(None, before, now, autojunk=False).get_matching_blocks():
                new[j : j + n] = owner[i : i + n]
        owner, before = new, now
    return [(k + 1, v) for k, v in enumerate(owner)]


def blame(history: DataFrame) -> DataFrame:
    """path, final_start, lines, version: hunks of equal origin in each path's last version.

    history: path, version, text; a path's versions follow each other in order. One task holds one path's versions.
    """

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("version")
        rows: list[list[int]] = []
        for line, v in blame_lines(list(zip(pdf.version, pdf.text))):
            if rows and rows[-1][2] == v:
                rows[-1][1] += 1
            else:
                rows.append([line, 1, v])
        return pd.DataFrame([(pdf.path.iloc[0], *r) for r in rows], columns=["path", "final_start", "lines", "version"])

    return history.select("path", "version", "text").groupBy("path").applyInPandas(work, "path long, final_start long, lines long, version long")


def binary_content(body: Column) -> Column:
    """Do these bytes look binary? A mark of UTF-16 or UTF-32 at the front, a NUL among the first 8,000 bytes, or more
    control characters there than printable ones by 128. Backspace, escape and form feed count as printable."""
    head = F.decode(F.substring(body, 1, 8000), "iso-8859-1")
    head = F.regexp_replace(head, r"\A\xEF\xBB\xBF", "")
    control = F.length(head) - F.length(F.regexp_replace(head, r"[\x01-\x07\x0E-\x1A\x1C-\x1F\x7F]", ""))
    printable = F.length(F.regexp_replace(head, r"[\x00-\x07\x09-\x0B\x0D-\x1A\x1C-\x1F\x7F]", ""))
    marked = F.hex(F.substring(body, 1, 4)).rlike(r"\A(?:FEFF|FFFE|0000FEFF)")
    return marked | head.contains("\u0000") | (F.floor(printable / 128) < control)


# ------------------------------------------------------------------------------------------------------------- queries


def _edited(s: SparkSession, d: str) -> DataFrame:
    """doc_id, text and an edit of it: its second line is dropped and a line added at the end."""
    t = table(s, d, "documents").where("text IS NOT NULL").select(F.col("doc_id").alias("id"), "text")
    lines = F.split("text", "\n")
    new = F.array_join(F.concat(F.slice(lines, 1, 1), F.when(F.size(lines) > 2, F.slice(lines, 3, F.size(lines))).otherwise(F.array().cast("array<string>")), F.array(F.lit("-- new"))), "\n")
    return t.select("id", F.col("text").alias("old"), new.alias("new"))


def q_hashsig(s: SparkSession, d: str) -> DataFrame:
    x = signatures(table(s, d, "documents"), "doc_id", "text")
    return x.select(F.col("k").alias("doc_id"), F.size("low").alias("n_low"), F.try_element_at("low", F.lit(1)).alias("least"), F.try_element_at("high", F.lit(-1)).alias("most"))


def q_renames(s: SparkSession, d: str) -> DataFrame:
    """Documents of each source as deleted files against their edits as added ones."""
    e = _edited(s, d).join(table(s, d, "documents").select(F.col("doc_id").alias("id"), F.pmod(F.xxhash64("source", "project"), F.lit(1 << 20)).alias("group")), "id")
    return inexact_renames(e.select("group", F.col("id").alias("key"), F.col("old").alias("text")), e.select("group", F.col("id").alias("key"), F.col("new").alias("text")))


def q_hunks(s: SparkSession, d: str) -> DataFrame:
    return text_hunks(_edited(s, d))


def q_blame(s: SparkSession, d: str) -> DataFrame:
    e = _edited(s, d)
    first = e.select(F.col("id").alias("path"), F.lit(1).cast("long").alias("version"), F.col("old").alias("text"))
    return blame(first.unionByName(e.select(F.col("id").alias("path"), F.lit(2).cast("long").alias("version"), F.col("new").alias("text"))))


def q_binary(s: SparkSession, d: str) -> DataFrame:
    """Documents as they are, with a NUL in front, behind two control characters, or as UTF-16."""
    way = F.col("doc_id") % 4
    t = table(s, d, "documents").where("text IS NOT NULL")
    front = F.when(way == 1, F.lit("\u0000")).when(way == 2, F.lit("\u0007\u0001")).otherwise("")
    body = F.when(way == 3, F.encode("text", "utf-16")).otherwise(F.encode(F.concat(front, "text"), "utf-8"))
    return t.select("doc_id", binary_content(body).alias("binary"))


QUERIES = {"hash_signature": q_hashsig, "rename_inexact": q_renames, "diff_hunks": q_hunks, "blame": q_blame, "binary_detection": q_binary}
_LINES = "(SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)"
SQL = {
    "blame": f"SELECT doc_id AS path, 1::BIGINT AS final_start, greatest(len(l) - 1, 1) AS lines, 1::BIGINT AS version FROM {_LINES} UNION ALL SELECT doc_id, greatest(len(l) - 1, 1) + 1, 1, 2 FROM {_LINES}",
    "binary_detection": r"WITH t AS (SELECT doc_id, doc_id % 4 AS way, octet_length(encode(regexp_replace(text, '[\x00-\x07\x09-\x0B\x0D-\x1A\x1C-\x1F\x7F]', '', 'g'))) AS printable, length(text) - length(regexp_replace(text, '[\x01-\x07\x0E-\x1A\x1C-\x1F\x7F]', '', 'g')) AS control FROM documents WHERE text IS NOT NULL) SELECT doc_id, CASE way WHEN 1 THEN true WHEN 3 THEN true WHEN 2 THEN least(printable, 7998) // 128 < control + 2 ELSE least(printable, 8000) // 128 < control END AS binary FROM t",
    "diff_hunks": f"WITH t AS (SELECT doc_id AS id, len(l)::BIGINT AS n FROM {_LINES}) SELECT id, x.* FROM t, LATERAL (SELECT 0::BIGINT AS hunk, 1::BIGINT AS old_start, CASE WHEN n > 8 THEN 5 ELSE n END AS old_lines, 1::BIGINT AS new_start, CASE WHEN n > 8 THEN 4 WHEN n = 1 THEN 2 ELSE n END AS new_lines, CASE WHEN n > 1 THEN 1 ELSE 0 END::BIGINT AS deleted, CASE WHEN n > 8 THEN 0 ELSE 1 END::BIGINT AS added) x UNION ALL SELECT id, 1, n - 2, 3, n - 3, 4, 0, 1 FROM t WHERE n > 8",
}

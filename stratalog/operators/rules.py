"""Ordered pattern rules on paths: globs, pathspecs, ignore and attribute files, mail maps."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.sources.tables import table

_CLASSES = {"alnum": "a-zA-Z0-9", "alpha": "a-zA-Z", "digit": "0-9", "lower": "a-z", "upper": "A-Z", "space": r"\s", "blank": r" \t", "punct": r"!-/:-@\[-`{-~", "xdigit": "0-9A-Fa-f", "cntrl": r"\x00-\x1f\x7f", "print": r"\x20-\x7e", "graph": r"\x21-\x7e"}


def glob_regex(pattern: str, pathname: bool = True, casefold: bool = False) -> str:
    """A regular expression for a glob. With `pathname`, `*` and `?` stay within a part of a path and `**` crosses parts.

    `**/` at the front matches any number of folders, `/**` at the end all below, `/**/` none or more folders between.
    """
    out, i, n = [], 0, len(pattern)
    while i < n:
        c = pattern[i]
        if c == "*":
            j = i
            while j < n and pattern[j] == "*":
                j += 1
            front, back = i == 0 or pattern[i - 1] == "/", j == n or pattern[j] == "/"
            if not pathname:
                out.append(".*")
            elif j - i > 1 and front and back:
                if j == n:
                    out.append(".*")
                else:
                    out.append("(?:.*/)?")
                    j += 1
            else:
                out.append("[^/]*")
            i = j
            continue
        if c == "?":
            out.append("[^/]" if pathname else ".")
        elif c == "[":
            j = i + 1
            if j < n and pattern[j] in "!^":
                j += 1
            if j < n and pattern[j] == "]":
                j += 1
            while j < n and pattern[j] != "]":
                if pattern.startswith("[:", j):
                    j = pattern.find(":]", j) + 1 if pattern.find(":]", j) > 0 else n
                j += 1
            if j >= n:
                return r"(?!)"  # an open bracket matches nothing
            body = pattern[i + 1 : j]
            neg = body[:1] in "!^"
            body = re.sub(r"\[:(\w+):\]", lambda m: _CLASSES.get(m[1], ""), body[1:] if neg else body).replace("[", r"\[").replace("&&", r"\&\&")
            out.append(f"[{'^' if neg else ''}{'/' if neg and pathname else ''}{body}]")
            i = j
        elif c == "\\" and i + 1 < n:
            i += 1
            out.append(re.escape(pattern[i]))
        else:
            out.append(re.escape(c))
        i += 1
    return ("(?is)" if casefold else "(?s)") + r"\A" + "".join(out) + r"\z"


def pathspec(path: Column, specs: list[str], icase: bool = False, noglob: bool = False) -> Column:
    """Does the path match a pathspec list? The first spec that matches decides: one with `!` says no, another one yes.

    A spec also matches everything below it. No spec at all matches every path; if none of several matches, the path
    doesn't. noglob: specs are plain text.
    """
    if not specs:
        return F.lit(True)
    out = F.lit(False)
    for s in reversed(specs):
        spec = s.removeprefix("!").rstrip("/")
        rx = ("(?is)" if icase else "(?s)") + r"\A" + re.escape(spec) + r"\z" if noglob else glob_regex(spec, pathname=False, casefold=icase)
        out = F.when(path.rlike(rx) | path.rlike(rx[:-2] + r"/.*\z"), F.lit(not s.startswith("!"))).otherwise(out)
    return out


def rule_regex(pattern: str) -> tuple[str, bool]:
    """(regex on paths, only folders?) of an ignore or attribute pattern without its `!`.

    A pattern with a slash before its end holds from the root, another one at any depth.
    """
    folder = pattern.endswith("/")
    p = pattern.rstrip("/")
    rooted = "/" in p
    rx = glob_regex(p.lstrip("/"))
    if not rooted:
        rx = rx.replace(r"\A", r"\A(?:.*/)?", 1)
    return rx, folder


def ignored(path: Column, rules: list[str]) -> Column:
    """Is a file ignored? Rules are read in order, the last match decides, `!` takes back; a file below an ignored folder
    stays ignored whatever later rules say. Empty rules and comments count for nothing. Null paths give null."""
    parsed = [(r.startswith("!"), *rule_regex(r.removeprefix("!"))) for r in rules if r.strip() and not r.startswith("#")]

    def verdict(p: Column, is_folder: bool) -> Column:
        out = F.lit(False)
        for neg, rx, folder in parsed:
            if folder and not is_folder:
                continue
            out = F.when(p.rlike(rx), F.lit(not neg)).otherwise(out)
        return out

    parts = F.split(path, "/")
    parents = F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).otherwise(F.array().cast("array<string>"))
    return F.when(path.isNotNull(), F.exists(parents, lambda p: verdict(p, True)) | verdict(path, False))


def attribute(path: Column, rules: list[tuple[str, str | None]]) -> Column:
    """The value of an attribute: rules (pattern, value) in order, the last match decides; none matches: null."""
    out = F.lit(None).cast("string")
    for pattern, value in rules:
        out = F.when(path.rlike(rule_regex(pattern)[0]), F.lit(value)).otherwise(out)
    return out


#: What the built-in macro stands for.
MACROS = {"binary": ["-diff", "-merge", "-text", "-crlf"]}


def attribute_rules(lines: list[str], name: str, macros: dict[str, list[str]] | None = None) -> list[tuple[str, str | None]]:
    """(pattern, value) for one attribute from attribute lines (`pattern a -b !c d=value`), in order, macros expanded.

    `a` gives true, `-a` false, `!a` null (unspecified again), `a=v` the value. `[attr]m …` defines macro m, which counts
    for the lines behind it; a macro that a line names sets its own attributes too.
    """
    known = {**MACROS, **(macros or {})}
    out: list[tuple[str, str | None]] = []
    for line in lines:
        words = line.split()
        if not words or words[0].startswith("#"):
            continue
        if words[0].startswith("[attr]"):
            known[words[0][6:]] = words[1:]
            continue
        todo, seen = list(words[1:]), 0
        while seen < len(todo):
            more = [x for x in known.get(todo[seen], []) if x not in todo[: seen + 1]]
            todo[seen + 1 : seen + 1] = more
            seen += 1
        for w in todo:
            key, eq, value = w.lstrip("-!").partition("=")
            if key == name:
                out.append((words[0], value if eq else None if w.startswith("!") else "false" if w.startswith("-") else "true"))
    return out


def ignore_lines(text: str, folder: str = "") -> list[str]:
    """The rules of an ignore file of `folder` as rules from the root: comments and empty lines dropped, trailing blanks
    too unless escaped, an escaped `!` or `#` read as a plain first character, patterns held below the folder."""
    out = []
    for line in text.split("\n"):
        line = re.sub(r"(?<!\\)[ \t]+$", "", line.rstrip("\r"))
        if not line or line.startswith("#"):
            continue
        neg, p = line.startswith("!"), line.removeprefix("!")
        if folder:
            base = re.sub(r"([*?\[\\])", r"\\\1", folder.strip("/"))
            p = f"/{base}/{p.lstrip('/')}" if "/" in p.rstrip("/") else f"/{base}/**/{p}"
        out.append(("!" if neg else "") + p)
    return out


def mailmap(people: DataFrame, entries: DataFrame) -> DataFrame:
    """people (name, email, …) with real_name and real_email.

    entries: real_name, real_email, replace_name, replace_email. An entry with name and address goes before one with the
    address alone; letter case does not count; without an entry, name and address stay. Addresses that entries name twice
    take the smallest real name.
    """
    e = entries.select(F.lower("replace_name").alias("_n"), F.lower("replace_email").alias("_e"), "real_name", "real_email")
    exact = e.where("_n IS NOT NULL").groupBy("_n", "_e").agg(F.min(F.struct("real_name", "real_email")).alias("_x"))
    byadr = e.where("_n IS NULL").groupBy("_e").agg(F.min(F.struct("real_name", "real_email")).alias("_y"))
    p = people.withColumn("_pn", F.lower("name")).withColumn("_pe", F.lower("email"))
    j = p.join(exact, (F.col("_pn") == exact["_n"]) & (F.col("_pe") == exact["_e"]), "left").drop("_n", "_e").join(byadr, F.col("_pe") == byadr["_e"], "left")
    return j.select(*people.columns, F.coalesce("_x.real_name", "_y.real_name", "name").alias("real_name"), F.coalesce("_x.real_email", "_y.real_email", "email").alias("real_email"))


# ------------------------------------------------------------------------------------------------------------- queries


def _paths(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "olist").where("path IS NOT NULL").select("line_no", "path")


def q_pathspec(s: SparkSession, d: str) -> DataFrame:
    return _paths(s, d).where(pathspec(F.col("path"), ["lib/*.c", "!docs/*.md", "docs", "!lib/*"])).select("line_no")


def pathspec_failures(s: SparkSession, d: str) -> DataFrame:
    """pattern: specs that match no path at all."""
    specs = ["lib/*.c", "docs", "nowhere/*", "*.rs", "no.such"]
    p = _paths(s, d)
    hits = p.agg(*[F.coalesce(F.max(pathspec(F.col("path"), [x]).cast("int")), F.lit(0)).alias(f"h{i}") for i, x in enumerate(specs)])
    return hits.select(F.explode(F.array(*[F.struct(F.lit(x).alias("pattern"), F.col(f"h{i}").alias("hit")) for i, x in enumerate(specs)])).alias("x")).where("x.hit = 0").select("x.pattern")


def q_glob(s: SparkSession, d: str) -> DataFrame:
    p = F.col("path")
    return _paths(s, d).select("line_no", p.rlike(glob_regex("src/**/*.[ch]")).alias("a"), p.rlike(glob_regex("**/d*/*")).alias("b"), p.rlike(glob_regex("*.MD", pathname=False, casefold=True)).alias("c"))


def q_ignore(s: SparkSession, d: str) -> DataFrame:
    return _paths(s, d).where(ignored(F.col("path"), ["# comment", "*.json", "!lib/*.json", "docs/", "/cmd/*.c"])).select("line_no")


def q_attributes(s: SparkSession, d: str) -> DataFrame:
    return _paths(s, d).select("line_no", attribute(F.col("path"), [("*", "auto"), ("*.md", "text"), ("*.rs", "lf"), ("src/*.rs", "crlf")]).alias("eol"))


def q_attribute_macros(s: SparkSession, d: str) -> DataFrame:
    lines = ["[attr]code lang=c indent -binary", "* text", "*.png binary", "*.c code", "docs/* !text", "*.md text=auto"]
    p = F.col("path")
    return _paths(s, d).select("line_no", *[attribute(p, attribute_rules(lines, a)).alias(a) for a in ("text", "lang", "diff")])


def q_ignore_folders(s: SparkSession, d: str) -> DataFrame:
    """Ignore files of the root, of `src` and of `docs`, the deeper ones read later."""
    rules = ignore_lines("*.json\n\\!odd\n") + ignore_lines("*.c\n!/main.c \n", "src") + ignore_lines("*\n!*.md\n", "docs")
    return _paths(s, d).where(ignored(F.col("path"), rules)).select("line_no")


def q_mailmap(s: SparkSession, d: str) -> DataFrame:
    """Authors under the most common name of their address; a second set of entries renames by name and address."""
    a = table(s, d, "authors").where("simpemail IS NOT NULL AND getfl IS NOT NULL").select("author_id", F.col("getfl").alias("name"), F.col("simpemail").alias("email"))
    n = a.groupBy(F.lower("email").alias("replace_email"), "name").agg(F.count("*").alias("n"))
    common = n.groupBy("replace_email").agg(F.min(F.struct((-F.col("n")).alias("k"), F.col("name"))).alias("x")).select(F.col("x.name").alias("real_name"), F.lit(None).cast("string").alias("real_email"), F.lit(None).cast("string").alias("replace_name"), "replace_email")
    root = a.where("lower(name) = 'root'").select(F.lit("Administrator").alias("real_name"), F.lit("admin@hub.example").alias("real_email"), F.col("name").alias("replace_name"), F.col("email").alias("replace_email"))
    return mailmap(a, common.unionByName(root)).select("author_id", "real_name", "real_email")


QUERIES = {"pathspec": q_pathspec, "pathspec_failures": pathspec_failures, "glob_match": q_glob, "ignore_rules": q_ignore, "attribute_lookup": q_attributes, "mailmap": q_mailmap, "attribute_macros": q_attribute_macros, "ignore_folders": q_ignore_folders}

_P = "FROM olist WHERE path IS NOT NULL"
SQL = {
    "pathspec": f"SELECT line_no {_P} AND CASE WHEN regexp_full_match(path, 'lib/.*[.]c(/.*)?') THEN true WHEN regexp_full_match(path, 'docs/.*[.]md(/.*)?') THEN false ELSE path = 'docs' OR starts_with(path, 'docs/') END",
    "pathspec_failures": f"WITH h(pattern, hit) AS (VALUES ('lib/*.c', (SELECT count(*) {_P} AND regexp_full_match(path, 'lib/.*[.]c(/.*)?'))), ('docs', (SELECT count(*) {_P} AND (path = 'docs' OR starts_with(path, 'docs/')))), ('nowhere/*', (SELECT count(*) {_P} AND starts_with(path, 'nowhere/'))), ('*.rs', (SELECT count(*) {_P} AND regexp_full_match(path, '.*[.]rs(/.*)?'))), ('no.such', (SELECT count(*) {_P} AND (path = 'no.such' OR starts_with(path, 'no.such/'))))) SELECT pattern FROM h WHERE hit = 0",
    "glob_match": f"SELECT line_no, regexp_full_match(path, 'src/(.*/)?[^/]*[.][ch]') AS a, regexp_full_match(path, '(.*/)?d[^/]*/[^/]*') AS b, ends_with(lower(path), '.md') AS c {_P}",
    "ignore_rules": f"SELECT line_no {_P} AND (regexp_matches(path, '(^|/)docs/') OR regexp_full_match(path, 'cmd/[^/]*[.]c') OR (ends_with(path, '.json') AND NOT regexp_full_match(path, 'lib/[^/]*[.]json')) OR regexp_matches(path, '[.]json/'))",
    "attribute_lookup": f"SELECT line_no, CASE WHEN regexp_full_match(path, 'src/[^/]*[.]rs') THEN 'crlf' WHEN ends_with(path, '.rs') THEN 'lf' WHEN ends_with(path, '.md') THEN 'text' ELSE 'auto' END AS eol {_P}",
    "mailmap": "WITH a AS (SELECT author_id, getfl AS name, simpemail AS email FROM authors WHERE simpemail IS NOT NULL AND getfl IS NOT NULL), n AS (SELECT lower(email) AS e, name, count(*) AS n FROM a GROUP BY ALL), c AS (SELECT e, name FROM (SELECT *, row_number() OVER (PARTITION BY e ORDER BY n DESC, name) AS k FROM n) WHERE k = 1) SELECT author_id, CASE WHEN lower(a.name) = 'root' THEN 'Administrator' ELSE c.name END AS real_name, CASE WHEN lower(a.name) = 'root' THEN 'admin@hub.example' ELSE a.email END AS real_email FROM a JOIN c ON c.e = lower(a.email)",
    "attribute_macros": f"SELECT line_no, CASE WHEN ends_with(path, '.md') THEN 'auto' WHEN regexp_full_match(path, 'docs/[^/]*') THEN NULL WHEN ends_with(path, '.png') THEN 'false' ELSE 'true' END AS text, CASE WHEN ends_with(path, '.c') THEN 'c' END AS lang, CASE WHEN ends_with(path, '.png') THEN 'false' END AS diff {_P}",
    "ignore_folders": f"SELECT line_no {_P} AND CASE WHEN starts_with(path, 'docs/') THEN NOT ends_with(path, '.md') OR contains(substr(path, 6), '/') WHEN path = 'src/main.c' THEN false WHEN starts_with(path, 'src/') AND (ends_with(path, '.c') OR regexp_matches(path, '[.]c/')) THEN true WHEN path = '!odd' THEN true ELSE ends_with(path, '.json') OR regexp_matches(path, '[.]json/') END",
}

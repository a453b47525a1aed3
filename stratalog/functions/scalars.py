"""Scalar functions on names, paths, messages and settings, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.plans.model import section
from stratalog.sources.tables import table

#: Fixed value: the home forge, whose host project names leave out.
HOME = "hub.example"


def url_to_project(url: Column, short: dict[str, str] | None = None) -> Column:
    """Project name of an address: scheme, user, end slashes and `.git` dropped, first two slashes as `_`, lower case,
    home host dropped. Null gives null. short: forge codes, `code:owner/repo`, and the hosts that they stand for."""
    v = url
    for code, host in (short or {}).items():
        v = F.regexp_replace(v, rf"(?s)\A{code}:(?!/)", f"{host}/")
    v = F.regexp_replace(v, r"(?i)^[a-z][a-z0-9+.-]*://", "")
    v = F.regexp_replace(v, r"^git@([^:]+):", "$1/")
    v = F.regexp_replace(F.regexp_replace(v, r"/+\z", ""), r"\.git\z", "")
    v = F.regexp_replace(F.regexp_replace(v, r"\A([^/]*)/", "$1_"), r"\A([^/]*)/", "$1_")
    return F.regexp_replace(F.lower(v), "^" + HOME.replace(".", r"\.") + "_", "")


#: The same for DuckDB.
PROJECT_SQL = r"regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '^[a-zA-Z][a-zA-Z0-9+.-]*://', ''), '^git@([^:]+):', '\1/'), '/+\z', ''), '\.git\z', ''), '/', '_'), '/', '_')), '^hub\.example_', '')"


def project_to_url(project: Column, rewrites: dict[str, str] | None = None) -> Column:
    """The address of a project name: a dotted first part is the host, else the home forge; the next `_` is a slash.
    rewrites: hosts that are cloned from another host than names say."""
    hosted = project.rlike(r"^[^_]*\.[^_]+_")
    host = F.when(hosted, F.regexp_extract(project, r"^([^_]*\.[^_]+)_", 1)).otherwise(HOME)
    for name, real in (rewrites or {}).items():
        host = F.when(host == name, real).otherwise(host)
    rest = F.when(hosted, F.regexp_replace(project, r"^[^_]*\.[^_]+_", "")).otherwise(project)
    return F.concat(F.lit("https://"), host, F.lit("/"), F.regexp_replace(rest, r"(?s)^([^_]*)_(.*)\z", "$1/$2"))


def clean_text(c: Column) -> Column:
    """Separators and line ends replaced so that the text fits a `;`-separated line."""
    return F.translate(c, ";\r\n", ":__")


def excerpt(c: Column) -> Column:
    """The first 1,000 characters with runs of blanks collapsed, at most 300 characters of them."""
    return F.substring(F.regexp_replace(F.translate(F.substring(c, 1, 1000), "\n\r\t;", "    "), " +", " "), 1, 300)


def summary(message: Column) -> Column:
    """The first paragraph of a message in one line, blanks trimmed."""
    first = F.regexp_extract(message, r"(?s)\A[ \n\t]*(.*?)(?:\n[ \t]*\n|\z)", 1)
    return F.trim(F.regexp_replace(first, r"[ \t]*\n[ \t]*", " "))


def prettify(message: Column, comments: bool = True) -> Column:
    """Trailing blanks of lines dropped, runs of empty lines made one, none at the ends, a line end after each line;
    with `comments`, lines that begin with # are dropped. A message without content becomes empty."""
    v = F.regexp_replace(message, r"(?md)^#.*\n?", "") if comments else message
    v = F.regexp_replace(v, r"[ \t\r\f\x0B]+(?=\n|\z)", "")
    v = F.regexp_replace(F.regexp_replace(v, r"\n{3,}", "\n\n"), r"\A\n+|\n+\z", "")
    return F.when(v == "", v).otherwise(F.concat(v, F.lit("\n")))


def trailers(message: Column) -> Column:
    """array<struct<key, value>> of the `Key: value` lines of a message's last paragraph; empty if it holds other lines."""
    last = F.element_at(F.split(F.regexp_replace(message, r"\s+\z", ""), r"\n[ \t]*\n"), -1)
    lines = F.split(last, "\n")
    ok = F.forall(lines, lambda x: x.rlike(r"^[A-Za-z0-9][A-Za-z0-9-]*[ \t]*: *\S"))
    pairs = F.transform(lines, lambda x: F.struct(F.regexp_extract(x, r"^([A-Za-z0-9-]+)", 1).alias("key"), F.trim(F.regexp_extract(x, r"^[^:]*:(.*)\z", 1)).alias("value")))
    return F.when(ok & message.rlike(r"\n[ \t]*\n"), pairs).otherwise(F.array().cast("array<struct<key:string,value:string>>"))


def email_domain(mail: Column) -> Column:
    """Domain of an address in lower case, without what a noreply or local host puts before or behind it."""
    d = F.lower(F.regexp_extract(mail, r"@([^@>\s]+)", 1))
    d = F.regexp_replace(d, r"^[^.]*\.noreply\.", "")
    d = F.regexp_replace(d, r"/.*", "")
    return F.regexp_replace(d, r"\.(?:local|localdomain)\z", "")


def signature_name(c: Column) -> Column:
    """Name of a `Name <mail>` signature, without the characters that may not surround it."""
    return F.regexp_replace(F.regexp_replace(F.regexp_extract(c, r"(?s)^([^<]*)", 1), r"^[\s.,:;<>\"\\']+", ""), r"[\s.,:;<>\"\\']+\z", "")


def signature_mail(c: Column) -> Column:
    """Address of a `Name <mail>` signature: what stands between the last `<` and the `>` behind it; empty without."""
    return F.trim(F.regexp_extract(c, r"<([^<>]*)>[^<>]*\z", 1))


def ref_shorthand(c: Column) -> Column:
    """A reference's name without the folder of its kind."""
    return F.regexp_replace(c, r"^refs/(?:heads/|tags/|remotes/)?", "")


def ref_valid(c: Column) -> Column:
    """Is this a well-formed reference name? No empty or dotted parts, no `..`, `@{`, control or wildcard characters."""
    bad = r"(?:\A|/)\.|\.\.|@\{|[\x00-\x20\x7f~^:?*\[\\]|//|/\z|\A/|\.lock(?:/|\z)|\.\z|\A@\z|\A\z"
    return ~c.rlike(bad)


def config_int(c: Column) -> Column:
    """A whole number with an optional factor k, m or g; null if it is none."""
    n = F.regexp_extract(F.lower(F.trim(c)), r"^([+-]?\d+)([kmg]?)\z", 1)
    u = F.regexp_extract(F.lower(F.trim(c)), r"^([+-]?\d+)([kmg]?)\z", 2)
    return F.when(n != "", n.cast("long") * F.when(u == "k", 1 << 10).when(u == "m", 1 << 20).when(u == "g", 1 << 30).otherwise(1).cast("long"))


def config_bool(c: Column) -> Column:
    """true, yes, on and non-zero numbers are true; false, no, off, empty and zero false; else null."""
    v = F.lower(F.trim(c))
    return F.when(v.isin("true", "yes", "on"), True).when(v.isin("false", "no", "off", ""), False).when(config_int(c).isNotNull(), config_int(c) != 0)


def dirname(c: Column) -> Column:
    v = F.regexp_replace(c, r"/+\z", "")
    return F.when(v.contains("/"), F.when(F.regexp_replace(v, r"/+[^/]*\z", "") == "", "/").otherwise(F.regexp_replace(v, r"/+[^/]*\z", ""))).otherwise(".")


def basename(c: Column) -> Column:
    return F.substring_index(F.regexp_replace(c, r"/+\z", ""), "/", -1)


def to_lf(c: Column) -> Column:
    """Line ends as stored: CRLF becomes LF; texts with a NUL are binary and stay."""
    return F.when(c.contains("\u0000"), c).otherwise(F.regexp_replace(c, "\r\n", "\n"))


def to_crlf(c: Column) -> Column:
    """Line ends as checked out: lone LF becomes CRLF."""
    return F.when(c.contains("\u0000"), c).otherwise(F.regexp_replace(c, "(?<!\r)\n", "\r\n"))


def refspec_target(name: Column, spec: str) -> Column:
    """Where a refspec `[+]src:dst` (each with at most one `*`) maps a reference name; null if it doesn't match."""
    import re

    src, _, dst = spec.lstrip("+").partition(":")
    if "*" not in src:
        return F.when(name == src, F.lit(dst))
    a, b = src.split("*")
    pattern = "^" + re.escape(a) + "(.*)" + re.escape(b) + r"\z"
    return F.when(name.rlike(pattern), F.regexp_replace(name, pattern, dst.replace("*", "$1")))


# ------------------------------------------------------------------------------------------------------------- queries


def q_url_to_project(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "urls").select("url_id", url_to_project(F.col("url")).alias("project"))


def q_project_to_url(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "p2cd").select("list_id", project_to_url(F.col("repo")).alias("url"))


def q_messages(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where("text IS NOT NULL").select("doc_id", summary(F.col("text")).alias("summary"), excerpt(F.col("text")).alias("excerpt"), clean_text(F.col("text")).alias("line"))


def q_prettify(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where("text IS NOT NULL").select("doc_id", prettify(F.col("text")).alias("pretty"), F.md5(to_crlf(F.col("text"))).alias("crlf"), F.md5(to_lf(to_crlf(F.col("text")))).alias("lf"))


def q_trailers(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", F.explode(trailers(F.col("text"))).alias("t")).select("doc_id", "t.key", "t.value")


def q_signatures(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "authors").select("author_id", signature_name(F.col("parseauthorid")).alias("name"), signature_mail(F.col("parseauthorid")).alias("mail"), email_domain(F.col("simpemail")).alias("domain"))


def q_paths(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "olist").where("path IS NOT NULL").select("line_no", dirname(F.col("path")).alias("dir"), basename(F.col("path")).alias("base"))


def q_sections(s: SparkSession, d: str) -> DataFrame:
    """Records whose section is not the one of their object id: 0 in a sound index."""
    return table(s, d, "store_idx").where(section(F.col("sha")) != F.col("sec")).agg(F.count("*").alias("wrong"))


def _refs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "p2cd").where("repo IS NOT NULL").select("list_id", F.concat(F.when(F.col("batch") % 3 == 0, "refs/heads/").when(F.col("batch") % 3 == 1, "refs/tags/").otherwise("refs/remotes/origin/"), "repo").alias("name"))


def q_refs(s: SparkSession, d: str) -> DataFrame:
    r = _refs(s, d)
    return r.select("list_id", ref_shorthand(F.col("name")).alias("short"), ref_valid(F.col("name")).alias("valid"), refspec_target(F.col("name"), "+refs/heads/*:refs/remotes/up/*").alias("target"))


def q_config(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "part").select("p_partkey", F.concat(F.col("p_size").cast("string"), F.element_at(F.array(F.lit(""), F.lit("k"), F.lit("M"), F.lit("g"), F.lit("x")), (F.col("p_partkey") % 5 + 1).cast("int"))).alias("v"))
    return x.select("p_partkey", config_int(F.col("v")).alias("n"), config_bool(F.element_at(F.array(F.lit("Yes"), F.lit("off"), F.lit("0"), F.lit("maybe"), F.lit("7")), (F.col("p_partkey") % 5 + 1).cast("int"))).alias("b"))


QUERIES = {
    "url_to_project": q_url_to_project, "project_to_url": q_project_to_url, "message_summary": q_messages, "message_prettify": q_prettify, "message_trailers": q_trailers, "signature_parse": q_signatures, "path_parts": q_paths, "section_check": q_sections,
    "reference_names": q_refs, "config_values": q_config,
}

_B = "regexp_replace(path, '/+$', '')"
SQL = {
    "url_to_project": "SELECT url_id, " + PROJECT_SQL.format("url") + " AS project FROM urls",
    "project_to_url": r"""WITH a AS (SELECT list_id, repo, regexp_matches(repo, '^[^_]*\.[^_]+_') AS h FROM p2cd), b AS (SELECT list_id, CASE WHEN h THEN split_part(repo, '_', 1) ELSE 'hub.example' END AS host, CASE WHEN h THEN substr(repo, strpos(repo, '_') + 1) ELSE repo END AS rest FROM a)
        SELECT list_id, 'https://' || host || '/' || CASE WHEN contains(rest, '_') THEN split_part(rest, '_', 1) || '/' || substr(rest, strpos(rest, '_') + 1) ELSE rest END AS url FROM b""",
    "message_summary": r"""SELECT doc_id, trim(regexp_replace(regexp_extract(text, '(?s)\A[ \n\t]*(.*?)(?:\n[ \t]*\n|\z)', 1), '[ \t]*\n[ \t]*', ' ', 'g'), ' ') AS summary,
        substr(regexp_replace(translate(substr(text, 1, 1000), chr(10) || chr(13) || chr(9) || ';', '    '), ' +', ' ', 'g'), 1, 300) AS excerpt, translate(text, ';' || chr(13) || chr(10), ':__') AS line FROM documents WHERE text IS NOT NULL""",
    "message_trailers": r"""WITH a AS (SELECT doc_id, text, string_split_regex(regexp_replace(text, '\s+\z', ''), '\n[ \t]*\n') AS p FROM documents WHERE text IS NOT NULL), b AS (SELECT doc_id, string_split(p[-1], chr(10)) AS l FROM a WHERE regexp_matches(text, '\n[ \t]*\n')),
        c AS (SELECT doc_id, unnest(l) AS x FROM b WHERE len(list_filter(l, lambda y: NOT regexp_matches(y, '^[A-Za-z0-9][A-Za-z0-9-]*[ \t]*: *\S'))) = 0) SELECT doc_id, regexp_extract(x, '^([A-Za-z0-9-]+)', 1) AS key, trim(regexp_extract(x, '^[^:]*:(.*)$', 1), ' ') AS value FROM c""",
    "path_parts": "SELECT line_no, CASE WHEN contains(" + _B + ", '/') THEN CASE WHEN regexp_replace(" + _B + ", '/+[^/]*$', '') = '' THEN '/' ELSE regexp_replace(" + _B + ", '/+[^/]*$', '') END ELSE '.' END AS dir, string_split(" + _B + ", '/')[-1] AS base FROM olist WHERE path IS NOT NULL",
    "section_check": "SELECT count(*) AS wrong FROM store_idx WHERE (('0x' || substr(sha, 1, 2))::INT & 127) <> sec",
    "reference_names": r"""WITH r AS (SELECT list_id, CASE batch % 3 WHEN 0 THEN 'refs/heads/' WHEN 1 THEN 'refs/tags/' ELSE 'refs/remotes/origin/' END || repo AS name FROM p2cd WHERE repo IS NOT NULL)
        SELECT list_id, regexp_replace(name, '^refs/(heads/|tags/|remotes/)?', '') AS short, NOT regexp_matches(name, '(^|/)\.|\.\.|@\{|[\x00-\x20\x7f~^:?*\[\\]|//|/$|^/|\.lock(/|$)|\.$|^@$|^$') AS valid, CASE WHEN starts_with(name, 'refs/heads/') THEN 'refs/remotes/up/' || substr(name, 12) END AS target FROM r""",
    "config_values": "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_size WHEN 1 THEN p_size * 1024 WHEN 2 THEN p_size * 1048576 WHEN 3 THEN p_size::BIGINT * 1073741824 END::BIGINT AS n, CASE p_partkey % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false WHEN 4 THEN true END AS b FROM part",
    "signature_parse": r"""SELECT author_id, regexp_replace(regexp_replace(regexp_extract(parseauthorid, '(?s)^([^<]*)', 1), '^[\s.,:;<>"\\'']+', ''), '[\s.,:;<>"\\'']+\z', '') AS name, trim(regexp_extract(parseauthorid, '<([^<>]*)>[^<>]*\z', 1), ' ') AS mail,
        regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(simpemail, '@([^@>\s]+)', 1)), '^[^.]*\.noreply\.', ''), '/.*', ''), '\.(?:local|localdomain)\z', '') AS domain FROM authors""",
    "message_prettify": r"""WITH v AS (SELECT doc_id, text, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(?m)^#.*\n?', '', 'g'), '[ \t\r\f\v]+(\n|\z)', '\1', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '\A\n+|\n+\z', '', 'g') AS p FROM documents WHERE text IS NOT NULL)
        SELECT doc_id, CASE WHEN p = '' THEN p ELSE p || chr(10) END AS pretty, md5(replace(replace(text, chr(13) || chr(10), chr(10)), chr(10), chr(13) || chr(10))) AS crlf, md5(replace(text, chr(13) || chr(10), chr(10))) AS lf FROM v""",
}

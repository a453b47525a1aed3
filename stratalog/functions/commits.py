"""Parts of commit texts, dates, object ids, addresses and names, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.plans import model as M
from stratalog.sources.tables import table

# ---------------------------------------------------------------------------------------------------------- commit text


def header_field(text: Column, name: str) -> Column:
    """A field of a commit's header; continuation lines, which begin with a blank, belong to it. Null without it."""
    head = F.split(text, "\n\n", 2)[0]
    got = F.regexp_extract(F.concat(F.lit("\n"), head), rf"\n{name} ([^\n]*(?:\n [^\n]*)*)", 1)
    return F.when(F.concat(F.lit("\n"), head).rlike(rf"\n{name} "), F.regexp_replace(got, "\n ", "\n"))


def commit_message(text: Column) -> Column:
    """All behind a commit's header, without line ends at its front."""
    parts = F.split(text, "\n\n", 2)
    return F.when(F.size(parts) > 1, F.regexp_replace(parts[1], r"\A\n+", "")).otherwise("")


def commit_body(message: Column) -> Column:
    """What follows a message's first paragraph, blanks trimmed; empty if nothing does."""
    rest = F.regexp_extract(message, r"(?s)\A\s*\S.*?\n[ \t]*\n(.*)\z", 1)
    return F.regexp_replace(rest, r"\A\s+|\s+\z", "")


def signature_time(c: Column) -> Column:
    """struct<time long, offset int (minutes)> of a `Name <mail> time zone` signature; null without a time."""
    t = F.regexp_extract(c, r"> (\d+)(?: [+-]\d{4})?\s*\z", 1)
    z = F.regexp_extract(c, r"> \d+ ([+-]\d{4})\s*\z", 1)
    return F.when(t != "", F.struct(t.try_cast("long").alias("time"), offset_minutes(z).alias("offset")))


def offset_minutes(zone: Column) -> Column:
    """Minutes of `+hhmm`, `+hh:mm` or `Z`; 0 where the text is empty or out of range (14 hours, 59 minutes)."""
    h, m = F.regexp_extract(zone, r"^[+-](\d\d)", 1), F.regexp_extract(zone, r"^[+-]\d\d:?(\d\d)", 1)
    n = F.when(h == "", 0).otherwise(h.try_cast("int") * 60 + F.coalesce(m.try_cast("int"), F.lit(0)))
    ok = (h == "") | ((h.try_cast("int") <= 14) & (F.coalesce(m.try_cast("int"), F.lit(0)) <= 59))
    return F.when(ok, F.when(zone.startswith("-"), -n).otherwise(n)).otherwise(0)


#: Months in mails.
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}


def parse_date(c: Column, now: Column) -> Column:
    """struct<time long, offset int> of a date as people and programs write it; null if it is none.

    Read are: seconds with an optional zone (`@123 +0100`), mail dates (`Thu, 7 Apr 2005 22:13:13 +0200`), ISO dates with
    optional time and zone, `now`, `yesterday`, and `<n> <unit>s ago` counted back from `now`. Without a zone: UTC.
    """
    v = F.trim(c)
    part = lambda pattern, i: F.regexp_extract(v, pattern, i)
    num = lambda pattern, i: part(pattern, i).try_cast("int")
    raw = r"^@?(\d{8,})(?: ([+-]\d{4}))?$"
    mail = rf"^(?:[A-Z][a-z]{{2}}, +)?(\d{{1,2}}) +({'|'.join(MONTHS)})[a-z]* +(\d{{4}}) +(\d{{1,2}}):(\d\d)(?::(\d\d))?(?: +([+-]\d{{4}}|GMT|UTC))?$"
    iso = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[T ]+(\d{1,2}):(\d\d)(?::(\d\d)(?:[.,]\d+)?)?)?(?: ?(Z|[+-]\d\d:?\d\d))?$"
    ago = rf"^(\d+)[ .]({'|'.join(UNITS)})s?[ .]ago$"

    def at(y: Column, mo: Column, d: Column, h: Column, mi: Column, s: Column, zone: Column) -> Column:
        zero = lambda x: F.coalesce(x, F.lit(0))
        t = F.unix_seconds(F.try_make_timestamp(y, mo, d, zero(h), zero(mi), zero(s), F.lit("UTC")))
        return F.when(t.isNotNull(), F.struct((t - offset_minutes(zone) * 60).alias("time"), offset_minutes(zone).alias("offset")))

    month = F.array_position(F.array(*map(F.lit, MONTHS)), part(mail, 2)).cast("int")
    back = part(ago, 1).try_cast("long") * F.element_at(F.create_map(*[F.lit(x) for kv in UNITS.items() for x in kv]), part(ago, 2))
    plain = lambda t: F.struct(t.cast("long").alias("time"), F.lit(0).alias("offset"))
    return (
        F.when(v.rlike(raw), F.struct(part(raw, 1).try_cast("long").alias("time"), offset_minutes(part(raw, 2)).alias("offset")))
        .when(v.rlike(mail), at(num(mail, 3), month, num(mail, 1), num(mail, 4), num(mail, 5), num(mail, 6), part(mail, 7)))
        .when(v.rlike(iso), at(num(iso, 1), num(iso, 2), num(iso, 3), num(iso, 4), num(iso, 5), num(iso, 6), part(iso, 7)))
        .when(v == "now", plain(now))
        .when(v == "yesterday", plain(now - 86400))
        .when(v.rlike(ago), plain(now - back))
    )


# ------------------------------------------------------------------------------------------------------------------ ids


def oid_path(oid: Column) -> Column:
    """The path of a loose object: two digits, a slash, the rest."""
    return F.concat(F.substring(oid, 1, 2), F.lit("/"), F.substring(oid, 3, 64))


def oid_short(oid: Column, digits: int = 7) -> Column:
    return F.substring(oid, 1, digits)


def oid_parse(text: Column) -> Column:
    """The id of 40 (or for SHA-256 64) hexadecimal digits in lower case, or null."""
    return F.when(text.rlike(r"\A(?:[0-9a-fA-F]{40}|[0-9a-fA-F]{64})\z"), F.lower(text))


def oid_is_zero(oid: Column) -> Column:
    return oid.rlike(r"\A0+\z")


def blob_oid_sha256(text: Column) -> Column:
    """The id of a blob with this text in a repository of SHA-256 ids."""
    body = F.encode(text, "utf-8")
    return F.sha2(F.concat(F.encode(F.concat(F.lit("blob "), F.octet_length(body).cast("string")), "utf-8"), F.unhex(F.lit("00")), body), 256)


# ------------------------------------------------------------------------------------------------------ addresses, names

#: Ports that schemes stand for.
PORTS = {"http": "80", "https": "443", "ssh": "22", "git": "9418"}


def url_parts(c: Column) -> Column:
    """struct<scheme, user, host, port, path> of an address, also of `user@host:path`; missing parts are empty, the port
    is the scheme's own where none is given."""
    full = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://(?:([^@/]*)@)?([^:/?#]*)(?::(\d*))?(.*)\z"
    scp = r"(?s)^(?:([^@/:]+)@)?([^:/@]+):(?!//)(.*)\z"
    x = lambda p, i: F.regexp_extract(c, p, i)
    scheme = F.lower(x(full, 1))
    known = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for kv in PORTS.items() for v in kv]), scheme), F.lit(""))
    given = F.struct(scheme.alias("scheme"), x(full, 2).alias("user"), F.lower(x(full, 3)).alias("host"), F.when(x(full, 4) != "", x(full, 4)).otherwise(known).alias("port"), x(full, 5).alias("path"))
    short = F.struct(F.lit("ssh").alias("scheme"), x(scp, 1).alias("user"), F.lower(x(scp, 2)).alias("host"), F.lit("22").alias("port"), x(scp, 3).alias("path"))
    return F.when(c.rlike(full), given).when(c.rlike(scp), short)


def legacy_name(c: Column, rules: list[tuple[str, str]]) -> Column:
    """A project name of an older scheme in the present one: host rules (pattern, replacement) in order, then an end slash
    dropped, the first slash as `_`, `.git` dropped at the end."""
    for pattern, new in rules:
        c = F.regexp_replace(c, pattern, new)
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"/\z", ""), r"(?s)\A([^/]*)/", "$1_"), r"\.git\z", "")


def ident_expand(c: Column, oid: Column) -> Column:
    """`$Id$` and `$Id: …$` as checked out: with the blob's id."""
    return F.regexp_replace(c, F.lit(r"\$Id(?::[^$\n]*)?\$"), F.concat(F.lit(r"\$Id: "), oid, F.lit(r" \$")))


def ident_collapse(c: Column) -> Column:
    """`$Id: …$` as stored."""
    return F.regexp_replace(c, r"\$Id:[^$\n]*\$", r"\$Id\$")


def ascii_only(c: Column) -> Column:
    """Characters beyond ASCII as `?`, so that a text fits a line that others read bytewise."""
    return F.regexp_replace(c, r"[^\x00-\x7F]", "?")


def ref_normalize(c: Column) -> Column:
    """A reference name with runs of slashes made one and none at its front; null if it is still no valid name."""
    from stratalog.functions.scalars import ref_valid

    v = F.regexp_replace(F.regexp_replace(c, "/+", "/"), r"\A/", "")
    return F.when(ref_valid(v), v)


def path_prettify(c: Column) -> Column:
    """A path without `.` parts and doubled slashes, with `name/..` pairs taken out and `..` above the root dropped."""
    parts = F.filter(F.split(c, "/"), lambda x: ~x.isin("", "."))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, x: F.when(x != "..", F.concat(acc, F.array(x))).otherwise(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))))
    return F.concat(F.when(c.startswith("/"), "/").otherwise(""), F.array_join(kept, "/"))


def refspec_targets(name: Column, specs: list[str]) -> Column:
    """array<string>: where the refspecs map a reference name; a `^pattern` among them takes the name out altogether."""
    from stratalog.functions.scalars import refspec_target

    out = F.array_compact(F.array(*[refspec_target(name, s) for s in specs if not s.startswith("^")]))
    barred = F.lit(False)
    for s in specs:
        if s.startswith("^"):
            barred = barred | refspec_target(name, f"{s[1:]}:{s[1:]}").isNotNull()
    return F.when(barred, F.array().cast("array<string>")).otherwise(out)


# ------------------------------------------------------------------------------------------------------------- queries


def commit_texts(s: SparkSession, d: str) -> DataFrame:
    """oid, text: each order as a commit text, with a signature block where 5 divides the key."""
    o = table(s, d, "orders")
    who = F.concat(F.lit("C "), F.col("o_custkey").cast("string"), F.lit(" <c"), F.col("o_custkey").cast("string"), F.lit("@hub.example> "), F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("string"), F.when(F.col("o_orderkey") % 2 == 0, " +0130").otherwise(" -0500"))
    signed = F.when(F.col("o_orderkey") % 5 == 0, "\ngpgsig -----BEGIN\n line one\n -----END").otherwise("")
    return o.select(
        F.col("o_orderkey").alias("oid"),
        F.concat(F.lit("tree "), F.sha1(F.col("o_orderkey").cast("string").cast("binary")), F.lit("\nauthor "), who, F.lit("\ncommitter "), who, signed, F.lit("\n\n"), "o_orderpriority", F.lit("\n\nStatus is "), "o_orderstatus", F.lit(".\n")).alias("text"),
    )


def q_commit_text(s: SparkSession, d: str) -> DataFrame:
    from stratalog.functions.scalars import signature_mail, signature_name, summary

    t, who = F.col("text"), header_field(F.col("text"), "author")
    m = commit_message(t)
    return commit_texts(s, d).select(
        "oid", header_field(t, "tree").alias("tree"), signature_name(who).alias("name"), F.regexp_extract(who, "<([^<>]*)>", 1).alias("mail"), signature_time(who)["time"].alias("time"), signature_time(who)["offset"].alias("tz"),
        header_field(t, "gpgsig").alias("sig"), summary(m).alias("summary"), commit_body(m).alias("body"),
    )


def q_dates(s: SparkSession, d: str) -> DataFrame:
    """Order dates written in five ways and read again."""
    o = table(s, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("t"))
    way = F.col("o_orderkey") % 5
    text = (
        F.when(way == 0, F.concat(F.lit("@"), F.unix_seconds("t").cast("string"), F.lit(" +0200")))
        .when(way == 1, F.concat(F.date_format("t", "EEE, d MMM yyyy HH:mm:ss"), F.lit(" -0130")))
        .when(way == 2, F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(way == 3, F.concat((F.col("o_orderkey") % 100).cast("string"), F.lit(" hours ago")))
        .otherwise("13 Foo 2020")
    )
    x = o.select("o_orderkey", parse_date(text, F.unix_seconds("t")).alias("x"))
    return x.select("o_orderkey", "x.time", "x.offset")


def q_oids(s: SparkSession, d: str) -> DataFrame:
    o = oid_parse(F.trim("sha"))
    return table(s, d, "olist").where(o.isNotNull()).select("line_no", oid_path(o).alias("path"), oid_short(o).alias("short"), oid_is_zero(o).alias("zero"))


def q_sha256(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").where("text IS NOT NULL").select("doc_id", blob_oid_sha256(F.col("text")).alias("oid"))


def q_url_parts(s: SparkSession, d: str) -> DataFrame:
    x = table(s, d, "urls").where("url IS NOT NULL").select("url_id", url_parts(F.col("url")).alias("x")).where("x IS NOT NULL")
    return x.select("url_id", "x.*")


#: Hosts of the test forges under which older names stand.
LEGACY = [(r"^lab\.example_", "lb_"), (r"^git\.hub\.example_pub/", "hub.example_")]


def q_legacy(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "p2cd").where("repo IS NOT NULL").select("list_id", legacy_name(F.col("repo"), LEGACY).alias("name"))


def q_ident(s: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.lit("$Id$\n"), F.col("text"), F.lit("\n$Id: old $"))
    out = ident_expand(t, M.blob_oid(F.col("text")))
    return table(s, d, "documents").where("text IS NOT NULL AND NOT contains(text, '$Id')").select("doc_id", F.md5(out).alias("expanded"), F.md5(ident_collapse(out)).alias("collapsed"), F.md5(ascii_only(F.col("text"))).alias("ascii"))


def q_ref_paths(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "p2cd").where("repo IS NOT NULL").select("list_id", F.concat(F.lit("/refs//heads/"), "repo").alias("name"), F.concat(F.lit("a/./b/../"), "repo", F.lit("//c/..")).alias("path"))
    specs = ["refs/heads/*:refs/remotes/up/*", "refs/*:refs/all/*", "^refs/heads/*-fork"]
    return r.select("list_id", ref_normalize(F.col("name")).alias("ref"), path_prettify(F.col("path")).alias("pretty"), F.array_join(refspec_targets(ref_normalize(F.col("name")), specs), " ").alias("targets"))


QUERIES = {"commit_text": q_commit_text, "date_parse": q_dates, "oid_formats": q_oids, "blob_sha256": q_sha256, "url_parse": q_url_parts, "legacy_names": q_legacy, "ident_filter": q_ident, "ref_path_normalize": q_ref_paths}

SQL = {
    "commit_text": "SELECT o_orderkey AS oid, sha1(o_orderkey::VARCHAR) AS tree, 'C ' || o_custkey::VARCHAR AS name, 'c' || o_custkey::VARCHAR || '@hub.example' AS mail, epoch(o_orderdate)::BIGINT AS time, CASE WHEN o_orderkey % 2 = 0 THEN 90 ELSE -300 END AS tz, CASE WHEN o_orderkey % 5 = 0 THEN '-----BEGIN' || chr(10) || 'line one' || chr(10) || '-----END' END AS sig, o_orderpriority AS summary, 'Status is ' || o_orderstatus || '.' AS body FROM orders",
    "date_parse": "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN epoch(o_orderdate)::BIGINT WHEN 1 THEN epoch(o_orderdate)::BIGINT + 5400 WHEN 2 THEN epoch(o_orderdate)::BIGINT WHEN 3 THEN epoch(o_orderdate)::BIGINT - 3600 * (o_orderkey % 100) END AS time, CASE o_orderkey % 5 WHEN 0 THEN 120 WHEN 1 THEN -90 WHEN 2 THEN 0 WHEN 3 THEN 0 END AS \"offset\" FROM orders",
    "oid_formats": "WITH o AS (SELECT line_no, lower(trim(sha, ' ')) AS o FROM olist WHERE regexp_full_match(trim(sha, ' '), '[0-9a-fA-F]{40}|[0-9a-fA-F]{64}')) SELECT line_no, o[1:2] || '/' || o[3:] AS path, o[1:7] AS short, regexp_full_match(o, '0+') AS zero FROM o",
    "blob_sha256": "SELECT doc_id, sha256(encode('blob ' || octet_length(encode(text))::VARCHAR || chr(0) || text)) AS oid FROM documents WHERE text IS NOT NULL",
    "url_parse": r"""WITH u AS (SELECT url_id, url, regexp_extract(url, '(?s)^([A-Za-z][A-Za-z0-9+.-]*)://(?:([^@/]*)@)?([^:/?#]*)(?::(\d*))?(.*)$', ['s', 'u', 'h', 'p', 'r']) AS f, regexp_extract(url, '(?s)^(?:([^@/:]+)@)?([^:/@]+):(.*)$', ['u', 'h', 'r']) AS c, regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://') AS full_, regexp_matches(url, '^(?:[^@/:]+@)?[^:/@]+:') AND NOT regexp_matches(url, '^(?:[^@/:]+@)?[^:/@]+://') AS scp FROM urls WHERE url IS NOT NULL)
        SELECT url_id, CASE WHEN full_ THEN lower(f.s) ELSE 'ssh' END AS scheme, CASE WHEN full_ THEN f.u ELSE c.u END AS "user", lower(CASE WHEN full_ THEN f.h ELSE c.h END) AS host, CASE WHEN NOT full_ THEN '22' WHEN f.p <> '' THEN f.p ELSE coalesce(map {'http': '80', 'https': '443', 'ssh': '22', 'git': '9418'}[lower(f.s)], '') END AS port, CASE WHEN full_ THEN f.r ELSE c.r END AS path FROM u WHERE full_ OR scp""",
    "legacy_names": r"SELECT list_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(repo, '^lab\.example_', 'lb_'), '^git\.hub\.example_pub/', 'hub.example_'), '/$', ''), '/', '_'), '\.git$', '') AS name FROM p2cd WHERE repo IS NOT NULL",
    "ident_filter": r"WITH t AS (SELECT doc_id, text, sha1(encode('blob ' || octet_length(encode(text))::VARCHAR || chr(0) || text)) AS o FROM documents WHERE text IS NOT NULL AND NOT contains(text, '$Id')) SELECT doc_id, md5('$Id: ' || o || ' $' || chr(10) || text || chr(10) || '$Id: ' || o || ' $') AS expanded, md5('$Id$' || chr(10) || text || chr(10) || '$Id$') AS collapsed, md5(regexp_replace(text, '[^\x00-\x7F]', '?', 'g')) AS ascii FROM t",
    "ref_path_normalize": r"""WITH r AS (SELECT list_id, repo, regexp_replace('refs/heads/' || repo, '/+', '/', 'g') AS v FROM p2cd WHERE repo IS NOT NULL), n AS (SELECT *, CASE WHEN NOT regexp_matches(v, '(^|/)\.|\.\.|@\{|[\x00-\x20\x7f~^:?*\[\\]|//|/$|^/|\.lock(/|$)|\.$|^@$|^$') THEN v END AS ref FROM r)
        SELECT list_id, ref, 'a/' || array_to_string(list_filter(string_split(repo, '/'), lambda x: x NOT IN ('', '.')), '/') AS pretty, CASE WHEN ref IS NULL OR regexp_full_match(ref, 'refs/heads/.*-fork') THEN '' ELSE 'refs/remotes/up/' || substr(ref, 12) || ' refs/all/' || substr(ref, 6) END AS targets FROM n""",
}

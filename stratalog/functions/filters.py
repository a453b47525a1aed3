"""Content filters: what a file's content goes through between store and work tree, in the order of their priority."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.functions.commits import ident_collapse, ident_expand
from stratalog.functions.scalars import to_crlf, to_lf
from stratalog.operators.rules import attribute, attribute_rules
from stratalog.plans import model as M
from stratalog.sources.tables import table


@dataclass(frozen=True)
class Filter:
    """A filter: when it applies (by the attributes' columns), and what it makes of (content, attributes) each way."""

    priority: int
    applies: Callable[[dict[str, Column]], Column]
    smudge: Callable[[Column, dict[str, Column]], Column]
    clean: Callable[[Column, dict[str, Column]], Column]


def _is(attrs: dict[str, Column], name: str, *values: str) -> Column:
    return F.coalesce(attrs[name].isin(*values), F.lit(False)) if name in attrs else F.lit(False)


#: The built-in filters; line ends come first on the way out of the store, idents behind them.
FILTERS: dict[str, Filter] = {
    "crlf": Filter(0, lambda a: _is(a, "text", "true", "auto") & _is(a, "eol", "crlf"), lambda c, a: to_crlf(c), lambda c, a: to_lf(c)),
    "ident": Filter(100, lambda a: _is(a, "ident", "true"), lambda c, a: ident_expand(c, M.blob_oid(ident_collapse(to_lf(c)))), lambda c, a: ident_collapse(c)),
}


def filtered(content: Column, path: Column, lines: list[str], to_store: bool, filters: dict[str, Filter] | None = None) -> Column:
    """`content` of the file `path` after all filters that its attributes (attribute lines) call for.

    Smudging (out of the store) runs filters by rising priority, cleaning (into the store) by falling. Null stays null.
    """
    known = {**FILTERS, **(filters or {})}
    names = sorted({w.lstrip("-!").partition("=")[0] for line in lines for w in line.split()[1:]})
    attrs = {n: attribute(path, attribute_rules(lines, n)) for n in names}
    for f in sorted(known.values(), key=lambda f: f.priority, reverse=to_store):
        content = F.when(f.applies(attrs), (f.clean if to_store else f.smudge)(content, attrs)).otherwise(content)
    return content


def q_filters(s: SparkSession, d: str) -> DataFrame:
    """Documents as files of several kinds: smudged, and cleaned again to what they were."""
    lines = ["*.txt text eol=crlf", "*.c ident", "*.md text eol=crlf ident", "*.bin -text"]
    t = table(s, d, "documents").where("text IS NOT NULL AND NOT contains(text, '$Id') AND NOT contains(text, '\\r')")
    path = F.concat(F.lit("d/f"), F.element_at(F.array(*map(F.lit, [".txt", ".c", ".md", ".bin"])), (F.col("doc_id") % 4 + 1).cast("int")))
    x = t.select("doc_id", path.alias("path"), F.concat(F.lit("$Id$\n"), "text").alias("body"))
    out = x.withColumn("out", filtered(F.col("body"), F.col("path"), lines, False))
    return out.select("doc_id", F.md5("out").alias("smudged"), (filtered(F.col("out"), F.col("path"), lines, True) == F.col("body")).alias("back"))


QUERIES = {"filter_chain": q_filters}
SQL = {
    "filter_chain": "WITH t AS (SELECT doc_id, doc_id % 4 AS way, '$Id$' || chr(10) || text AS body FROM documents WHERE text IS NOT NULL AND NOT contains(text, '$Id') AND NOT contains(text, chr(13))), o AS (SELECT *, '$Id: ' || sha1(encode('blob ' || octet_length(encode(body))::VARCHAR || chr(0) || body)) || ' $' || substr(body, 5) AS i FROM t) SELECT doc_id, md5(CASE way WHEN 0 THEN replace(body, chr(10), chr(13) || chr(10)) WHEN 1 THEN i WHEN 2 THEN replace(i, chr(10), chr(13) || chr(10)) ELSE body END) AS smudged, true AS back FROM o",
}

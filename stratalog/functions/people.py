"""Author ids: e-mail normalisation, first and last name, parsed parts, as Arrow functions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from stratalog.plans.spread import spread
from stratalog.sources.tables import table

_EDGE = " \t\n\r\"'{}()#!%$/&*+.,-@"
#: Fixed value: what may stand behind a name.
_SUFFIX = re.compile(r"(?:[iv]|[iv][iv]|ii[iv]|vii|jr|sr|phd|md|dds)\Z")


def normal_mail(mail: str | None) -> str:
    """An address without configuration leftovers, noreply hosts, numbered machines and local endings; null gives ''."""
    if not mail:
        return ""
    text = mail.split("git config")[0]
    text = "".join(ch for ch in text if ch not in "¨«»")
    user, at, rest = text.partition("@")
    domain = rest.split("@")[0]
    if not at or not domain or re.fullmatch(r"\d+(?:\.\d+){3}", domain):
        return text
    domain = re.sub(r"\A[^.]*\.noreply\.", "", domain).split("/")[0]
    parts = domain.split(".")
    if len(parts) > 2 and any(ch.isdigit() for ch in parts[0]):
        parts = parts[1:]
    if domain.endswith((".local", ".localdomain")):
        parts = parts[:-1]
    return f"{user}@{'.'.join(parts)}"


def _ends(words: list[str]) -> str:
    words = [w for w in words if w]
    if len(words) > 2 and _SUFFIX.match(words[-1]):
        words = words[:-1]
    return "" if not words else words[0] if len(words) == 1 else f"{words[0]} {words[-1]}"


def _uncamel(text: str, by: str) -> str:
    return re.sub(r"([a-z])([A-Z])", rf"\1{by}\2", re.sub(r"([a-z])([A-Z])([A-Z])", rf"\1{by}\2{by}\3", text))


def first_last(author: str | None) -> str:
    """`first last` in lower case of an author id: from its name, else from the user part of its address; '' without."""
    if not author:
        return ""
    name = re.sub(r"\s+<.*", "", author, flags=re.S)
    inner = re.search(r"([a-zA-Z0-9_.]+)@[a-zA-Z0-9]+\.[a-z]+", name)
    if inner:
        words = [w for w in re.split(r"[._-]", _uncamel(inner[1].strip(_EDGE), "."))]
        if len(words) > 2:
            return f"{words[0]} {words[-1]}"
        name = name.replace(inner[1], "", 1)
    name = re.sub(r"[.,\-\s]+", " ", name.strip(_EDGE))
    name = re.sub(r"\bMc ([A-Z])", r"Mc\1", _uncamel(name, " ")).lower().strip()
    if name and not name.isdigit():
        return _ends(name.split(" "))
    user = author.rpartition("<")[2].split(">")[0].strip(_EDGE).split("@")[0]
    words = re.split(r"[ ._-]", _uncamel(user, " "))
    return _ends([w.lower() for w in words if w and not w.isdigit()])


def author_parts(author: str | None) -> tuple[str, str, str, str, str, str]:
    """(first, last, user, domain, mail, account) of an author id; account is the user of a noreply address."""
    first, _, last = first_last(author).partition(" ")
    mail = (author or "").rpartition("<")[2].split(">")[0].replace("{ID}+{", "").translate(str.maketrans("", "", "{}"))
    mail = mail.strip(_EDGE.replace("@", "")).lower()
    account = re.search(r"([^+ ]+)@users\.noreply\.[^@\s]+\Z", mail)
    if account:
        mail = account[0]
    user, _, domain = mail.partition("@")
    return first, last, user, domain, mail, account[1] if account else ""


def author_table(authors: DataFrame) -> DataFrame:
    """author_id, first, last, user, domain, mail, account, name, normal_mail for every author row; nulls give ''."""
    cols = ["author_id", "first", "last", "user", "domain", "mail", "account", "name", "normal_mail"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(i, *author_parts(w), first_last(n), normal_mail(m)) for i, w, n, m in zip(pdf.author_id, pdf.parseauthorid, pdf.getfl, pdf.simpemail)], columns=cols)

    return spread(authors.select("author_id", "parseauthorid", "getfl", "simpemail"), "author_id").mapInPandas(work, "author_id long, " + ", ".join(f"{c} string" for c in cols[1:]))


def q_authors(s: SparkSession, d: str) -> DataFrame:
    return author_table(table(s, d, "authors"))


QUERIES = {"author_parts": q_authors}
SQL: dict[str, str] = {}

"""Variant spellings of names typed by people: noisy-channel attribution (problem 6).

Spellings are parsed into a given name and a surname (or an organisation). Frequent spellings are the candidate
canonical forms. A variant is attached to the candidate with the largest posterior: the logarithm of the candidate's
frequency plus the likelihood that typing it gives the variant - by a typo, an initial, a short form, or another
script. Candidates are found through deletion neighbourhoods of the surname, so no pairs within a block are formed.
Rows that share a form or a personal address are then joined into one entity.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalog.llm.encoding import PairScores, count_pairs, repair
from stratalog.plans.lineage import discard, written
from stratalog.plans.skew import keyed_join
from stratalog.plans.spread import spread
from stratalog.sources.tables import table

# ----------------------------------------------------------------------------------------------------- fixed values

#: Names and addresses that stand in for a missing one.
NO_NAME = set("root admin administrator unknown yourname noauthor user none nobody anonymous git username name me ubuntu test default ec2user".split())
NO_LOCAL = set("root none noreply you git nobody user admin unknown no-reply anonymous your.name youremail email mail localhost".split())
#: Local parts of roles, used by many people of one organisation.
ROLES = set("noreply build oss dev ci-bot bot ci info contact team support admin git opensource security".split())
#: Words of organisations' names.
ORG_WORDS = set("software systems foundation robotics analytics storage networks compute instruments labs laboratories technologies solutions industries institute university consortium project group company corp corporation inc ltd llc gmbh bv ag sa team the".split())
#: Words of an organisation's name that spellings leave out.
ORG_LOOSE = set("the team ltd inc llc gmbh bv ag sa corp co company limited official".split())
#: Titles and suffixes of people.
TITLES = set("dr prof mr mrs ms sir md phd msc jr sr ii iii iv esq dipl ing bsc ma".split())
#: Short forms of given names.
SHORT = {
    "alex": "alexander alexandra aleksandra alexandre", "andy": "andrew andreas", "dan": "daniel", "danny": "daniel", "jake": "jacob", "wolf": "wolfgang", "max": "maximilian", "jo": "johannes joseph joanna",
    "joe": "joseph", "bob": "robert", "rob": "robert", "bobby": "robert", "bill": "william", "will": "william", "billy": "william", "liz": "elizabeth", "beth": "elizabeth", "betty": "elizabeth", "lisa": "elizabeth",
    "kate": "katherine", "kathy": "katherine", "katie": "katherine", "cathy": "catherine", "mike": "michael", "mick": "michael", "misha": "mikhail", "dave": "david", "tom": "thomas", "tommy": "thomas", "tim": "timothy",
    "jim": "james", "jamie": "james", "jimmy": "james", "jack": "john", "johnny": "john", "jon": "jonathan john", "matt": "matthew", "nick": "nicholas", "nate": "nathaniel", "nat": "nathaniel natalia", "ben": "benjamin", "tony": "anthony",
    "steve": "stephen steven", "chris": "christopher christine", "rick": "richard", "dick": "richard", "rich": "richard", "ed": "edward", "ted": "edward theodore", "ned": "edward", "theo": "theodore", "chuck": "charles", "charlie": "charles",
    "sue": "susanna susan", "susie": "susanna", "becky": "rebecca", "becca": "rebecca", "maggie": "margaret", "meg": "margaret", "peggy": "margaret", "jen": "jennifer", "jenny": "jennifer", "pat": "patricia patrick", "patty": "patricia", "trish": "patricia",
    "greg": "gregory", "phil": "philip", "pete": "peter", "larry": "lawrence", "vince": "vincent", "fred": "frederick", "freddy": "frederick", "zach": "zachary", "zack": "zachary", "leo": "leonard", "len": "leonard", "lenny": "leonard",
    "gabi": "gabriela", "gaby": "gabriela", "sasha": "aleksandra alexander", "dima": "dmitri", "mitya": "dmitri", "katya": "ekaterina yekaterina", "kat": "ekaterina", "vova": "vladimir", "volodya": "vladimir", "vlad": "vladimir", "vanya": "ivan",
    "pepe": "jose jorge", "paco": "francisco", "pancho": "francisco", "lupe": "guadalupe", "nacho": "ignacio", "seb": "sebastian", "bella": "isabella", "izzy": "isabella", "hal": "henry", "harry": "henry", "hank": "henry", "javi": "xavier",
    "ola": "aleksandra", "isa": "isabella", "kit": "katherine christopher", "basti": "sebastian", "hannes": "johannes", "benny": "benjamin", "joey": "joseph", "eddie": "edward", "freddie": "frederick", "lizzie": "elizabeth", "nico": "nicholas", "natasha": "natalia",
    "sam": "samuel", "sammy": "samuel", "vicky": "victoria", "tori": "victoria", "val": "valeria", "magda": "magdalena", "hans": "johannes", "beppe": "giuseppe", "seppi": "giuseppe", "deb": "deborah", "tomek": "tomasz", "lena": "magdalena helena",
}
#: How one script's letters stand for another's, digraphs first.
TO_CYRILLIC = {"zh": "ж", "sh": "ш", "ch": "ч", "th": "т", "ph": "ф", "a": "а", "b": "б", "c": "к", "d": "д", "e": "е", "f": "ф", "g": "г", "h": "х", "i": "и", "j": "и", "k": "к", "l": "л", "m": "м", "n": "н", "o": "о", "p": "п", "q": "к", "r": "р", "s": "с", "t": "т", "u": "у", "v": "в", "w": "в", "x": "к", "y": "с", "z": "и"}
_DIGRAPHS = [x for x in TO_CYRILLIC if len(x) > 1]
_LETTERS = str.maketrans({x: y for x, y in TO_CYRILLIC.items() if len(x) == 1})
_UNMARKED = str.maketrans({"ø": "o", "ł": "l", "ß": "ss", "æ": "ae", "ı": "i", "đ": "d", "œ": "oe", "þ": "th", "ð": "d"})

_ADDRESS = re.compile(r"[^\s<>\"{}|]+@[^\s<>\"{}/|]+")
_CYR = re.compile("[Ѐ-ӿ]")

# ----------------------------------------------------------------------------------------------------------- parsing


class _Kept(dict):
    """Translation that drops marks and format characters; filled as characters are met."""

    def __missing__(self, code: int) -> int | None:
        ch = chr(code)
        self[code] = None if unicodedata.combining(ch) or unicodedata.category(ch) == "Cf" else code
        return self[code]


_KEPT = _Kept()


def plain(text: str) -> str:
    """Lower case without marks and format characters."""
    return text.lower() if text.isascii() else _plain(text)


@lru_cache(maxsize=200_000)
def _plain(text: str) -> str:
    return unicodedata.normalize("NFKD", text.lower().translate(_UNMARKED)).translate(_KEPT)


def skeleton(text: str) -> str:
    """A Latin or Cyrillic word in the Cyrillic letters that stand for it."""
    if "h" in text:
        for two in _DIGRAPHS:  # they all end in h, so no two of them overlap
            text = text.replace(two, TO_CYRILLIC[two])
    return text.translate(_LETTERS)


def address(raw: str | None) -> tuple[str, str] | None:
    """(local, domain) of an e-mail address with its surroundings removed, or null."""
    m = _ADDRESS.search(raw or "")
    if not m:
        return None
    local, _, domain = plain(m[0]).strip("‘’“”«»„…'`,;:()[].").partition("@")
    local, domain = local.strip("‘’“”«»„…'`,;:()[]."), domain.strip("‘’“”«»„…'`,;:()[].")
    local = re.sub(r"^\{?(\d+|id)\}?\+\{?", "", local) if "noreply" in domain else local
    return (local, domain) if local and domain else None


def is_personal(local: str, domain: str) -> bool:
    return not (local in NO_LOCAL and (domain.count(".") < 2 or local in ("none", "noreply", "root")) or domain in ("none", "localhost") or "localhost" in domain or local in ROLES)


@lru_cache(maxsize=100_000)
def words_of(name: str) -> list[str]:
    """The words of a name part, split at blanks, separators and inner capitals; case is kept."""
    name = re.sub(r"(?<=[a-zа-яß-ÿ])(?=[A-ZА-ЯÀ-Þ][a-zа-яß-ÿ])", " ", name)
    return [w for w in re.split(r"[\s._,;:/+\"'`’‘“”()\[\]{}<>&|]+", name) if w]


_ORG_FIRM = sorted(ORG_WORDS - ORG_LOOSE)


@lru_cache(maxsize=200_000)
def org_word(w: str) -> str:
    """The organisation word that `w` abbreviates, or w."""
    return next((x for x in _ORG_FIRM if x.startswith(w)), w) if len(w) > 3 else w


def org_key(words: list[str]) -> str:
    return "".join(re.sub(r"[^0-9a-zЀ-ӿ]", "", plain(w)) for w in words if plain(w) not in ORG_LOOSE)


def split_joined(word: str, given: frozenset[str]) -> tuple[str, str] | None:
    """(given, surname) of a word that joins a known given name and a surname, longest given name first."""
    for n in range(min(12, len(word) - 4), 2, -1):
        if word[:n] in given:
            return word[:n], word[n:]
    return None


def from_local(local: str, domain: str, given: frozenset[str]) -> tuple[str, str]:
    """(given or initial, surname) that an address's local part tells; empty where it tells none."""
    local = re.sub(r"\d+$", "", local)
    parts = [p for p in re.split(r"[._+-]", local) if p]
    if len(parts) == 2 and "." in local:
        a, b = parts
        if len(b) == 1 and len(a) > 3:
            return b, a
        if len(a) > 1 and len(b) > 3:
            return (b, a) if b in given and a not in given else (a, b)
    if len(parts) == 1 and len(local) > 7:
        got = split_joined(local, given)
        if got:
            return got
    return "", ""


def parse(whole: str | None, name: str | None, mail: str | None, given: frozenset[str]) -> tuple[str, str, str, str, str, str]:
    """(kind, given, surname, mail given, mail surname, address) of an author row.

    kind: `p` person, `o` organisation (its key stands as surname), or empty where the name stands in for none.
    A given name of one letter is an initial. The address is empty unless it is a personal one.
    """
    adr = address(mail) or address(whole if "@" in (whole or "") and not mail else None)
    text = (name or "").strip()
    if not text and whole and "<" in whole:
        text = whole.split("<")[0].strip()
    if "@" in text and _ADDRESS.fullmatch(text.strip("\"' ")):
        own = address(text)
        text = ""
        if own and not is_personal(*own):
            own = None
        g, s = from_local(*own, given) if own else ("", "")
        kind = "p" if s else ""
    else:
        kind, g, s = person(text, given)
    local, domain = adr or ("", "")
    sld = next((p for p in reversed(domain.split(".")[:-1]) if p not in ("dev", "edu", "co", "com")), "")
    org_mail = local in ROLES and sld.endswith(tuple(_ORG_FIRM)) and "-" not in sld
    # What stands behind a person's name - an employer in brackets, behind a comma or an @ - is no part of the name.
    core = re.split(r"\s@\s", re.sub(r"\([^)]*\)|\[[^\]]*\]", " ", text))[0]
    if len(words_of(core.partition(",")[0])) > 1:
        core = core.partition(",")[0]
    words = [plain(w) for w in words_of(core.replace("-", " "))]
    words = words[:1] + [org_word(w) for w in words[1:]]
    joined = org_key(words)
    if kind == "o" or org_mail and (not kind or near(joined, sld) or not s or sld[:4] == joined[:4]):
        return "o", "", sld if org_mail else joined, "", "", ""
    if words and joined.endswith(tuple(_ORG_FIRM)) and (any(w in ORG_WORDS for w in words)):
        return "o", "", joined, "", "", ""
    mg, ms, mine = "", "", ""
    if adr and is_personal(local, domain):
        mine = f"{local}@{domain if 'noreply' not in domain else 'noreply'}"
        mg, ms = from_local(local, domain, given)
    return kind, g, s, mg, ms, mine


def person(text: str, given: frozenset[str]) -> tuple[str, str, str]:
    """(kind, given, surname) of a name part as typed."""
    bare = re.sub(r"\([^)]*\)|\[[^\]]*\]", " ", text)
    if plain(re.sub(r"[^\w]", "", text)) in NO_NAME or not re.search(r"\w", text):
        return "", "", ""
    bare = re.split(r"\s@\s", bare)[0]
    head = bare.partition(",")[0] if len(words_of(bare.partition(",")[0])) > 1 else bare
    flat = [plain(w) for w in words_of(head.replace("-", " "))]
    flat = flat[:1] + [org_word(w) for w in flat[1:]]
    if any(w in ORG_WORDS for w in flat[-2:]) and len(flat) > 1 and not any(w in given for w in flat):
        return "o", "", ""
    left, comma, right = bare.strip(" \"'").partition(",")
    if comma:
        a = [plain(w) for w in words_of(left)]
        b = [plain(w) for w in words_of(right) if plain(w) not in TITLES]
        if len(a) == 1 and b and (len(b[0]) == 1 or b[0] in given or any(one_edit(b[0], x) for x in given if x[:1] == b[0][:1]) or a[0] not in given):
            bare = f"{right} {left}"
        else:
            bare = left
    raw = [w for w in words_of(bare) if plain(w) not in TITLES]
    w = [plain(x) for x in raw]
    w = [x for i, x in enumerate(w) if x and not (0 < i < len(w) - 1 and len(x) == 1)]  # middle initials
    if not w:
        return "", "", ""
    if len(w) == 1:
        got = split_joined(w[0], given)
        return ("p", *got) if got else ("p", "", w[0])
    first, last = w[0], w[-1]
    if len(w) > 2 and len(last) == 1:
        first, last = w[-1], w[0]
    upper_first = raw[0].isupper() and len(raw[0]) > 2 and not raw[-1].isupper()
    if (last in given and first not in given) or (len(last) == 1 and len(first) > 1) or (upper_first and first not in given):
        first, last = last, first
    return "p", first, last


# ------------------------------------------------------------------------------------------------------------ channel


def one_edit(a: str, b: str) -> bool:
    """Are the words equal but for one insertion, deletion, replacement or swap of neighbours?"""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def near(a: str, b: str) -> bool:
    """Within one edit, or two for words of at least nine letters."""
    if one_edit(a, b):
        return True
    if min(len(a), len(b)) < 9 or abs(len(a) - len(b)) > 2:
        return False
    return any(one_edit(x, b) for x in deletions(a)) or any(one_edit(a, x) for x in deletions(b))


def deletions(w: str) -> set[str]:
    return {w[:i] + w[i + 1 :] for i in range(len(w))}


#: What the channel may do to a given name and a surname, with the minus log likelihoods from which learning starts.
PRIOR_COSTS = {"same": 0.1, "none": 4.0, "initial": 1.5, "short": 1.8, "cut": 2.2, "cut to two": 3.2, "typo": 3.5, "surname same": 0.1, "surname typo": 3.5, "surname two typos": 7.0}
#: The prior counts as much as so many observed pairs.
PRIOR_PAIRS = 200


def given_step(variant: str, given: str) -> str | None:
    """What the channel did to write `variant` for `given`; null if it is no spelling of it."""
    if variant == given:
        return "same"
    if not variant:
        return "none"
    if len(variant) == 1:
        return "initial" if given[0] == variant else None
    if given in SHORT.get(variant, "").split():
        return "short"
    if len(given) > len(variant) and given.startswith(variant):
        return "cut" if len(variant) > 2 else "cut to two"
    if len(given) > 3 and len(variant) > 2 and one_edit(variant, given):
        return "typo"
    return None


def surname_step(variant: str, surname: str) -> str | None:
    if variant == surname:
        return "surname same"
    if len(surname) > 4 and one_edit(variant, surname):
        return "surname typo"
    if len(surname) > 8 and near(variant, surname):
        return "surname two typos"
    return None


def given_cost(variant: str, given: str, costs: dict[str, float] = PRIOR_COSTS) -> float | None:
    """Minus log likelihood of typing `variant` for `given`; null if it is no spelling of it."""
    step = given_step(variant, given)
    return None if step is None else costs[step]


def surname_cost(variant: str, surname: str, costs: dict[str, float] = PRIOR_COSTS) -> float | None:
    step = surname_step(variant, surname)
    return None if step is None else costs[step]


def learned_costs(typed: DataFrame) -> dict[str, float]:
    """The channel's costs, estimated from what people type at their own address.

    typed: adr, v (form kind|given|surname), n. At each address the most frequent full form is what was meant, the other
    forms that the channel can make of it are what was typed. Steps are counted on top of the prior.
    """
    full = typed.where(F.col("v").rlike(r"^p\|[^|]{2,}\|"))
    meant = full.groupBy("adr").agg(F.max_by("v", F.struct("n", "v")).alias("h"))
    pairs = typed.where(F.col("v").startswith("p|")).join(meant, "adr").select("h", "v", "n")

    def steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: Counter = Counter()
            for h, v, n in zip(pdf.h, pdf.v, pdf.n):
                (_, hg, hs), (_, g, s) = h.split("|"), v.split("|")
                a, b = given_step(g, hg), surname_step(s, hs)
                if a and b:
                    seen[a] += n
                    seen[b] += n
            yield pd.DataFrame(list(seen.items()), columns=["step", "n"])

    counted = {r["step"]: r["n"] for r in pairs.mapInPandas(steps, "step string, n long").groupBy("step").agg(F.sum("n").alias("n")).collect()}  # a row per step
    costs = {}
    for group in ([k for k in PRIOR_COSTS if k.startswith("surname")], [k for k in PRIOR_COSTS if not k.startswith("surname")]):
        prior = {k: math.exp(-PRIOR_COSTS[k]) for k in group}
        scale = PRIOR_PAIRS / sum(prior.values())
        total = sum(counted.get(k, 0) for k in group) + PRIOR_PAIRS
        costs |= {k: -math.log((counted.get(k, 0) + scale * prior[k]) / total) for k in group}
    return costs


@lru_cache(maxsize=200_000)
def long_forms(given: str) -> frozenset[str]:
    """The word and the given names whose short form it is, or is within one edit of."""
    return frozenset([given]).union(*(full.split() for short, full in SHORT.items() if short == given or len(short) > 3 and one_edit(short, given)))


def same_person(a: tuple[str, str], b: tuple[str, str]) -> bool:
    """May two full names (given, surname) at one address be spellings of one person's, in either order or script?"""

    def given_fits(x: str, y: str) -> bool:
        if min(len(x), len(y)) < 2:
            return x[:1] == y[:1]
        if given_cost(x, y) is not None or given_cost(y, x) is not None or min(len(x), len(y)) > 2 and (x in y or y in x):
            return True
        return any(u == w or min(len(u), len(w)) > 3 and one_edit(u, w) for u in long_forms(x) for w in long_forms(y))

    def surname_fits(x: str, y: str) -> bool:
        return x == y or min(len(x), len(y)) > 4 and near(x, y)

    pairs = [(a, b), (a[::-1], b)]
    if _CYR.search("".join(a)) or _CYR.search("".join(b)):
        pairs += [(tuple(map(skeleton, x)), tuple(map(skeleton, y))) for x, y in pairs]
    return any(surname_fits(x[1], y[1]) and given_fits(x[0], y[0]) for x, y in pairs)


# -------------------------------------------------------------------------------------------------------- the operator

_PARSED = "author_id long, kind string, g string, s string, mg string, ms string, adr string"


def given_names(authors: DataFrame, share: float = 1 / 20_000) -> frozenset[str]:
    """Words that stand before four differently beginning words at least, and before that share of all, in two-word names.

    At most 1 / share words have that, which bounds what is gathered. First names stand before many words and seldom
    behind others. Small tables show few words before four others, so they recognise few given names.
    """

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for name, mail in zip(pdf.getfl, pdf.simpemail):
                w = [plain(x) for x in words_of(name or "")] if "," not in (name or "") and "@" not in (name or "") else []
                if len(w) == 2 and len(w[0]) > 1 and len(w[1]) > 4:
                    out.append((w[0], w[1]))
                adr = address(mail)
                p = adr[0].split(".") if adr else []
                if len(p) == 2 and len(p[0]) > 1 and len(p[1]) > 4:
                    out.append((p[0], p[1]))
            yield pd.DataFrame(out, columns=["a", "b"])

    pairs = authors.select("getfl", "simpemail").mapInPandas(words, "a string, b string").distinct()
    pairs = written(pairs, "name-words")
    first = pairs.groupBy("a").agg(F.countDistinct(F.substring("b", 1, 4)).alias("n"))
    last = pairs.groupBy(F.col("b").alias("a")).agg(F.countDistinct(F.substring("a", 1, 2)).alias("m"))
    n = pairs.count()
    found = first.join(last, "a", "left").where((F.col("n") >= 4) & (F.col("n") >= F.lit(n * share)) & (F.col("n") > 2 * F.coalesce("m", F.lit(0))))
    return frozenset(r["a"] for r in found.select("a").collect())


def parsed(authors: DataFrame, given: frozenset[str]) -> DataFrame:
    """author_id with the parts of `parse`, one row per author row."""
    pairs = {(r["x"], r["y"]): r["c"] for r in count_pairs(authors, ["getfl"]).collect()}  # bounded by the alphabets
    shared = authors.sparkSession.sparkContext.broadcast((given, pairs))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, scores = shared.value[0], PairScores(shared.value[1])

        def sound(mail: str | None) -> str | None:
            return mail if mail is None or mail.isascii() else repair(mail, scores)[1] or mail

        for pdf in batches:
            rows = [(i, *parse(w, n, sound(m), names)) for i, w, n, m in zip(pdf.author_id, pdf.parseauthorid, pdf.getfl, pdf.simpemail)]
            yield pd.DataFrame(rows, columns=["author_id", "kind", "g", "s", "mg", "ms", "adr"])

    return spread(authors.select("author_id", "parseauthorid", "getfl", "simpemail"), "author_id").mapInPandas(work, _PARSED)


def attributed(forms: DataFrame, costs: dict[str, float] = PRIOR_COSTS) -> DataFrame:
    """v, c: each spelling form with its canonical form (of the same kind), by maximum posterior.

    `forms` has v (kind|given|surname) and n (rows). Candidates share the surname, one deletion of it (two for long
    surnames, as each side may lack a letter), or its letters in another script, and the given name's first letter, or
    the whole surname if that letter is mistyped; a spelling is attached to a candidate that is more frequent, or fuller
    at the same frequency. Within a key, candidates are found by prefixes and deletions of the given name and read by
    falling frequency, until no later one can have a larger posterior: not each is compared with each.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[str] = []
            ends = [0]
            for v in batch.column("v").to_pylist():
                kind, g, s = v.split("|")
                firsts = {g[:1]} | {x[0] for x in SHORT.get(g, "").split()}
                near_ = deletions(s) if len(s) > 4 else set()
                out += [f"{kind}{f}|{k}" for k in {s} | near_ for f in firsts]
                if kind == "p" and s and len(g) > 3:
                    out += [f"t{d}|{s}" for d in {g[1:], g[:1] + g[2:], g}]  # another first letter, or the first two swapped
                if kind == "p" and s and g:
                    out.append(f"c{skeleton(g)}|{skeleton(s)}")
                ends.append(len(out))
            of = pa.array(np.repeat(np.arange(len(ends) - 1), np.diff(ends)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column("v").take(of), batch.column("n").take(of)], ["k", "v", "n"])

    # Distinct spellings of one key, not rows: a name that a third of the rows have is one entry.
    keyed = spread(spread(forms.select("v", "n"), "v").mapInArrow(keys, "k string, v string, n long"), "k").sortWithinPartitions("k")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, str, float]] = []
        table = lambda: pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.float64()))], ["v", "c", "score"])
        for key, rows in of_several(batches):
            out += chosen_in(key[0], rows, costs)
            if len(out) > 10_000:
                yield table()
                out = []
        yield table()

    chosen = keyed.mapInArrow(choose, "v string, c string, score double")
    return chosen.groupBy("v").agg(F.max_by("c", F.struct("score", "c")).alias("c"))


def of_several(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, str]]]]:
    """(key, forms (n, v)) of the keys that have several rows, from batches (k, v, n) sorted by k."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column("k")
        starts = np.flatnonzero(np.append(True, pc.not_equal(k.slice(1), k.slice(0, len(k) - 1)).to_numpy(zero_copy_only=False)))
        sizes = np.diff(np.append(starts, len(k)))
        several = sizes > 1
        several[[0, -1]] = True  # the keys at a batch's ends may go on in the next one
        part = batch.filter(pa.array(np.repeat(several, sizes)))
        for x, v, n in zip(*(part.column(c).to_pylist() for c in ("k", "v", "n"))):
            if x != key:
                if len(held) > 1:
                    yield key, held
                key, held = x, []
            held.append((n, v))
    if len(held) > 1:
        yield key, held


#: So many candidates are compared without an index of their given names.
FEW = 8


def chosen_in(key: str, forms: list[tuple[int, str]], costs: dict[str, float]) -> Iterator[tuple[str, str, float]]:
    """(variant, canonical, score) among forms (n, v) that share a key, whose first letter tells its kind."""
    ranked = sorted(((n, len(v), v) for n, v in forms), reverse=True)
    parts = [(n, v, *v.split("|")) for n, _, v in ranked]
    heads = [(n, v, g, s) for n, v, kind, g, s in parts if kind == "o" or len(g) > 1]
    by: dict[str, list[int]] = {}
    if key not in "oc" and len(heads) > FEW:
        for i, (_, _, g, _) in enumerate(heads):
            for x in {f"={g[:i]}" for i in range(len(g) + 1)} | {f"-{d}" for d in deletions(g)}:
                by.setdefault(x, []).append(i)

    def likely(kind: str, g: str) -> Iterable[int]:
        """The candidates whose given name `g` may stand for, by falling frequency."""
        if kind != "p" or key == "c" or len(heads) <= FEW:
            return range(len(heads))
        if len(g) < 2:
            return by.get(f"={g}", [])
        less = deletions(g)
        looks = {f"={x}" for x in {g, *SHORT.get(g, "").split()} | less} | {f"-{x}" for x in {g} | less}
        return sorted({i for x in looks for i in by.get(x, ())})

    for n, v, kind, g, s in parts:
        if key == "c" and not _CYR.search(s):
            continue  # this key only leads from Cyrillic to other letters
        top, others = None, []
        for i in likely(kind, g):
            hn, hv, hg, hs = heads[i]
            if top is not None and math.log(hn) < top[0] and (len(g) > 1 or kind != "p" or any(apart(x, top[2]) for x in others)):
                break  # costs are never negative
            if g in SHORT.get(hg, "").split() or (g != hg and len(hg) > 1 and g.startswith(hg)):
                continue  # the candidate is the shorter form
            vague = kind == "p" and (len(g) <= 1 or hg in SHORT.get(g, "").split() or (hg != g and hg.startswith(g)))
            if hv == v or (hn < n and not vague):
                continue
            if key == "c":
                cost = 1.0 if _CYR.search(s) and not _CYR.search(hs) else None
            else:
                a = 0.0 if kind == "o" else given_cost(g, hg, costs)
                b = surname_cost(s, hs, costs)
                cost = None if a is None or b is None else a + b
                # Two full spellings of equal standing: the longer one, then the first, is canonical.
                if cost is not None and not vague and hn == n and (len(g) > 1 or kind == "o") and (len(hg), hv) <= (len(g), v):
                    cost = None
            if cost is not None:
                others.append(hg)
                top = max(top or (-math.inf, "", ""), (math.log(hn) - cost, hv, hg))
        if top is None or len(g) <= 1 and kind == "p" and any(apart(x, top[2]) for x in others):
            continue  # nobody, or an initial that fits several people
        yield v, top[1], top[0]


def apart(a: str, b: str) -> bool:
    """Is neither given name a spelling of the other?"""
    return given_step(a, b) is None and given_step(b, a) is None


def entities(authors: DataFrame) -> DataFrame:
    """author_id, entity: rows of the same person or organisation have the same entity; others an own one.

    Rows without a name and without a personal address are on their own. Equal rows count as copies. Entities are the
    connected components of rows, canonical forms and personal addresses, found by rounds of minimum labels.
    """
    rows = written(parsed(authors, given_names(authors)), "names-parsed")
    form = lambda kind, g, s: F.concat_ws("|", kind, g, s)
    has = (F.col("s") != "") & (F.col("kind") != "")
    own = F.when(has, form(F.col("kind"), F.col("g"), F.col("s")))
    sent = F.when(F.col("ms") != "", form(F.lit("p"), F.col("mg"), F.col("ms")))
    uses = rows.select("author_id", F.explode(F.array_distinct(F.array_compact(F.array(own, sent)))).alias("v"))
    forms = uses.groupBy("v").agg(F.count("*").alias("n"))
    costs = learned_costs(rows.where(has & (F.col("adr") != "")).groupBy("adr", form(F.col("kind"), F.col("g"), F.col("s")).alias("v")).agg(F.count("*").alias("n")))
    canon = written(attributed(forms, costs), "name-canon")
    # Variants of variants: follow the attribution until it ends, twice as far each round. A variant's canonical form is
    # fuller, or more frequent, or the first of equals, so there are no cycles.
    while True:
        step = canon.alias("a").join(canon.alias("b"), F.col("a.c") == F.col("b.v"), "left").select(
            F.col("a.v").alias("v"), F.coalesce("b.c", "a.c").alias("c"), (F.col("b.c").isNotNull() & (F.col("b.c") != F.col("a.c"))).alias("moved")
        )
        step = written(step, "name-canon")
        discard(canon)
        canon = step
        if step.where("moved").isEmpty():
            break
    canon = canon.select("v", "c")
    at = uses.join(canon, "v", "left").select("author_id", F.coalesce("c", "v").alias("v"))
    full = at.where(F.col("v").rlike(r"^(o\|\||p\|[^|]{2,}\|)"))  # initials and lone words name nobody by themselves
    by_form = full.select("author_id", F.concat(F.lit("f "), "v").alias("k"))
    adr = rows.where("adr <> ''").select("author_id", "adr", F.when(has, form(F.col("kind"), F.col("g"), F.col("s"))).alias("v"))
    typed = written(adr.join(canon, "v", "left").select("author_id", "adr", F.coalesce("c", "v").alias("v")), "name-addresses")
    by_adr = owned(typed, at)
    # A made-up user name goes with its owner from one host to another.
    nick = F.regexp_extract("adr", r"^([a-z]{4,}[_-](?!dev@|io@|bot@)[0-9a-z]{1,3})@", 1)
    by_adr = by_adr.select("author_id", F.explode(F.filter(F.array(F.concat(F.lit("m "), "adr"), F.concat(F.lit("n "), nick)), lambda k: k != "n ")).alias("k"))
    return components(rows.select("author_id"), by_form.unionByName(by_adr))


def owned(typed: DataFrame, known: DataFrame, fair: float = 0.2, tops: int = 64) -> DataFrame:
    """The rows of `typed` (author_id, adr, v) that their address links: all rows of an address that one person has.

    v: the row's canonical form, or null. Only full names tell who has an address; those that may be spellings of one
    of its frequent names count for that one. An address is shared, and links nobody, if two people or more hold at
    least `fair` of its full names each, in two rows or more, or if of three or more nobody holds half. Elsewhere a row
    is left out only if its full name is another's that has most of its rows (`known`: author_id, v) away from the address.
    The `tops` most frequent names of an address are gathered as its people; every name is compared with them.
    """
    counts = written(typed.where(F.col("v").rlike(r"^p\|[^|]{2,}\|")).groupBy("adr", "v").agg(F.count("*").alias("n")), "address-names")
    several = counts.join(counts.groupBy("adr").agg(F.count("*").alias("k")).where("k > 1"), "adr", "left_semi")
    order = F.row_number().over(Window.partitionBy("adr").orderBy(F.desc("n"), "v"))
    top = several.withColumn("at", order).where(F.col("at") <= tops).groupBy("adr").agg(F.collect_list(F.struct("at", "v")).alias("names"))
    split = lambda v: tuple(v.split("|")[1:])

    def people(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for adr, names in zip(pdf.adr, pdf.names):
                heads: list[str] = []
                for x in sorted(names, key=lambda x: x["at"]):
                    if not any(same_person(split(x["v"]), split(h)) for h in heads):
                        heads.append(x["v"])
                out.append((adr, heads))
            yield pd.DataFrame(out, columns=["adr", "heads"])

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            who = [v if v in hs else next((h for h in hs if same_person(split(v), split(h))), v) for v, hs in zip(pdf.v, pdf.heads)]
            yield pd.DataFrame({"adr": pdf.adr, "v": pdf.v, "n": pdf.n, "who": who})

    heads = top.mapInPandas(people, "adr string, heads array<string>")
    assigned = written(several.join(heads, "adr").select("adr", "v", "n", "heads").mapInPandas(assign, "adr string, v string, n long, who string"), "address-people")
    per = assigned.groupBy("adr", "who").agg(F.sum("n").alias("n"))
    total = per.groupBy("adr").agg(F.sum("n").alias("total"), F.count("*").alias("people"), F.max("n").alias("most"), F.max_by("who", F.struct("n", "who")).alias("owner"))
    holders = per.join(total, "adr").where((F.col("n") >= 2) & (F.col("n") >= F.col("total") * fair)).groupBy("adr").agg(F.count("*").alias("holders"))
    judged = total.join(holders, "adr", "left").withColumn("shared", (F.coalesce("holders", F.lit(0)) > 1) | (F.col("people") > 2) & (F.col("most") * 2 < F.col("total")))
    judged = written(judged.select("adr", "owner", "shared"), "address-owners")
    strays = written(assigned.join(judged.where("NOT shared"), "adr").where("who <> owner").select("adr", "v", "n"), "address-strays")
    everywhere = known.join(strays.select("v").distinct(), "v", "left_semi").groupBy("v").agg(F.countDistinct("author_id").alias("all"))
    others = strays.join(everywhere, "v").where(F.col("all") > 2 * F.col("n")).select("adr", "v")
    return typed.join(judged.where("shared"), "adr", "left_anti").join(others, ["adr", "v"], "left_anti")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """author_id, entity: the smallest author_id of the component that `edges` (author_id, k) puts a node in.

    Rows with equal sets of keys are one node at first: they share all their links, so the rounds work on classes, and
    only on keys that several classes have. Labels of a key are combined before the shuffle, and reach the classes of hot
    keys by a bounded broadcast.
    """
    sets = written(edges.groupBy("author_id").agg(F.sort_array(F.collect_set("k")).alias("ks")), "name-sets")
    classes = written(sets.groupBy("ks").agg(F.min("author_id").alias("node"), F.count("*").alias("rows")), "name-classes")
    links = classes.select("node", F.explode("ks").alias("k"))
    links = written(links.join(links.groupBy("k").agg(F.count("*").alias("n")).where("n > 1"), "k", "left_semi"), "name-links")
    label = written(links.select("node", F.col("node").alias("entity")).distinct(), "labels")
    while True:
        low = written(links.join(label, "node").groupBy("k").agg(F.min("entity").alias("low"), F.count("*").alias("links")), "key-labels")
        step = keyed_join(links, low, "k", "links").groupBy("node").agg(F.min("low").alias("low"))
        # Pointer jumping: the label of one's label.
        jump = step.join(label.select(F.col("node").alias("low"), F.col("entity").alias("far")), "low", "left").select("node", F.least("low", F.coalesce("far", "low")).alias("new"))
        new = written(label.select("node", "entity").join(jump, "node").select("node", F.col("new").alias("entity"), (F.col("new") < F.col("entity")).alias("moved")), "labels")
        discard(low, label)
        label = new
        if new.where("moved").isEmpty():
            break
    of = classes.join(label.select("node", "entity"), "node", "left").select("ks", F.coalesce("entity", "node").alias("entity"), "rows")
    mine = keyed_join(sets, of, "ks", "rows")
    return nodes.join(mine.select("author_id", "entity"), "author_id", "left").select("author_id", F.coalesce("entity", "author_id").alias("entity"))


def all_pairs(members: DataFrame, piece: int = 1000) -> DataFrame:
    """author_a, author_b of each pair within an entity. An entity's pairs are spread over a task per `piece` members."""
    size = members.groupBy("entity").agg(F.count("*").alias("n")).where("n > 1").withColumn("k", (F.col("n") / piece).cast("int") + 1)
    m = members.join(size, "entity")
    a = m.select("entity", F.col("author_id").alias("author_a"), F.pmod(F.xxhash64("author_id"), F.col("k")).alias("salt"))
    b = m.select("entity", F.col("author_id").alias("author_b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("k").cast("long") - 1)).alias("salt"))
    return a.join(b, ["entity", "salt"]).where("author_a < author_b").select("author_a", "author_b")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_pairs(written(entities(table(spark, sf_dir, "authors")), "entities"))


def p6_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """author_id, entity for every row."""
    return entities(table(spark, sf_dir, "authors"))


QUERIES = {"p6_found": p6_found, "p6_entities": p6_entities}
SQL: dict[str, str] = {}

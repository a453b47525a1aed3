"""Garbled text from wrong character encoding (problem 5).

Adjacent character pairs are scored by their mutual information in a corpus of names; pairs that the corpus does not
support score low. The maximum-scoring segments of (typical information - pair score) are the improbable runs of a
value; only in these runs inverse mappings are tested. A mapping is accepted if it turns bytes into well-formed
UTF-8, or if it raises the run's mutual information clearly. Marks of lost letters and control characters in a run are
damage beyond repair.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.plans.spread import spread
from stratalog.sources.tables import table

# ----------------------------------------------------------------------------------------------------- fixed values

#: Encodings in which UTF-8 bytes may have been read.
MISREAD_AS = ["cp1252", "latin_1", "cp1250", "iso8859_2", "cp1251", "koi8_r", "cp866", "mac_roman", "cp437", "cp850", "cp1254", "iso8859_15", "cp1253", "mac_cyrillic"]
#: Multi-byte encodings in which UTF-8 bytes may have been read.
MISREAD_AS_WIDE = ["gb18030", "cp932", "big5", "euc_kr", "euc_jp"]
#: (read in, written in) of single-byte mix-ups.
MIXED_UP = [
    ("cp1252", "cp1251"), ("latin_1", "cp1251"), ("latin_1", "koi8_r"), ("cp1252", "koi8_r"), ("latin_1", "iso8859_5"), ("cp1252", "cp866"), ("cp437", "cp866"),
    ("cp1251", "koi8_r"), ("koi8_r", "cp1251"), ("cp1251", "cp866"), ("cp866", "cp1251"), ("koi8_r", "cp866"), ("cp866", "koi8_r"), ("cp1251", "iso8859_5"),
    ("cp1251", "cp1252"), ("cp1251", "cp1250"), ("koi8_r", "cp1252"), ("cp866", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp437", "cp1252"), ("cp850", "cp1252"),
    ("cp1252", "cp437"), ("cp1252", "cp850"), ("mac_cyrillic", "cp1251"), ("cp1251", "mac_cyrillic"), ("cp1253", "cp1252"), ("cp1252", "cp1253"),
]
#: Punctuation that repaired text may hold besides letters and digits.
PLAUSIBLE = set("‘’“”«»„‚–—…·•'\"-_. ‹›")

#: Letters whose marks Unicode doesn't separate.
UNMARKED = {"ø": "o", "Ø": "o", "ł": "l", "Ł": "l", "ß": "s", "æ": "a", "Æ": "a", "ı": "i", "đ": "d", "Đ": "d", "œ": "o", "Œ": "o"}

_LETTER = re.compile(r"[^\W\d_]")
_UTF8 = re.compile("[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")


# ---------------------------------------------------------------------------------------------------- pair statistics


@lru_cache(maxsize=65536)
def fold(ch: str) -> str:
    """The symbol that stands for a character in pair statistics.

    Letters stand for themselves without case and marks, CJK and Hangul for their script, digits for 0, separators
    for a dot, other characters for their category. So the number of symbols is bounded by the alphabets' letters.
    """
    if ch.isdigit() and ch.isascii():
        return "0"
    if ch in " ._-+@'\t,()[]\"" or ch in PLAUSIBLE:
        return "."
    if ch in UNMARKED:
        return UNMARKED[ch]
    if not ch.isalpha():
        return unicodedata.category(ch)
    o = ord(ch)
    if 0x2E80 <= o <= 0x9FFF and not 0x3040 <= o <= 0x30FF or 0x20000 <= o <= 0x3FFFF or 0xF900 <= o <= 0xFAFF:
        return "漢"
    if 0xAC00 <= o <= 0xD7AF:
        return "한"
    if o >= 0xFF00:
        return "Lo"
    return unicodedata.normalize("NFD", ch.lower())[0]


@lru_cache(maxsize=65536)
def script(sym: str) -> str:
    """Coarse class of a symbol: its script for letters, itself for `0` and `.`, else `sign`."""
    if sym in "0.^$":
        return sym
    if len(sym) > 1:
        return "sign"
    if sym.isascii():
        return "LATIN"
    return unicodedata.name(sym, "X").split(" ")[0]


def symbols(text: str) -> list[str]:
    return ["^", *map(fold, text), "$"]


class PairScores:
    """Pointwise mutual information of adjacent symbols, backed off to the classes of the symbols."""

    def __init__(self, pairs: dict[tuple[str, str], int]) -> None:
        self.n = sum(pairs.values()) or 1
        self.pairs, self.left, self.right = pairs, Counter(), Counter()
        self.cpairs: Counter = Counter()
        self.cleft: Counter = Counter()
        self.cright: Counter = Counter()
        for (x, y), c in pairs.items():
            self.left[x] += c
            self.right[y] += c
            a, b = script(x), script(y)
            self.cpairs[a, b] += c
            self.cleft[a] += c
            self.cright[b] += c
        self.mean = sum(c * self.of(x, y) for (x, y), c in pairs.items()) / self.n  # the corpus's mutual information
        self.cache: dict[tuple[str, str], float] = {}
        self.read: dict[str, list[str]] = {}  # of other_readings
        self.gain: dict[tuple[str, bool, bool], list[tuple[float, str]]] = {}  # of gains

    def of(self, x: str, y: str) -> float:
        """Information of the pair; a pair of foreign classes or with an unknown symbol is far below 0."""
        a, b = script(x), script(y)
        k = 0.1
        cls = math.log((self.cpairs.get((a, b), 0) + k) * (self.n + 2 * k) / ((self.cleft.get(a, 0) + 2 * k) * (self.cright.get(b, 0) + 2 * k)))
        if a == "sign" or b == "sign":
            return min(cls, -4.0)
        if x in "漢한" or y in "漢한":
            return 0.0  # these symbols stand for thousands of letters and tell nothing
        if not (self.cleft.get(a, 0) and self.cright.get(b, 0)):
            return -4.0
        if a != b and "." not in (a, b) and "0" not in (a, b) and not {"^", "$"} & {a, b}:
            return min(cls, -4.0) if self.cpairs.get((a, b), 0) < 0.2 * min(self.cleft.get(a, 0), self.cright.get(b, 0)) + 1 else cls
        lx, ry = self.left.get(x, 0), self.right.get(y, 0)
        expected = (lx + 0.5) * (ry + 0.5) / self.n
        return max(-3.5, min(3.0, math.log((self.pairs.get((x, y), 0) + 0.3 * min(1, expected) + 0.02) / (expected + 0.3))))

    def score(self, x: str, y: str) -> float:
        got = self.cache.get((x, y))
        if got is None:
            got = self.cache[x, y] = self.of(x, y)
        return got

    def known(self, ch: str) -> bool:
        """May repaired text hold this character?"""
        x = fold(ch)
        return x in "漢한" or ch in PLAUSIBLE or self.left.get(x, 0) > 0 or script(x) in ("HIRAGANA", "KATAKANA")

    def total(self, text: str, begins: bool = True, ends: bool = True) -> float:
        """Information of the text's pairs, with the borders of the value where the text begins or ends it."""
        s = symbols(text)[0 if begins else 1 : None if ends else -1]
        return sum(self.score(a, b) for a, b in zip(s, s[1:]))


def count_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """x, y, c: adjacent symbols of all values of `columns`, each row counted. At most as many rows as pairs of symbols."""
    cols = df.select(*columns)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            for c in columns:
                for text in pdf[c]:
                    if isinstance(text, str) and "�" not in text:
                        s = symbols(text)
                        seen.update(zip(s, s[1:]))
        yield pd.DataFrame([(x, y, c) for (x, y), c in seen.items()], columns=["x", "y", "c"])

    return cols.mapInPandas(count, "x string, y string, c long").groupBy("x", "y").agg(F.sum("c").alias("c"))


# ------------------------------------------------------------------------------------------------------ runs, mappings


def improbable_runs(text: str, scores: PairScores) -> list[tuple[int, int]]:
    """The maximal segments of characters whose pairs carry less information than is typical (Ruzzo and Tompa 1999).

    Segments that hold neither a question mark nor a character beyond ASCII are left out, and a segment is widened to
    the whole of the beyond-ASCII characters at its ends.
    """
    s = symbols(text)
    gain = [scores.mean - scores.score(a, b) for a, b in zip(s, s[1:])]
    stack: list[list[float]] = []  # [start, end, sum before, sum after]
    total = 0.0
    for i, g in enumerate(gain):
        before, total = total, total + g
        if g <= 0:
            continue
        seg = [i, i + 1, before, total]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= seg[2]:
                j -= 1
            if j < 0 or stack[j][3] >= seg[3]:
                stack.append(seg)
                break
            seg = [stack[j][0], seg[1], stack[j][2], seg[3]]
            del stack[j:]
    out: list[tuple[int, int]] = []
    for a, b, *_ in stack:
        lo, hi = max(0, int(a) - 1), min(len(text), int(b) + 1)
        while lo > 0 and not text[lo - 1].isascii():
            lo -= 1
        while hi < len(text) and not text[hi].isascii():
            hi += 1
        if text[lo:hi].isascii() and "?" not in text[lo:hi]:
            continue
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


@lru_cache(maxsize=None)
def byte_table(enc: str) -> dict[str, str]:
    """Character -> byte (as a Latin-1 character) of a single-byte encoding; undefined bytes map to themselves."""
    t = {}
    for b in range(0x80, 0x100):
        try:
            t[bytes([b]).decode(enc)] = chr(b)
        except UnicodeDecodeError:
            t[chr(b)] = chr(b)
    return t


_CP1252 = byte_table("cp1252")


class _Bytes(dict):
    """Translation of characters to bytes (as Latin-1 characters); what an encoding lacks becomes U+FFFD."""

    def __missing__(self, code: int) -> int:
        return 0xFFFD


@lru_cache(maxsize=None)
def _translation(enc: str) -> _Bytes:
    return _Bytes({i: i for i in range(0x80)} | {ord(ch): ord(b) for ch, b in byte_table(enc).items()})


def as_bytes(text: str, enc: str) -> str:
    """The bytes of `text` in a single-byte encoding, as Latin-1 characters."""
    return text.translate(_translation(enc))


def _letters_misread(run: str, a: int, b: int, ch: str, scores: PairScores) -> bool:
    """Are the letters run[a:b] the bytes of `ch`? Letters may well be what was meant, so the context must speak for it."""
    near = run[max(0, a - 2) : a], run[b : b + 2]
    gain = scores.total(near[0] + ch + near[1]) - scores.total(near[0] + run[a:b] + near[1])
    odd_case = run[a].isupper() and any(x.islower() for x in near[0][-1:] + near[1][:1])
    return gain > 2.0 or (odd_case and gain > -4.0 and script(fold(run[a])) == script(fold(ch)))


_NEAR_ASCII = re.compile(r"[^\x00-\x7f]{2}")


def wide_readings(run: str, enc: str) -> list[tuple[int, int, str]]:
    """(start, end, text) of the longest stretches of characters whose bytes in a multi-byte encoding are UTF-8 of `text`."""
    out, starts, raw = [], {}, []
    at = 0
    if not _NEAR_ASCII.search(run):
        return out
    for i, ch in enumerate(run + " "):  # a character that is ASCII or that the encoding lacks ends a stretch
        code = b"" if ch.isascii() else ch.encode(enc, "ignore")
        if code:
            starts[at] = i
            raw.append(code.decode("latin_1"))
            at += len(code)
            continue
        starts[at] = i
        joined = "".join(raw)
        found = [m.span() for m in _UTF8.finditer(joined)] if len(raw) > 1 else []
        begins, ends = [x for x, _ in found], [y for _, y in found]
        first = None
        for k, (x, y) in enumerate(zip(begins, ends)):  # sequences that follow each other, from and to a character's border
            if k and x != ends[k - 1]:
                first = None
            if first is None and x in starts:
                first = x
            if first is not None and y in starts and (k + 1 == len(begins) or begins[k + 1] != y or not any(z in starts for z in ends[k + 1 :])):
                try:
                    out.append((starts[first], starts[y], joined[first:y].encode("latin_1").decode("utf-8")))
                except UnicodeDecodeError:
                    pass
                first = None
        starts, raw, at = {}, [], 0
    return out


def undo_utf8(run: str, scores: PairScores) -> str | None:
    """The run with well-formed UTF-8 that was read in another encoding put right, or null where there is none."""
    best = None
    if not _NEAR_ASCII.search(run):
        return None  # a sequence has two bytes at least, none of them ASCII
    raws = {enc: raw for enc in MISREAD_AS if _UTF8.search(raw := as_bytes(run, enc))}
    for raw in raws.values():  # the whole run, without anything left over
        try:
            new = raw.encode("latin_1").decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            continue
        if new != run and all(ch.isascii() or scores.known(ch) or ch in _CP1252 for ch in new) and not run.isalpha():
            return new
    for raw in raws.values():
        done, last, out = 0, 0, []
        for m in _UTF8.finditer(raw):
            try:
                ch = m[0].encode("latin_1").decode("utf-8")
            except UnicodeDecodeError:
                continue
            # A control character or sign in the result may be a step of repeated damage: what cp1252 reads a byte as.
            if not scores.known(ch) and not ("\x80" <= ch <= "\xff" or ch in _CP1252):
                continue
            was = run[m.start() : m.end()]
            if was.isalpha() and not _letters_misread(run, m.start(), m.end(), ch, scores):
                continue
            out += [run[last : m.start()], ch]
            last, done = m.end(), done + m.end() - m.start()
        if done and (best is None or done > best[0]):
            best = (done, "".join(out) + run[last:])
    for enc in MISREAD_AS_WIDE:
        for lo, hi, text in wide_readings(run, enc):  # one character tells too little
            if hi - lo > 1 and (best is None or hi - lo > best[0]) and all(map(scores.known, text)):
                best = (hi - lo, run[:lo] + text + run[hi:])
    return best[1] if best else None


def other_readings(run: str, scores: PairScores) -> list[str]:
    """What the run may have been before a mix-up of encodings, in the order of MIXED_UP. Most runs are a letter or two, so they are kept."""
    if (known := scores.read.get(run)) is not None:
        return known
    raws, letters, out = {}, sum(map(str.isalpha, run)), {}
    for read, wrote in MIXED_UP:
        if read not in raws:
            raws[read] = as_bytes(run, read)
        raw = raws[read]
        if "\ufffd" in raw:
            continue
        try:
            new = raw.encode("latin_1").decode(wrote)
        except UnicodeDecodeError:
            continue
        if new == run or sum(map(str.isalpha, new)) < letters:
            continue  # letters are not what a mix-up of encodings makes of signs
        if all(scores.known(ch) for ch in new if not ch.isascii()):
            out[new] = None
    if len(scores.read) > 100_000:
        scores.read.clear()
    scores.read[run] = list(out)
    return scores.read[run]


def gains(text: str, lo: int, hi: int, scores: PairScores) -> list[tuple[float, str]]:
    """(information gained, reading) of the other readings of text[lo:hi]; kept, as they hang on the neighbours only."""
    near, begins, ends = slice(max(0, lo - 1), hi + 1), lo < 1, hi + 1 > len(text)
    key = (text[near], begins, ends)
    if (known := scores.gain.get(key)) is not None:
        return known
    news = other_readings(text[lo:hi], scores)
    information = scores.total(text[near], begins, ends) if news else 0.0
    if len(scores.gain) > 100_000:
        scores.gain.clear()
    scores.gain[key] = [(scores.total(text[near.start : lo] + new + text[hi : near.stop], begins, ends) - information, new) for new in news]
    return scores.gain[key]


def undo_mixup(text: str, a: int, b: int, scores: PairScores, margin: float) -> str | None:
    """The text with text[a:b] read in the encoding that raises the information most, if by at least `margin`.

    The run is tried whole and in each of its stretches beyond ASCII, as only part of it may be damaged.
    """
    best, found = margin, None
    lower = not any(map(str.isupper, text))
    beyond = [i for i, ch in enumerate(text) if not ch.isascii()]
    pieces = {(a, b), (beyond[0], beyond[-1] + 1)} | {(m.start() + a, m.end() + a) for m in re.finditer(r"[^\x00-\x7f]+", text[a:b])} | {(i, i + 1) for i in range(a, b) if not text[i].isascii()}
    for lo, hi in sorted(pieces, key=lambda x: (x[0] - x[1], x)):
        if hi - lo == 1 and found is not None:
            break  # single characters only where no stretch is a mix-up
        run = text[lo:hi]
        if all(ch.isascii() or ch in PLAUSIBLE for ch in run):
            continue
        word = None
        for gain, new in gains(text, lo, hi, scores):
            if lower and gain <= best:
                continue  # the case of a text without upper-case letters costs nothing
            if word is None:  # the words that the piece lies in, and what their case costs; it can cost no less than 0
                left, right = lo, hi
                while left > 0 and _LETTER.match(text[left - 1]):
                    left -= 1
                while right < len(text) and _LETTER.match(text[right]):
                    right += 1
                word = (left, right, case_cost(text[left:right]))
            if gain - word[2] <= best:
                continue
            gain += case_cost(text[word[0] : lo] + new + text[hi : word[1]]) - word[2]
            if gain > best:
                best, found = gain, text[:lo] + new + text[hi:]
    return found


def case_cost(text: str) -> float:
    """Upper-case letters beyond ASCII beside lower-case ones cost, as a mix-up within one script changes case."""
    cost = 0.0
    for word in re.findall(r"[^\W\d_]+", text):
        low = sum(ch.islower() for ch in word)
        up = sum(ch.isupper() for ch in word[1:])
        if low and up:
            cost -= 4.5 * min(low, up)
        elif up and not low and not word.isascii():
            cost -= 0.3 * len(word)
    return cost


def lost_in(text: str, a: int, b: int) -> bool:
    """Does the run text[a:b] hold marks that stand for lost letters: U+FFFD, or a question mark beside a letter or digit?"""
    return "�" in text[a:b] or re.search(r"\w\?|\?\w", text[a:b]) is not None


def broken_in(text: str, a: int, b: int) -> bool:
    """Does the run hold control, private or unassigned characters?"""
    return any(unicodedata.category(ch) in ("Cc", "Co", "Cn") and not ch.isspace() for ch in text[a:b])


def repair(text: str, scores: PairScores, margin: float = 4.0) -> tuple[bool, str | None]:
    """(damaged?, original or null if it can't be restored).

    Only improbable runs are looked at: for marks of lost letters, and for inverse mappings. Values damaged several times
    are repaired layer by layer, as long as a run can be put right: reading UTF-8 shortens the value, undoing a mix-up
    raises its information, so that ends. Empty text is not damaged.
    """
    runs = improbable_runs(text, scores)
    lost = any(lost_in(text, a, b) for a, b in runs)
    hurt = lost or any(broken_in(text, a, b) for a, b in runs)
    if text.isascii():
        return lost, None
    now, moved = text, True
    while moved:
        moved = False
        for a, b in reversed(runs):
            fixed = undo_utf8(now[a:b], scores) if not now[a:b].isascii() else None
            if fixed is not None and fixed != now[a:b]:
                now, moved = now[:a] + fixed + now[b:], True
        if not moved and not lost:
            for a, b in runs:  # these mappings keep the length
                step = undo_mixup(now, a, b, scores, margin) if not now[a:b].isascii() else None
                if step is not None and step != now:
                    now, moved = step, True
        if moved:
            hurt = True
            runs = improbable_runs(now, scores)
    whole = not lost and now != text and not any(broken_in(now, a, b) for a, b in runs)
    return hurt, now if hurt and whole else None


# ------------------------------------------------------------------------------------------------------- the operator


def damaged(df: DataFrame, key: str, column: str, corpus: DataFrame, corpus_columns: list[str], margin: float = 4.0) -> DataFrame:
    """key, damaged value, restored value (null if lost) of the rows whose `column` was decoded wrongly.

    Pair statistics come from all values of `corpus_columns` of `corpus`. They are gathered, as their size is bounded
    by the squared number of letters of the alphabets in use, not by the rows. Null values are not damaged.
    """
    pairs = {(r["x"], r["y"]): r["c"] for r in count_pairs(corpus, corpus_columns).collect()}
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(pairs)
    rows = df.select(F.col(key).alias("k"), F.col(column).alias("v")).where(F.col("v").rlike(r"[^\x00-\x7F]|\?"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores = PairScores(shared.value)
        done: dict[str, tuple[bool, str | None]] = {}
        for pdf in batches:
            out = []
            for k, v in zip(pdf.k, pdf.v):
                if v not in done:
                    if len(done) > 100_000:
                        done.clear()
                    done[v] = repair(v, scores, margin)
                if done[v][0]:
                    out.append((k, v, done[v][1]))
            yield pd.DataFrame(out, columns=["k", "v", "r"])

    got = spread(rows, "k").mapInPandas(work, "k long, v string, r string")
    return got.select(F.col("k").alias(key), F.col("v").alias(column), F.col("r").alias("restored"))


def p5_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """author_id, simpemail, restored: the damaged addresses; the corpus are the name parts."""
    authors = table(spark, sf_dir, "authors")
    return damaged(authors, "author_id", "simpemail", authors, ["getfl"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_restored(spark, sf_dir).select("author_id")


def p5_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """author_id: damaged addresses that hold U+FFFD, which no mapping restores: none is missed, none restored."""
    return p5_restored(spark, sf_dir).where(F.col("simpemail").contains("\ufffd") & F.col("restored").isNull()).select("author_id")


QUERIES = {"p5_found": p5_found, "p5_restored": p5_restored, "p5_lost": p5_lost}
SQL = {"p5_lost": "SELECT author_id FROM authors WHERE contains(simpemail, chr(65533))"}

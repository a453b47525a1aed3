"""Sentence boundaries across languages and scripts: cascading segmentation rule tables (problem 9).

A table is an ordered list of rules; a rule is (break?, pattern before the position, pattern after it). The layout table
cuts a text into one-unit lines and paragraphs, its first matching row deciding each line. At every candidate position of
a paragraph the table of places is read first (within an enclosure or address, or behind an enclosure that stands alone),
then the rules of the document's language, of all other languages, and the common ones; the first rule whose two patterns
match decides. Patterns before a position are matched backwards from it and see the whole unit so far. Documents mix
languages, so the other tables stay in the cascade after the document's own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.plans.lineage import written
from stratalog.plans.spread import spread
from stratalog.sources.tables import table

Rule = tuple[bool, str, str]
NO, YES = False, True

# ------------------------------------------------------------------------------------------------- fixed values: tables

#: Patterns: a closing mark run; what may close after it; words.
_W = r"(?:^|[\s(\[{\"“„«'’—–-])"

#: Abbreviations that never end a sentence before a word or number, per language.
_NEVER = {
    "en": "Mr Mrs Ms Dr Prof St Sr Jr Gen Sen Rep Fig Figs Sec Eq Ch vs cf e\\.g i\\.e resp approx esp incl viz al Jan Feb Mar Apr Jun Jul Aug Sept Sep Oct Nov Dec",
    "de": "Dr Prof Hr Fr Nr Abs Art Bd Bl S z d u bzw ca vgl ggf evtl inkl bspw sog zzgl St Str Kap Abb Tab",
    "fr": "M MM Mme Mlle Dr Pr p pp cf art chap fig env éd vol n°",
    "es": "Sr Sra Srta Dr Dra Ud Uds núm pág págs p ej art cap fig aprox vol EE",
    "ru": "г-н г-жа т е напр стр рис См см табл гл им ул проф акад тыс млн млрд",
    "el": "κ κκ Βλ βλ σελ π\\.χ αρ εικ κεφ δηλ",
    "ar": "د أ م ص",
    "hi": "डॉ श्री पृ",
    "ko": "",
    "am": "",
    "hy": "",
    "zh": "",
    "ja": "",
    "th": "",
}
#: Abbreviations that may also end a sentence: before a lower-case word they do not.
_LOWER = {
    "en": "Inc Ltd Co Corp Bros sec min hr Ph\\.D",
    "de": "Sek Min Std Mio Mrd Tsd Jh",
    "fr": "ex s sec min",
    "es": "UU seg min S\\.A Cía",
    "ru": "г гг дн с руб ч мин сек др пр",
    "el": "δευτ λεπ μ\\.μ π\\.μ",
}
#: Abbreviations that end a sentence unless a word follows that carries it on.
_OPEN = {
    "en": ("etc U\\.S U\\.K a\\.m p\\.m", "are is was were and or but in on of for with to have has had will can may must that which mirror"),
    "de": ("usw", "folgt folgen ist sind war wird werden und oder als zu im in"),
    "fr": ("etc", "sont est et ou dans de pour avec"),
    "es": ("etc", "son es y o en de para con"),
    "ru": ("т\\. ?д т\\. ?п", "и или в на для с до были есть"),
    "el": ("κ\\.λπ κτλ", "και ή σε για με"),
}
#: Verbs that carry on a sentence whose beginning was a quotation.
_SAID = "was were is are said says wrote writes asked then and but disait dit écrit demande decía dice dijo escribe steht schrieb sagte heißt und так написано сказал пишет και είπε ثم"
#: Abbreviations before numbers.
_NUMBER = {
    "en": "No no vol Vol p pp Part ch v ver sec Sec art",
    "fr": "no n art vol",
    "es": "No n vol",
}
def _alt(words: str) -> str:
    return "(?:" + "|".join(sorted(words.split(), key=len, reverse=True)) + ")"


def _alt2(words: str) -> str:
    """As _alt, for words that hold an optional blank, written `. ?`."""
    return "(?:" + "|".join(w.replace("\0", " ?") for w in words.replace(" ?", "\0").split()) + ")"


def _language(lang: str) -> list[Rule]:
    rules: list[Rule] = []
    if lang == "en":
        rules += [
            (NO, r"\b[Pp]art \d+\.", r"\s+of\b"),
            (YES, r"\b(?:to|in|from|of) the U\.[SK]\.", r"\s"),
            (YES, r"\b(?:etc|U\.S|U\.K|a\.m|p\.m)\.", r"\s+(?:[a-z]\.[A-Z]|[a-z][\w-]*\(\d)"),
        ]
    if lang == "de":
        rules += [
            (NO, rf"{_W}(?:[zZ]\. ?B|[dD]\. ?h|[uU]\. ?a|[oO]\. ?ä|[vV]\. ?a|[iI]\. ?d\. ?R|[sS]\. ?o)\.", r"\s"),
            (NO, r"(?:^|[\s(„])(?:[Aa]m|[Vv]om|[Zz]um|[Bb]is|[Dd]ie|[Dd]er|[Dd]as|[Dd]em|[Dd]en|[Dd]es|[Ii]m|[Ss]eit|[Aa]b|[Uu]nd)\s+\d{1,2}\.", r"\s+\w"),
            (NO, r"\b\d{1,2}\.", r"\s+(?:Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember)\b"),
        ]
    if lang == "ja":
        rules += [(NO, r"[。！？!?…][」』）)”]+", r"(?:と|は|が|を|に|の|で|も|や|って|など|から|まで)")]
    if lang == "zh":
        rules += [(NO, r"[。！？!?…][”」』]+", r"(?:这句|这话|这样|的|是|，|、|；|写|说|就|也|并|之|等)")]
    if lang == "hi":
        rules += [(NO, r"[।.!?][\"”]+", r"\s+\S+\s+में\s+लिखा")]
    if lang == "ar":
        rules += [(NO, r"[.!?؟][»\"”]+", r"\s+(?:ثم|وأغلق|وقال|فقال)\b")]
    if lang == "el":
        rules += [(YES, r"[Ͱ-Ͽἀ-῿][^;.!\n]*;[»”\")]*", r"\s")]
    if lang == "th":
        rules += [
            (NO, r"", r"\s+[(（\[]"),
            (NO, r"", r"\s+(?:และ|จึง|หรือ|แต่|เพราะ|ซึ่ง|ที่|ใน|จาก|วัด|หยุด|รายการ|วินาที|นาที|น\.|ก่อน|หลัง|เมื่อ|โดย|เป็น|ครั้ง|ของ|กับ|ถึง|ๆ)"),
            (YES, r"[ก-๛]", r"\s+[ก-๛]"),
            (YES, r"[)）]", r"\s+[ก-๛]"),
            (YES, r"[^\s]", r"\s+(?:รุ่น|คุณ|ทำไม|โปรด|อย่า|แพตช์|ไฟล์|งาน|ตัว|ใคร|เรา|ผม|การ|ระบบ|คำสั่ง|ดู|กรุณา|ยัง)"),
            (YES, r"[ก-๛)]", r"\s+[A-Z][A-Za-z]*\s+[A-Za-z]+\s"),
            (NO, r"[^.!?…。！？؟।։።]", r"\s"),
        ]
    if lang in _OPEN:
        shorts, on = _OPEN[lang]
        rules += [(NO, rf"{_W}{_alt2(shorts)}\.", rf"\s+{_alt(on)}\b"), (YES, rf"{_W}{_alt2(shorts)}\.", r"\s")]
    if _NUMBER.get(lang):
        rules.append((NO, rf"{_W}{_alt(_NUMBER[lang])}\.", r"\s+[#№]?\d"))
    if _NEVER.get(lang):
        rules.append((NO, rf"{_W}(?:l’|d’)?{_alt(_NEVER[lang])}\.", r"\s+[\w.\"„«“(/]"))
        rules.append((NO, rf"\A\W*(?i:{_alt(_NEVER[lang])})\.", r"\s+\w"))  # a sentence may begin in lower case
    if _LOWER.get(lang):
        rules.append((NO, rf"(?:{_W}|\d){_alt(_LOWER[lang])}\.", r"\s+[^\W\d_A-ZÀ-ÖØ-ÞΑ-ΩЀ-Я]"))
        rules.append((YES, rf"(?:{_W}|\d){_alt(_LOWER[lang])}\.", r"\s"))
    return rules


#: Semicolons end a question in Greek only; read before all languages.
_FIRST: list[Rule] = [(NO, r";", r"\S|\Z"), (NO, r"\A[^Ͱ-Ͽἀ-῿]*;", r"")]

_COMMON: list[Rule] = [
    (NO, rf"{_W}(?:[^\W\d_]\.\s?)*[A-ZА-ЯΑ-ΩÀ-Þ]\.", r"\s+(?:[A-ZА-ЯΑ-ΩÀ-Þ][\w’'-]|[A-ZА-ЯΑ-Ω]\.)"),  # initials
    (NO, r"\A\W*[^\W\d_]\.", r"\s+[A-ZА-ЯΑ-ΩÀ-Þ]"),
    (NO, r"", r"\s+[—–]\s"),
    (NO, r"", r"\s*[,;:，、；：]"),
    (NO, r"[.!?…][\"”»“’」』]*[)）\]]", r"\s+[a-zß-öø-ÿа-яёα-ωά-ώա-ֆ]"),  # and a parenthesis likewise
    (NO, r"[\"”»“’」』]", r"\s+[a-zß-öø-ÿа-яёα-ωά-ώա-ֆ]"),  # a quotation within a sentence that goes on
    (YES, r"[。！？…।॥։።][\"”»“’」』）)\]]*", r""),
    (YES, r"[^\W\d_]\s?[!?؟]+", r"[^\W\d_]"),  # the blank between two sentences is missing
    (YES, r"", r"\s"),
    (NO, r"", r""),
]

LANGUAGES = ["en", "de", "fr", "es", "ru", "el", "ar", "hi", "ko", "am", "hy", "zh", "ja", "th"]


class Table:
    """Compiled rules in the order in which they are tried."""

    def __init__(self, rules: list[Rule]) -> None:
        self.rules = [(b, regex.compile(f"(?r)(?:{x})", regex.S) if x else None, re.compile(y)) for b, x, y in rules]
        self.open = [r for r in self.rules if r[1] is None]
        self.any = regex.compile("(?r)" + "|".join(f"(?:{x})" for _, x, _ in rules if x), regex.S)

    def breaks(self, before: str, text: str, at: int) -> bool:
        """What the first rule says that matches the end of `before`, and `text` from `at` on; no rule, no break."""
        for brk, x, y in self.rules if self.any.match(before) else self.open:
            if y.match(text, at) and (x is None or x.match(before)):
                return brk
        return NO


@lru_cache(maxsize=None)
def cascade(lang: str) -> Table:
    """The rules for positions behind a full stop in a document of `lang`."""
    order = ([lang] if lang in LANGUAGES else []) + [x for x in LANGUAGES if x not in (lang, "th")]
    return Table(_FIRST + [r for x in order for r in _language(x)] + _COMMON)


@lru_cache(maxsize=None)
def marks(lang: str) -> Table:
    """The rules for positions that no full stop precedes: the document's own language and the common ones."""
    own = [r for x in LANGUAGES if x in {lang, "ja", "zh", "hi"} for r in _language(x)] if lang != "th" else [r for x in ("th", "ja", "zh", "hi") for r in _language(x)]
    return Table(_FIRST + own + _COMMON)


# ------------------------------------------------------------------------------------------------------ layout, spans

#: (kind, kinds of line that it doesn't follow, pattern): the first row that fits decides what a line is.
_LAYOUT = [
    ("blank", (), r"\s*\Z"),
    ("code", (), r"(?: {4}|\t)[ \t]*\S"),
    ("heading", (), r"[ \t]{0,3}(?:#{1,6}|={1,6})[ \t]+\S"),
    ("item", (), r"[ \t]{0,3}[-*•+‣◦][ \t]+\S"),
    ("item", ("prose",), r"[ \t]{0,3}\d{1,3}[.)][ \t]+\S"),
    ("trailer", (), r"(?:[A-Z][A-Za-z]*(?:-[A-Za-z]+)+|Cc|CC|Fixes|Closes|Refs|Link|Bug|Issue|See): \S"),
    ("prose", (), r""),
]
_LINES = [(kind, after, re.compile(x)) for kind, after, x in _LAYOUT]
_URL = re.compile(r"[a-z]+://[^\s，。、；！？（）「」“”を]+")
_WIDE = "。！？…।॥։።"
_QUOTES = {"(": ")", "（": "）", "[": "]", "「": "」", "『": "』", "«": "»", "„": "“", "“": "”", "【": "】"}
_ENCLOSERS = re.compile(r"[()（）\[\]「」『』«»„“”\"【】]")
_CANDIDATE = re.compile(r"[.!?…](?:[.!?…\"”“’»)\]）」』】]|\s»)*。?|[。！？][。！？…\"”“’»)\]）」』】]*|[؟։።।॥;][.!?…\"”“’»)\]]*")
#: Rules by place: `inside` an enclosure, in an address (`url`), behind an enclosure that is all there is of the unit
#: (`alone`). A place without a deciding rule leaves the position to the language tables.
_PLACES: dict[str, list[Rule]] = {
    "inside": [(NO, r"", r"")],
    "url": [(NO, r"", r"")],
    "alone": [
        (YES, r"[)）]", r"\s"),
        (NO, r"[^\]】]", rf"\s+(?:{_alt(_SAID)}\b|[—–,-])"),
        (NO, r"[^\]】]", r"\s+\S+\s+(?:में\s+लिखा|ይላል)"),
        (YES, r"[^\]】]", r"\s"),
    ],
}
_PLACED = {place: [(b, re.compile(x), re.compile(y)) for b, x, y in rules] for place, rules in _PLACES.items()}
_SPACE = re.compile(r"\s+")
_SCRIPTS = [("th", "ก-๛"), ("zh", "一-鿿"), ("ja", "぀-ヿ"), ("ko", "가-힣"), ("el", "Ͱ-Ͽ"), ("ru", "Ѐ-ӿ"), ("ar", "؀-ۿ"), ("hi", "ऀ-ॿ"), ("am", "ሀ-፿"), ("hy", "԰-֏")]
_SCRIPT_RE = {k: re.compile(f"[{v}]") for k, v in _SCRIPTS}


def language_of(lang: str | None, text: str) -> str:
    """A two-letter language: the given one if it is known, else what the text's script suggests."""
    code = (lang or "").strip().lower()[:2]
    if code in LANGUAGES and (lang or "").strip().lower() != "und":
        return code
    counts = {k: len(r.findall(text)) for k, r in _SCRIPT_RE.items()}
    if counts["ja"]:
        counts["ja"] += counts["zh"]
    best = max(counts, key=counts.get)
    return best if counts[best] * 5 > len(text) * 0.5 else "en"


def blocks(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, prose?): the layout table's cut of a text into paragraphs and one-unit lines."""
    pos, para, prev = 0, None, "blank"
    for line in text.split("\n"):
        end = pos + len(line)
        kind = next(kind for kind, after, x in _LINES if prev not in after and x.match(line))
        if kind == "prose":
            para = (pos, end) if para is None else (para[0], end)
        else:
            if para is not None:
                yield (*para, True)
                para = None
            if kind != "blank":
                yield pos, end, False
        prev = kind
        pos = end + 1
    if para is not None:
        yield (*para, True)


def enclosures(p: str) -> tuple[list[tuple[int, int]], set[int]]:
    """(open, close) of matched quotations and brackets, outermost only, in order, and where any of them opens.

    Unmatched ones do not count.
    """
    stack: list[tuple[int, str]] = []
    found: list[tuple[int, int]] = []
    for m in _ENCLOSERS.finditer(p):
        c, i = m[0], m.start()
        at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][1] == c), None)
        if at is not None:
            found.append((stack[at][0], i))
            del stack[at:]
        elif c in _QUOTES:
            stack.append((i, _QUOTES[c]))
        elif c == '"':
            stack.append((i, '"'))
    found.sort()
    out: list[tuple[int, int]] = []
    for a, b in found:
        if not out or a > out[-1][1]:
            out.append((a, b))
        elif b > out[-1][1]:
            out[-1] = (out[-1][0], b)
    return out, {a for a, _ in found}


def _end(m: re.Match, opens: set[int]) -> int:
    """Where a run of marks and what closes after it ends: before anything that opens again."""
    return next((i for i in range(m.start() + 1, m.end()) if i in opens), m.end())


def sentences(text: str, lang: str | None) -> list[tuple[int, int]]:
    """The sentence units of a text: (start, end) in code points, end exclusive. Blank text has none."""
    code = language_of(lang, text)
    thai = _SCRIPT_RE["th"]
    out: list[tuple[int, int]] = []

    def add(a: int, b: int) -> None:
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a < b:
            out.append((a, b))

    for a, b, prose in blocks(text):
        if not prose:
            add(a, b)
            continue
        p = text[a:b]
        spans, opens = enclosures(p)
        stop, mark = cascade(code), marks(code)
        urls = [(m.start(), m.end() - 1) for m in _URL.finditer(p)] if "://" in p else []
        ends = {_end(m, opens) for m in _CANDIDATE.finditer(p) if not (m[0][-1] == "." and m.end() < len(p) and not p[m.end()].isspace() and m[0][0] not in _WIDE)}
        if thai.search(p):
            ends |= {m.start() for m in _SPACE.finditer(p)}
            if code != "th":
                stop = mark = cascade("th")
        begin, k, u = 0, 0, 0
        for e in sorted(ends):
            if e <= begin or e >= len(p):
                continue
            while k < len(spans) and spans[k][1] < e:
                k += 1
            while u < len(urls) and urls[u][1] < e:
                u += 1
            place = "free"
            if k < len(spans) and spans[k][0] < e <= spans[k][1]:
                place = "inside"
            elif u < len(urls) and urls[u][0] < e <= urls[u][1]:
                place = "url"
            elif k > 0 and spans[k - 1][1] == e - 1 and not p[begin : spans[k - 1][0]].strip():
                place = "alone"
            said = next((brk for brk, x, y in _PLACED.get(place, ()) if x.match(p[e - 1]) and y.match(p, e)), None)
            if said is None:
                said = (stop if p[e - 1] == "." else mark).breaks(p[begin:e], p, e)
            if said:
                add(a + begin, a + e)
                begin = e
        add(a + begin, a + len(p))
    return out


def split_documents(docs: DataFrame) -> DataFrame:
    """doc_id, start_pos, end_pos of every sentence unit; null and blank texts have none."""
    cols = docs.select("doc_id", "text", "lang").where(F.col("text").isNotNull())

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, starts, ends = [], [], []
            for i, t, g in zip(pdf.doc_id, pdf.text, pdf.lang):
                for s, e in sentences(t, g):
                    ids.append(i)
                    starts.append(s)
                    ends.append(e)
            yield pd.DataFrame({"doc_id": ids, "start_pos": starts, "end_pos": ends})

    return spread(cols, "doc_id").mapInPandas(cut, "doc_id long, start_pos long, end_pos long")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_documents(table(spark, sf_dir, "documents"))


#: Blank characters for the count of characters in units, in a form that both engines read.
BLANKS = r"[\s\p{Z}\x0B\x1C-\x1F\x{85}\x{200B}\x{FEFF}]+"


def p9_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, chars: characters within a document's units, blank ones not counted: all that the text has."""
    docs = table(spark, sf_dir, "documents")
    units = written(p9_found(spark, sf_dir), "units").groupBy("doc_id").agg(F.collect_list(F.struct((F.col("start_pos") + 1).cast("int").alias("a"), (F.col("end_pos") - F.col("start_pos")).cast("int").alias("n"))).alias("us"))  # the units of one document
    inside = F.aggregate("us", F.lit(0).cast("long"), lambda acc, u: acc + F.length(F.regexp_replace(F.substring(F.col("text"), u["a"], u["n"]), BLANKS, "")))
    return docs.select("doc_id", "text").join(units, "doc_id").select("doc_id", inside.alias("chars"))


QUERIES = {"p9_found": p9_found, "p9_coverage": p9_coverage}
SQL = {"p9_coverage": "SELECT doc_id, length(regexp_replace(text, '" + BLANKS + "', '', 'g')) AS chars FROM documents WHERE regexp_matches(text, '[^\\s\\p{Z}\\x0B\\x1C-\\x1F\\x{85}]')"}

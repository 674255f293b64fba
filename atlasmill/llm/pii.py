"""Personal information in free text: anchors found by Aho-Corasick, expanded and checked by local parsers, replaced by typed placeholders.

An automaton over the folded text reports anchors: at-signs and their spellings, schemes, cues and digits that can open a number, street types
and given names. A parser of that kind then reads to the left and right of the anchor and accepts or rejects it. Given names are learned from
the corpus: words that stand where titles, signatures and other cues expect a person. Positions refer to the text as stored, in code points from 1.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

# Common given names of both scripts, beside those that learn_names() finds; `given` of find_pii() takes others.
GIVEN_NAMES = tuple(
    "ahmad ali amal amina anita badr dalal elif faisal faris fatima grace hassan hind huda hussein ibrahim imran jamal john joseph karim "
    "khalid layla latifa lina maha majed marco maria mariam mohammed mona nawaf nora omar peter rakan rania reem saad salim salma sami sara "
    "shatha tarek usman wafa yusuf ziyad "
    "أحمد علي أمل أمينة أنيتا بدر دلال إليف فيصل فارس فاطمة غريس حسان حسن هند هدى حسين إبراهيم عمران جمال جوزيف كريم خالد ليلى لطيفة لينا مها "
    "ماجد ماركو ماريا مريم محمد منى نواف نورة عمر راكان رانيا ريم سعد سالم سلمى سامي سارة شذى طارق عثمان وفاء يوسف زياد".split()
)
# Words for kinds of streets, kinds of places and what cannot be a family name.
STREET_EN = ("street", "str", "st", "road", "rd", "lane", "ln", "avenue", "ave", "av", "tariq", "boulevard", "blvd")
STREET_AR = ("شارع", "طريق", "ممر", "جادة")
PLACES = frozenset(
    (*STREET_EN, *"pharmacy pharmacies drugstore chemist stores store medical care clinic hospital district dist building bldg tower mall school mosque".split(),
     *STREET_AR, *"صيدلية صيدليات أدوية مستودع مركز مستشفى عيادة مدرسة مسجد حي برج مبنى مجمع سوق".split())
)
STOP_AR = frozenset("في إلى على من عن مع أو و ثم قد لا ما هو هي أن إن كان كانت بعد قبل عند لدى حتى بين وهوية وهو وهي الاتصال مرتين مساء صباحا هذا هذه التي الذي وقد ولا ولم لم".split())
PARTICLES_EN = ("van", "von", "ben", "bin", "ibn", "abu", "de", "el", "al")
PARTICLES_AR = ("بن", "ابن", "أبو", "ابو", "فان", "آل", "عبد", "بنت")

# What stands before a person: titles, roles, signatures, fields, speakers.
CUES_EN = (
    *"mr mrs ms miss dr prof eng sheikh customer patient client tenant visitor courier signed signature regards sincerely dear attn by from both to contact name sheet".split(),
)
CUES_AR = tuple(
    "السيد السيدة الأستاذ الأستاذة الدكتور الدكتورة الشيخ المهندس العميل العميلة الزبون المريض المريضة باسم يسكن تسكن يقيم تقيم يرى ترى قال قالت ذكر ذكرت توقيع".split()
)
_THEN_EN = re.compile(r"\.?\s*[,:=/]?\s*(?:(?:[Mm]r|[Mm]rs|[Mm]s|[Dd]r)\.? )?(?=[^\W\d_])")
_THEN_AR = re.compile(r"\s*[,،:=/]?\s+")
_PERSON_EN = re.compile(r"(?:(?:(?:VAN|VON|BEN|BIN|ABU|DE|EL|Van|Von|Ben|Bin|Abu|De|El) )?[A-ZÀ-Þ][\w'’\-]+, )?([A-ZÀ-Þ][\w'’]+)(?= (?:[A-ZÀ-Þ]\. |[A-ZÀ-Þ][\w'’]+ )?(?:(?:Van|Von|Ben|Bin|Abu|De|El|VAN|VON|BEN|BIN|ABU|DE|EL) )?[A-ZÀ-Þ][\w'’\-]+)?")
_PERSON_AR = re.compile(r"([ء-ي]{2,}) (?=[ء-ي]{2,})")
#: A word is a given name if it stands behind a cue at least so often, and that is at least this share of all its occurrences.
LEAST_SEEN, LEAST_SHARE = 2, 0.2
#: Names that every task may hold.
MAX_NAMES = 500_000

_LOCAL_TAIL = re.compile(r"(?:[a-z0-9_+\-]+(?: dot | \(dot\) | \[dot\] |\(dot\)|\[dot\]))*[a-z0-9][a-z0-9._%+\-]*$")
_HOST = re.compile(r"[a-z0-9](?:[a-z0-9\-]*[a-z0-9])?(?:(?:\.| dot | ?\(dot\) ?| ?\[dot\] ?)[a-z0-9](?:[a-z0-9\-]*[a-z0-9])?)+")
_PHONE = re.compile(r"(?:\+ ?966|00 ?966|966|\+ ?\(966\)|\(\+966\))[ .\-]*(?:\(0?\)[ .\-]?)?0?(?:[ .\-()]{0,2}\d){9}(?!\d)|\(0\d{1,2}\)(?:[ .\-]{0,2}\d){7,8}(?!\d)|0(?:[ .\-]?\d){9}(?!\d)")
_NUMBER_BEFORE_EN = re.compile(r"(?:(?P<b>(?:bldg|building|house|villa)\.? ?(?:no\.? ?)?)(?P<bn>\d{1,5}),? +|(?<![\d:./,\-+])(?P<n>\d{2,5}),? +)(?P<name>[^\W\d_][\w'’\-]*(?: [^\W\d_][\w'’\-]*){0,2}) +$")
_NUMBER_AFTER_EN = re.compile(r"\.?,?(?: no\.?)? +(?:bldg\.? |building )?(\d{2,5})(?![\d:]|[./\-]\d)")
_NAME_BEFORE_EN = re.compile(r"(?:(?<=\s)|^|(?<=[/(\"'>,:;=]))((?:(?:Al|El|Al-)[ \-])?[A-ZÀ-Þ][\w'’\-]*) +$")
_NUMBER_BEFORE_AR = re.compile(r"(?:(?P<b>مبنى (?:رقم )?)(?P<bn>\d{1,5})[،,]? +|(?<![\d:./,\-+])(?P<n>\d{2,5})[،,]? +)$")
_NUMBER_AFTER_AR = re.compile(r" +[^\W\d_]+(?: [^\W\d_]+)?[،,]?(?: -)? +(?:(?:مبنى|عمارة|رقم) )+(\d{1,5})(?!\d)")
_WORD = re.compile(r"[^\W\d_](?:[\w'’]|-(?=\w))*")
_ANY_NAME_BEFORE = re.compile(r"(?:(?<=[^\w\-])|^)([^\W\d_][\w'’\-]*) +$")
_GAP, _INITIAL = re.compile(r" (?=\w)"), re.compile(r"[A-Z]\.(?= )")
_NEXT_WORD, _LAST_WORD = re.compile(r" [^\W\d_]+"), re.compile(r"([^\W\d_]+) $")
_FAMILY_BEFORE = re.compile(r"(?:(?<=[^\w\-])|^)((?:(?:VAN|VON|BEN|BIN|ABU|DE|EL|Van|Von|Ben|Bin|Abu|De|El) )?[A-ZÀ-Þ][\w'’\-]+), ?$")


class _Folds(dict):
    """Per character: ASCII digits and widths, plain spaces; one character for one, so positions stay."""

    def __missing__(self, code: int) -> int | str:
        ch = chr(code)
        if code < 128:
            out = " " if ch == "\t" else ch
        elif ch.isdecimal():
            out = str(unicodedata.decimal(ch))
        elif unicodedata.category(ch) == "Zs":
            out = " "
        elif 0xFF01 <= code <= 0xFF5E:
            out = chr(code - 0xFEE0)
        elif ch in "﹫":
            out = "@"
        elif ch in "‐‑‒–−":
            out = "-"
        else:
            out = ch
        self[code] = out
        return out


_FOLDS = _Folds()


class Finder:
    """The automaton of all anchors, with a list of given names."""

    def __init__(self, given: tuple[str, ...]) -> None:
        self.given = frozenset(given)
        a = self.automaton = ahocorasick.Automaton()
        anchors = [("email", ("@", "(at)", "[at]", "{at}", "<at>", " at ")), ("mail_scheme", ("mailto:",)), ("phone", ("+", "0", "(0", "966", "(+966")), ("id_number", ("1", "2"))]
        anchors += [("number_scheme", ("tel:", "id:", "id no", "iqama", "هوية", "إقامة")), ("street_en", STREET_EN), ("street_ar", STREET_AR), ("name", tuple(self.given))]
        for kind, words in anchors:
            for w in words:
                known = a.get(w, ())
                a.add_word(w, (*known, (kind, len(w))))
        a.make_automaton()

    def anchors(self, low: str) -> Iterator[tuple[str, int, int]]:
        for last, kinds in self.automaton.iter(low):
            for kind, n in kinds:
                yield kind, last + 1 - n, last + 1


_finder = lru_cache(maxsize=4)(Finder)


def check_digit(digits: str) -> bool:
    """Whether the last digit is the one payment cards would have."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _lower(s: str) -> str:
    low = s.lower()
    return low if len(low) == len(s) else "".join(c.lower() if len(c.lower()) == 1 else c for c in s)


def _email(low: str, i: int, j: int) -> tuple[int, int] | None:
    left = i - 1 if i and low[i - 1] == " " and low[i] != " " else i
    m = _LOCAL_TAIL.search(low, max(0, left - 80), left)
    if not m or (m.start() and (low[m.start() - 1].isalnum() or low[m.start() - 1] in "@/")):
        return None
    right = j + 1 if j < len(low) and low[j] == " " and low[j - 1] != " " else j
    h = _HOST.match(low, right)
    if not h:
        return None
    last = re.split(r"[ .()\[\]]+", h.group().strip(" .)]"))[-1]
    if not (last.isascii() and last.isalpha() and len(last) >= 2):
        return None
    if low[i:j] == " at " and " dot " not in h.group() and "." not in h.group():
        return None
    return m.start(), h.end()


def _phone(low: str, i: int) -> tuple[int, int] | None:
    if i and (low[i - 1].isalnum() or low[i - 1] in "+/" or (low[i - 1] in "(.-:," and i > 1 and low[i - 2].isdigit()) or (low[i - 1] == "(" and low[i] != "+")):
        return None
    m = _PHONE.match(low, i)
    if not m:
        return None
    digits = re.sub(r"\D", "", m.group())
    if digits.startswith("00"):
        digits = digits[2:]
    if digits.startswith("966"):
        digits = digits[3:]
    elif not digits.startswith("0"):
        return None
    digits = digits.lstrip("0")
    if len(digits) != 9 or digits[0] not in "15":
        return None
    return i, m.end()


def _id(low: str, i: int) -> tuple[int, int] | None:
    if i and (low[i - 1].isalnum() or low[i - 1] in "+_" or (low[i - 1] in ".-:/,( " and i > 1 and low[i - 2].isdigit() and low[i - 1] in ".-:/,")):
        return None
    digits, sep, j, gaps = "", "", i, 0
    while j < len(low) and len(digits) < 10:
        c = low[j]
        if c.isascii() and c.isdigit():
            digits += c
        elif c in " .-/" and digits and low[j - 1].isdigit() and (not sep or sep == c):
            sep, gaps = c, gaps + 1
        else:
            return None
        j += 1
    if len(digits) != 10 or (j < len(low) and (low[j].isalnum() or (low[j] in ":-/." and j + 1 < len(low) and low[j + 1].isdigit()))):
        return None
    return (i, j) if check_digit(digits) else None


def _address(flat: str, low: str, i: int, j: int, arabic: bool) -> tuple[int, int] | None:
    if (i and low[i - 1].isalnum()) or (j < len(low) and (low[j].isalnum() or low[j] == "_")):
        return None
    if arabic:
        m = _NUMBER_BEFORE_AR.search(low, max(0, i - 30), i)
        if m:
            street = _NEXT_WORD.match(low, j)
            return m.start(), street.end() if street else j
        m = _NUMBER_AFTER_AR.match(low, j)
        return (i, m.end()) if m else None
    m = _NUMBER_BEFORE_EN.search(low, max(0, i - 60), i)
    if m:
        return m.start(), j
    m = _NUMBER_AFTER_EN.match(low, j)
    if m:
        n = _NAME_BEFORE_EN.search(flat, max(0, i - 40), i) or _ANY_NAME_BEFORE.search(flat, max(0, i - 40), i)
        if n:
            return n.start(1), m.end()
    return None


def _family(flat: str, low: str, j: int, given: frozenset[str]) -> int:
    """End of (middle names and) a family name after a given name that ends at j, or -1."""
    for _ in range(3):
        m = _GAP.match(flat, j)
        if not m:
            return -1
        j = m.end()
        initial = _INITIAL.match(flat, j)
        if initial:
            j = initial.end()
            continue
        w = _WORD.match(flat, j)
        if not w:
            return -1
        word = low[w.start() : w.end()]
        if word in given:
            j = w.end()
            continue
        arabic = "؀" <= word[0] <= "ۿ"
        if word in (PARTICLES_AR if arabic else PARTICLES_EN):
            n = _WORD.match(flat, w.end() + 1) if flat[w.end() : w.end() + 1] == " " else None
            if not n or (not arabic and not flat[n.start()].isupper()):
                return -1
            w, word = n, low[n.start() : n.end()]
        elif (not arabic and not flat[w.start()].isupper()) or (arabic and word in STOP_AR) or len(word) < 3:
            return -1
        if word in PLACES:
            return -1
        after = _WORD.match(flat, w.end() + 1) if flat[w.end() : w.end() + 1] == " " else None
        if after and low[after.start() : after.end()] in PLACES and (arabic is False):
            return -1
        return w.end()
    return -1


def _name(flat: str, low: str, i: int, j: int, given: frozenset[str]) -> tuple[int, int] | None:
    if (i and (low[i - 1].isalnum() or low[i - 1] in "_-.@+'")) or (j < len(low) and (low[j].isalnum() or low[j] in "_-@+'")):
        return None
    arabic = "؀" <= low[i] <= "ۿ"
    if not arabic:
        if not flat[i].isupper():
            return None
        m = _FAMILY_BEFORE.search(flat, max(0, i - 40), i)
        if m and _lower(m.group(1)) not in given and _lower(m.group(1).split(" ")[-1]) not in PLACES and (m.group(1).isupper() or flat[i + 1 : j].islower()):
            if m.group(1).isupper() or not _WORD.fullmatch(m.group(1)) or "-" in m.group(1):
                return m.start(1), j
    before = _LAST_WORD.search(low[max(0, i - 20) : i])
    if before and (before.group(1) in PLACES) and arabic:
        return None
    end = _family(flat, low, j, given)
    return (i, end) if end > 0 else None


def _first_digit(low: str, j: int, most: int = 16) -> int:
    """Position of the first digit (or plus sign) after a cue, or -1."""
    m = re.compile(r"[+\d]").search(low, j, j + most)
    return m.start() if m else -1


class _Free:
    """Spans that do not overlap, kept in order; each new one is held against its two neighbours only."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.spans: list[tuple[str, int, int]] = []

    def take(self, span: tuple[str, int, int]) -> None:
        i = bisect_right(self.starts, span[1])
        if (i and self.spans[i - 1][2] > span[1]) or (i < len(self.spans) and self.spans[i][1] < span[2]):
            return
        self.starts.insert(i, span[1])
        self.spans.insert(i, span)


def find_pii(text: str | None, given: tuple[str, ...] = GIVEN_NAMES, finder: Finder | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every mention, sorted by start; positions are code points of the text as stored, from 0."""
    if not text:
        return []
    finder = finder or _finder(given)
    hidden = [i for i, c in enumerate(text) if unicodedata.category(c) == "Cf" or c == "͏"] if not text.isascii() else []
    if hidden:
        drop = set(hidden)
        at = [i for i in range(len(text)) if i not in drop]
        flat = "".join(text[i] for i in at).translate(_FOLDS)
    else:
        at, flat = None, text.translate(_FOLDS)
    low = _lower(flat)
    found: dict[int, set[tuple[str, int, int]]] = {0: set(), 1: set(), 2: set()}
    for kind, i, j in finder.anchors(low):
        turn = 0
        if kind == "email":
            hit = _email(low, i, j)
        elif kind == "mail_scheme":
            sign = low.find("@", j, j + 80)
            kind, hit = "email", _email(low, sign, sign + 1) if sign > 0 else None
        elif kind == "phone":
            hit = _phone(low, i)
        elif kind == "id_number":
            hit = _id(low, i)
        elif kind == "number_scheme":
            first = _first_digit(low, j)
            hit = _id(low, first) if first >= 0 else None
            kind = "id_number"
            if hit is None and first >= 0:
                kind, hit = "phone", _phone(low, first)
        elif kind == "name":
            kind, turn, hit = "person_name", 2, _name(flat, low, i, j, finder.given)
        else:
            kind, turn, hit = "address", 1, _address(flat, low, i, j, kind == "street_ar")
        if hit:
            found[turn].add((kind, *hit))
    free, order = _Free(), {"email": 0, "phone": 1, "id_number": 2}
    for turn in (0, 1, 2):
        for s in sorted(found[turn], key=lambda s: (order.get(s[0], 3), s[1], -s[2])):
            free.take(s)
    if at is not None:
        return [(k, at[a], at[b - 1] + 1) for k, a, b in free.spans]
    return free.spans


def redact(text: str | None, given: tuple[str, ...] = GIVEN_NAMES) -> str | None:
    """The text with every mention replaced by its kind in angle brackets; nothing else changes, null stays null."""
    if text is None:
        return None
    out, end = [], 0
    for kind, a, b in find_pii(text, given):
        out += [text[end:a], f"<{kind.upper()}>"]
        end = b
    return "".join(out) + text[end:]


_FOUND = ArrayType(StructType([StructField("pii_kind", StringType()), StructField("start_pos", IntegerType()), StructField("end_pos", IntegerType())]))


@F.pandas_udf(StringType())
def redact_col(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """redact() of a column."""
    for t in texts:
        yield t.map(redact, na_action="ignore")


@lru_cache(maxsize=1)
def _cues() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for w in (*CUES_EN, *CUES_AR):
        a.add_word(w, w)
    a.make_automaton()
    return a


def people_in(flat: str, low: str | None = None) -> list[str]:
    """Words of a folded text (lower case) that stand where a cue expects a given name."""
    low, out = low or _lower(flat), []
    for last, cue in _cues().iter(low):
        i, j, arabic = last + 1 - len(cue), last + 1, cue >= "؀"
        if (j < len(low) and (low[j].isalnum() or low[j] == "_")) or (i and (low[i - 1].isalnum() or low[i - 1] == "_") and not (arabic and low[i - 1] == "و")):
            continue
        then = (_THEN_AR if arabic else _THEN_EN).match(flat, j)
        p = then and (_PERSON_AR if arabic else _PERSON_EN).match(flat, then.end())
        if not p:
            continue
        if arabic:
            if p.group(1) not in STOP_AR and p.group(1) not in PLACES and p.group(1) not in CUES_AR:
                out.append(p.group(1))
        elif (p.end() < len(flat) and flat[p.end()] == " ") or "," in p.group():
            rest = low[then.end() : then.end() + 60].split()
            if not any(w.strip(".,;") in PLACES for w in rest[:4]):
                out.append(_lower(p.group(1)))
    return out


def learn_names(documents: DataFrame, text: str = "text") -> tuple[str, ...]:
    """Given names of a corpus: words that stand behind cues LEAST_SEEN times or more, and there in LEAST_SHARE of all their occurrences as a word
    between spaces.

    Counts are taken over all documents and added up before they leave a task; what comes back is the names (at most MAX_NAMES, checked).
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        cued: Counter = Counter()
        for b in batches:
            for t in b["t"]:
                flat = t.translate(_FOLDS)
                low = _lower(flat)
                cued.update(people_in(flat, low))
                seen.update(low.split())
        seen.update(dict.fromkeys(cued.keys() - seen.keys(), 0))
        yield pd.DataFrame({"w": pd.Series(list(seen), dtype=object), "n": pd.Series(list(seen.values()), dtype="int64"), "c": pd.Series([cued.get(w, 0) for w in seen], dtype="int64")})

    rows = documents.select(F.col(text).cast("string").alias("t")).filter("t is not null")
    sums = rows.mapInPandas(count, "w string, n long, c long").groupBy("w").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
    got = sums.filter((F.col("c") >= LEAST_SEEN) & (F.col("c") >= LEAST_SHARE * F.col("n")) & (F.length("w") > 1)).select("w").limit(MAX_NAMES + 1).collect()
    if len(got) > MAX_NAMES:
        raise ValueError("more names than a task may hold")
    return tuple(sorted(r["w"] for r in got if r["w"] not in PLACES and r["w"] not in STOP_AR))


def mentions(documents: DataFrame, key: str, text: str, given: tuple[str, ...] = GIVEN_NAMES, learn: bool = True) -> DataFrame:
    """key, pii_kind, start_pos (long, from 1), end_pos: one row per mention of a document.

    Person names need a given name: one of `given`, or one that learn_names() finds in the same documents. Null, empty and blank texts have no
    mentions; texts of any length are read whole; repeated rows give repeated rows; other columns are not read. Two passes over the
    documents, the first of which shuffles word counts only.
    """
    names = tuple(sorted({*given, *(learn_names(documents, text) if learn else ())}))
    shared = documents.sparkSession.sparkContext.broadcast(names)

    @F.pandas_udf(_FOUND)
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(shared.value)
        for t in texts:
            yield pd.Series([[{"pii_kind": k, "start_pos": a + 1, "end_pos": b} for k, a, b in find_pii(x, finder=finder)] for x in t], dtype=object)

    found = documents.select(F.col(key), F.inline(find(F.col(text).cast("string"))))
    return found.select(key, "pii_kind", F.col("start_pos").cast("long").alias("start_pos"), F.col("end_pos").cast("long").alias("end_pos"))

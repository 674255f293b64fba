"""What a reader sees of a text: look-alike characters, widths, invisible characters and spaces brought to one form."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Letters of other scripts drawn like a Latin one, by upper and lower case, each beside its prototype.
LOOKALIKES = {
    "А": "A", "В": "B", "С": "C", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "Т": "T", "Х": "X", "Ү": "Y", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I",
    "а": "a", "с": "c", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o", "р": "p", "у": "y", "х": "x", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ү": "y", "ѵ": "v", "г": "r",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "γ": "y", "ϲ": "c", "ϳ": "j", "υ": "u", "κ": "k",
    "Տ": "S", "Օ": "O", "Լ": "L", "օ": "o", "ո": "n", "հ": "h", "ս": "u", "ց": "g", "զ": "q", "յ": "j",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʏ": "y",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹘": "-", "⁃": "-",
    "‘": "'", "’": "'", "‛": "'", "ʼ": "'", "ʹ": "'", "′": "'", "‚": ",", "ꓸ": ".", "․": ".", "⁄": "/", "∕": "/", "∶": ":", "ː": ":",
    "ک": "ك", "ڪ": "ك", "ہ": "ه", "ھ": "ه", "ە": "ه", "ۃ": "ة",
    "۰": "٠", "۱": "١", "۲": "٢", "۳": "٣", "۷": "٧", "۸": "٨", "۹": "٩",
}
#: Kinds of compatibility decomposition that keep a letter's look; superscripts, circles and fractions do not.
_SAME_LOOK = {"wide", "narrow", "initial", "medial", "final", "isolated", "noBreak", "font"}
_JOINED_YEH = re.compile("ی(?=[ً-ٰٟ]*[ؠ-يٮ-ۓۺ-ۿ])|[ىی](?=ٔ)")


def _same_look(ch: str) -> str:
    """One step of decomposition that leaves the picture as it is."""
    d = unicodedata.decomposition(ch)
    if not d:
        return ch
    if d[0] == "<":
        kind, _, codes = d[1:].partition("> ")
        if kind not in _SAME_LOOK and not (kind == "compat" and unicodedata.category(ch)[0] == "L"):
            return ch
    else:
        codes = d
    return "".join(_same_look(chr(int(c, 16))) for c in codes.split())


class _Prototypes(dict):
    """str.translate table that fills itself."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        kind = unicodedata.category(ch)
        if ch.isspace() or kind in ("Zs", "Zl", "Zp"):
            out = " "
        elif kind in ("Cf", "Cc", "Cs") or ch in "͏ᅟᅠㅤﾠ឴឵" or 0x180B <= code <= 0x180F or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF:
            out = ""
        else:
            out = "".join(LOOKALIKES.get(c, c) for c in _same_look(ch))
        self[code] = out
        return out


_PROTOTYPES = _Prototypes()


def skeleton(text: str | None) -> str | None:
    """The confusables skeleton: decompose, replace each character by its prototype, decompose again; spaces are collapsed.

    Null stays null; a text of nothing visible becomes ''. Letter case, accents, hamzas and digits' scripts are visible and stay.
    Farsi yeh is drawn like Arabic yeh inside a word and like alef maksura at its end, and is mapped so.
    """
    if text is None:
        return None
    if text.isascii() and "  " not in text:
        return text.strip() if text.isprintable() else " ".join(text.translate(_PROTOTYPES).split())
    s = unicodedata.normalize("NFD", text).translate(_PROTOTYPES)
    if "ی" in s or "ٔ" in s:
        s = _JOINED_YEH.sub("ي", s).replace("ی", "ى")
    return " ".join(unicodedata.normalize("NFD", s).split())


def reading_key(text: str | None) -> str:
    """Equal for two texts that read alike whatever their spacing, widths, letter case and unseen characters; '' for blank and null."""
    return (skeleton(text) or "").replace(" ", "").casefold()


@F.pandas_udf(StringType())
def skeleton_col(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """skeleton() of a column."""
    for t in texts:
        codes, distinct = pd.factorize(t)
        done = pd.Series([*map(skeleton, distinct), None], dtype=object)
        yield done.take(codes).reset_index(drop=True)


def invisible_characters() -> str:
    """All characters that skeleton() drops (for documentation and tests)."""
    return "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and _Prototypes().__missing__(c) == "")

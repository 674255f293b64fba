"""Name cleaning, comparison keys, script checks and multilingual tag resolution; Arrow functions over plain Python rules."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

# Words that do not tell places apart, in both scripts.
GENERIC_LATIN = ("al", "el", "the", "pharmacy", "clinic", "hospital", "school")
GENERIC_ARABIC = ("صيدلية", "صيدليه", "عيادة", "مستشفى", "مدرسة")
# The Latin letters that stand for Arabic ones in comparison keys.
LATIN_OF = {
    "ا": "a", "أ": "a", "إ": "a", "آ": "a", "ب": "b", "ت": "t", "ث": "th", "ج": "j", "ح": "h", "خ": "kh", "د": "d", "ذ": "dh", "ر": "r",
    "ز": "z", "س": "s", "ش": "sh", "ص": "s", "ض": "d", "ط": "t", "ظ": "z", "ع": "a", "غ": "gh", "ف": "f", "ق": "q", "ك": "k", "ل": "l",
    "م": "m", "ن": "n", "ه": "h", "ة": "h", "و": "w", "ؤ": "w", "ي": "y", "ى": "a", "ئ": "y",
}
_VOWELS = "aeiouy"
#: One pass from a word to its consonants: Arabic letters by the Latin consonants they stand for, vowels to nothing.
_CONSONANTS = str.maketrans({a: x.strip(_VOWELS) for a, x in LATIN_OF.items()} | dict.fromkeys(_VOWELS, ""))
#: A word that tells something: no generic word of its script; the Arabic article before it is not part of it.
_TELLING = re.compile(
    rf"(?<![a-z0-9])(?!(?:{'|'.join(GENERIC_LATIN)})(?![a-z0-9]))([a-z0-9]+)|(?<![ء-ي])(?!(?:{'|'.join(GENERIC_ARABIC)})(?![ء-ي]))(?:ال)?([ء-ي]*)"
)
#: Tag names that hold names, from the most to the least preferred.
NAME_TAGS = ("name", "official_name", "short_name", "alt_name")
#: Version written beside names that were cleaned.
NORMALIZATION = "unicode-names-v1"


def no_marks(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def clean_name(text: object) -> str | None:
    """NFKC without format characters, single spaces; None for anything empty or not a text."""
    if not isinstance(text, str):
        return None
    kept = (c for c in unicodedata.normalize("NFKC", text) if unicodedata.category(c) != "Cf")
    return " ".join("".join(kept).split()) or None


def arabic_key(text: object) -> str:
    """clean_name() without marks and stretching, Persian kaf and yeh as Arabic."""
    return no_marks(clean_name(text) or "").replace("ـ", "").replace("ک", "ك").replace("ی", "ي")


class _Letters(dict):
    """Character -> the script whose letter it is ('ar', 'en'), 'broken' for what no name may hold, else ''; filled as characters are met."""

    def __missing__(self, c: str) -> str:
        kind = unicodedata.category(c)
        if c == "\N{REPLACEMENT CHARACTER}" or kind == "Cs" or kind == "Cc" and not c.isspace():
            found = "broken"
        else:
            named = unicodedata.name(c, "") if kind.startswith("L") else ""
            found = "ar" if "ARABIC" in named else "en" if "LATIN" in named else ""
        self[c] = found
        return found


_LETTERS = _Letters()


def scripts_of(text: object) -> frozenset[str]:
    """Languages ('ar', 'en') that a text is fit to be a name of: those whose letters it holds; none for a text with broken characters."""
    if not isinstance(text, str) or any(_LETTERS[c] == "broken" for c in text):
        return frozenset()
    return frozenset(_LETTERS[c] for c in clean_name(text) or "") - {""}


def has_script(text: object, language: str) -> bool:
    """Whether a text is fit to be a name of the language."""
    return ("ar" if language == "ar" else "en") in scripts_of(text)


def name_key(text: str | None) -> str:
    """Consonants of the telling words, Arabic in Latin letters; '' if nothing is left. For comparison, never for display."""
    folded = no_marks((text or "").casefold()).replace("ـ", "")
    words = (m[m.lastindex].translate(_CONSONANTS) for m in _TELLING.finditer(folded) if m.lastindex)
    return " ".join(w for w in words if w)


def _offers(tags: dict[str, str]) -> list[tuple[str, tuple[int, int, int], str, str]]:
    """(language, rank, text, tag) of every usable part of the name tags; a part of a list divided by ';' stands alone. Lowest rank is best."""
    found = []
    for place, base in enumerate(NAME_TAGS):
        for tag, said in ((f"{base}:ar", ("ar",)), (f"{base}:en", ("en",)), (base, ())):
            for turn, part in enumerate((tags.get(tag) or "").split(";")):
                fit = scripts_of(part)
                # A tag of a language offers to that one only; one without to the first of its scripts, after all tags of languages.
                for language in said if said else [x for x in ("ar", "en") if x in fit][:1]:
                    if language in fit:
                        found.append((language, (0 if said else 1, place, turn), clean_name(part), tag))
    return found


def resolve_tags(tags: dict[str, str] | None, source_key: str) -> dict:
    """Names of both languages from tags: language tags first, then untagged ones by script; the rest are alternates.

    Precedence is that of NAME_TAGS; of a list divided by ';' the first usable part wins.
    """
    tags = {t: v for t, v in (tags or {}).items() if isinstance(v, str)}
    out: dict = dict.fromkeys(TAG_FIELDS)
    offers = _offers(tags)
    for language in ("en", "ar"):
        _, text, tag = min((o[1:] for o in offers if o[0] == language), default=(None, None, None))
        out |= {f"name_{language}": text, f"name_{language}_source_field": tag}
        if tag is not None and tag.removesuffix(f":{language}") != "name":
            out[f"provenance_name_{language}"] = f"{source_key}:tags.{tag}"
    spare: dict[str, str] = {}
    for tag, value in tags.items():
        for part in filter(None, map(clean_name, value.split(";"))) if tag.split(":", 1)[0] in NAME_TAGS else ():
            key = arabic_key(part)
            spare[key] = min(part, spare.get(key, part))
    for chosen in (out["name_en"], out["name_ar"]):
        spare.pop(arabic_key(chosen), None)
    out["alternate_names"] = [spare[k] for k in sorted(spare) if k]
    named = out["name_en"] is not None or out["name_ar"] is not None
    out["name_status"] = "source_named" if named else "unnamed_source"
    if not named:
        out |= {"missing_name_reason": "No name in any name tag.", "provenance_name_status": f"{source_key}:tags:name_fields_absent_or_empty"}
    return out


TAG_FIELDS = ("name_en", "name_ar", "name_en_source_field", "name_ar_source_field", "provenance_name_en", "provenance_name_ar", "name_status", "missing_name_reason", "provenance_name_status", "alternate_names")
TAG_NAMES = StructType([StructField(f, ArrayType(StringType()) if f == "alternate_names" else StringType()) for f in TAG_FIELDS])


def _once(fn: Callable, texts: pd.Series) -> pd.Series:
    """fn of each distinct text of a batch."""
    codes, seen = pd.factorize(texts)
    done = pd.Series([*map(fn, seen), fn(None)], dtype=object)
    return done.take(codes).reset_index(drop=True)


@F.pandas_udf(StringType())
def clean_name_col(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for t in texts:
        yield _once(clean_name, t)


@F.pandas_udf(StringType())
def arabic_key_col(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for t in texts:
        yield _once(arabic_key, t)


@F.pandas_udf(StringType())
def name_key_col(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for t in texts:
        yield _once(name_key, t)


@F.pandas_udf(BooleanType())
def _is_english(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for t in texts:
        yield _once(lambda x: has_script(x, "en"), t)


@F.pandas_udf(BooleanType())
def _is_arabic(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for t in texts:
        yield _once(lambda x: has_script(x, "ar"), t)


def has_script_col(text: Column, language: str) -> Column:
    return _is_arabic(text) if language == "ar" else _is_english(text)


@F.pandas_udf(TAG_NAMES)
def resolve_tags_col(tags: pd.Series, source_key: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([resolve_tags(dict(t) if t is not None else {}, k) for t, k in zip(tags, source_key)], columns=list(TAG_FIELDS))


def phone_digits(phone: Column) -> Column:
    """All digits of any script; '' for null."""
    return F.regexp_replace(F.coalesce(phone, F.lit("")), r"(?U)\D", "")

"""Free text to categories and a place: a text is a row of words, in which known phrases are looked up, longest first."""

from __future__ import annotations

import re

# Phrases of categories beside the labels of the taxonomy, in both languages.
PHRASES = {
    "pharmacy": ("pharmacy", "pharmacies", "صيدلية", "صيدليات"),
    "clinic": ("clinic", "clinics", "عيادة", "عيادات"),
    "hospital": ("hospital", "hospitals", "مستشفى", "مستشفيات"),
    "school": ("school", "schools", "مدرسة", "مدارس"),
    "amenity_restaurant": ("مطعم", "مطاعم"),
    "tourism_hotel": ("فندق", "فنادق"),
    "amenity_place_of_worship": ("مسجد", "مساجد"),
    "shop_bakery": ("مخبز", "مخابز"),
    "amenity_bank": ("بنك", "بنوك"),
    "amenity_atm": ("صراف", "صرافات"),
    "amenity_cafe": ("مقهى", "مقاهي"),
    "amenity_fuel": ("محطة وقود", "محطات وقود"),
    "shop_supermarket": ("سوبرماركت", "متاجر سوبرماركت"),
}
# Words that open the name of a place, and whether they mean near it.
OPENINGS = {"en": {"near": True, "around": True, "in": False}, "ar": {"القريبة من": True, "بالقرب من": True, "بالقرب": True, "قرب": True, "حول": True, "في": False}}
NEAR_METRES = 500
#: What may be written on to an Arabic word: and, the, and the.
_PREFIXES = ("", "و", "ال", "وال")
_SPELT = re.compile(r"\w+")
_ARABIC = re.compile(r"[\u0600-\u06FF]")


def plural(label: str) -> str:
    """English plural of a label by its ending."""
    low = label.casefold()
    ending = re.search(r"(?P<y>(?<=[^aeiou])y)$|(?P<hiss>s|x|ch|sh)$", low)
    if ending and ending["y"]:
        return f"{low[:-1]}ies"
    return f"{low}es" if ending else f"{low}s"


def vocabulary(leaves: list[tuple[str, str]]) -> dict[str, str]:
    """Phrase -> category for (id, English label) pairs: label, its plural, the id in words, and PHRASES of the listed categories; first come, first served."""
    out: dict[str, str] = {}
    for key, label in leaves:
        for phrase in (label.casefold(), plural(label), key.replace("_", " "), *PHRASES.get(key, ())):
            out.setdefault(phrase, key)
    return out


def _phrases(words: dict[str, str]) -> dict[tuple[str, ...], str]:
    """The vocabulary by the words of its phrases."""
    return {tuple(_SPELT.findall(phrase)): key for phrase, key in words.items()}


def _readings(word: str) -> list[str]:
    """The word, and an Arabic one without what may be written on to it."""
    return [word[len(p) :] for p in _PREFIXES if word.startswith(p) and len(word) > len(p)] if _ARABIC.search(word) else [word]


def categories_in(text: str, words: dict[str, str]) -> tuple[str, ...]:
    """Categories named in a text: whole words, of overlapping phrases the longest; sorted. Empty if none is."""
    known = _phrases(words)
    spelt = [(m.start(), m.end(), m.group()) for m in _SPELT.finditer(text.casefold())]
    longest = max(map(len, known), default=0)
    met: list[tuple[int, int, int, str]] = []
    for i in range(len(spelt)):
        for n in range(1, min(longest, len(spelt) - i) + 1):
            for head in _readings(spelt[i][2]):
                key = known.get((head, *(w for _, _, w in spelt[i + 1 : i + n])))
                if key:
                    met.append((spelt[i][0] - spelt[i + n - 1][1], i, i + n, key))
    free, found = [True] * len(spelt), set()
    for _, i, j, key in sorted(met):
        if all(free[i:j]):
            free[i:j] = [False] * (j - i)
            found.add(key)
    return tuple(sorted(found))


def place_in(text: str, language: str) -> tuple[str | None, bool]:
    """(what stands after the first opening word, whether any opening word means near)."""
    spelt = [(m.start(), m.end(), m.group().casefold()) for m in _SPELT.finditer(text)]
    opened: list[tuple[int, int, int, bool]] = []
    for phrase, near in OPENINGS[language].items():
        wanted = phrase.split()
        for i in range(len(spelt) - len(wanted) + 1):
            if [w for _, _, w in spelt[i : i + len(wanted)]] == wanted:
                opened.append((i, -len(wanted), spelt[i + len(wanted) - 1][1], near))
    rest = [text[end:].strip(" .،؟") for _, _, end, _ in sorted(opened)]
    return next((r for r in rest if r), None), any(o[3] for o in opened)


def intent(text: str, words: dict[str, str]) -> dict:
    """language, categories, area, near, radius_m, confidence and unresolved parts of a request in words."""
    language = "ar" if _ARABIC.search(text) else "en"
    more = {p: key for key, phrases in PHRASES.items() for p in phrases} if language == "ar" else {}
    found = categories_in(text, more | words)
    area, near = place_in(text.strip(), language)
    missing = [name for name, value in (("category", found), ("area_of_interest", area)) if not value]
    return {
        "language": language, "categories": found, "area": area, "near": near, "radius_m": NEAR_METRES if near else None,
        "confidence": 0.55 if missing else 0.9, "unresolved": missing,
    }

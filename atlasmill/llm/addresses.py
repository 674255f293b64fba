"""Same postal address written differently: numbers first, then one rare word, then rarity-weighted overlap and levenshtein.

Everything but the folding of characters is SQL. An address becomes a sorted array of digit tokens and words; words of both scripts are
brought to one form by a lexicon that is learned from names given in both languages, misspelt ones by deletion neighbourhoods and
levenshtein. Records are blocked on their digits plus one rare word, the tokens of a blocked pair are intersected, and the pair is
accepted by the share of rarity that the two have in common.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from atlasmill.functions.visible import skeleton
from atlasmill.session import materialize
from atlasmill.tables import small

# Words for kinds of streets in both languages, words before a unit's number, and words that open a landmark.
TYPES = {
    "street": "street", "str": "street", "st": "street", "شارع": "street", "road": "road", "rd": "road", "tariq": "road", "طريق": "road",
    "lane": "lane", "ln": "lane", "ممر": "lane", "avenue": "avenue", "ave": "avenue", "av": "avenue", "جادة": "avenue",
}
UNIT = "shop suite unit office flat apt floor محل مكتب وحدة شقة معرض دور الدور جناح".split()
LANDMARK = "next near behind opp opposite beside بجوار قرب خلف مقابل أمام بجانب جنب".split()
ARTICLES = ("al", "el", "ال")
# Generic words of shop names, left out when words are paired across languages.
_SHOP = "pharmacy drugstore chemist medical stores care night first aid the dar صيدلية أدوية مستودع الطبي رعاية الليلية إسعاف وصيدلية دار".split()


class _Plain(dict):
    """str.translate table that fills itself: no marks, no stretching, ASCII digits, one yeh, one heh."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        if unicodedata.combining(ch) or ch == "ـ":
            out = ""
        elif ch.isdecimal():
            out = str(unicodedata.decimal(ch))
        else:
            out = {"ى": "ي", "ة": "ه"}.get(ch) or "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        self[code] = out
        return out


_PLAIN = _Plain()


def plain(text: str | None) -> str:
    """One form of letters, digits and spaces: skeleton, lower case, no accents or hamzas, ASCII digits."""
    return (skeleton(text) or "").casefold().translate(_PLAIN)


@F.pandas_udf(StringType())
def plain_col(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """plain() of a column; null gives ''."""
    for t in texts:
        codes, seen = pd.factorize(t)
        yield pd.Series([*map(plain, seen), ""], dtype=object).take(codes).reset_index(drop=True)


def _words(text: Column) -> Column:
    """Runs of letters without articles, also without the Arabic one that is written on."""
    bare = F.transform(F.regexp_extract_all(text, F.lit(r"(\p{L}+)"), F.lit(1)), _bare)
    return F.filter(bare, lambda w: ~w.isin(*ARTICLES))


def _bare(w: Column) -> Column:
    return F.when(w.startswith("ال") & (F.length(w) > 4), F.substring(w, 3, 1 << 20)).otherwise(w)


def learn_lexicon(names: DataFrame) -> DataFrame:
    """word, form: words of either script of names (name_en, name_ar) and the one form of each, an English word.

    Names whose two sides have as many words are paired word by word; an Arabic word takes the partner that most of its pairs have, if that is
    more than half of them. A leading "and" is tried off as well.
    """
    shop = [plain(w) for w in _SHOP]
    said = names.select(*(F.filter(_words(plain_col(F.col(c))), lambda w: ~w.isin(*shop)).alias(c) for c in ("name_en", "name_ar")))
    same = said.filter((F.size("name_en") == F.size("name_ar")) & (F.size("name_en") > 0))
    votes = same.select(F.posexplode(F.arrays_zip("name_en", "name_ar")).alias("i", "p")).select("i", F.col("p.name_en").alias("x"), F.col("p.name_ar").alias("y"))
    joined = F.col("y").startswith("و") & (F.length("y") > 3) & (F.col("i") > 0)
    votes = votes.select("x", F.explode(F.array_compact(F.array("y", F.when(joined, _bare(F.substring("y", 2, 1 << 20)))))).alias("y"))
    counted = votes.groupBy("y", "x").agg(F.count("*").alias("n")).groupBy("y").agg(F.max(F.struct("n", "x")).alias("best"), F.sum("n").alias("all"))
    arabic = counted.filter(F.col("best.n") > 0.5 * F.col("all")).select(F.col("y").alias("word"), F.col("best.x").alias("form"))
    english = said.select(F.explode("name_en").alias("word")).distinct()
    return english.select("word", F.col("word").alias("form")).unionByName(arabic.join(english, "word", "left_anti"))


def _holes(word: Column) -> Column:
    """The word and what is left of it without one letter, or (from six letters on) without two."""
    without = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: F.concat(F.substring(w, 1, i - 1), F.substring(w, i + 1, F.lit(1 << 20))))
    one = without(word)
    two = F.when(F.length(word) >= 5, F.flatten(F.transform(one, without))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(word), one, two))


def nearest_forms(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """word, form, known, near: each distinct word with the form of its lexicon entry, else of the nearest entry, else itself (known is false).

    Nearest: at most one edit, two for words of six letters or more, a swap of neighbours counts one; found by equal deletion neighbourhoods, so no
    word is held against the whole lexicon. Arabic entries are also met with their article, which a misspelling may have damaged. If the nearest entries disagree, the word stays itself, and near has what they would make of it.
    """
    met = words.join(lexicon.hint("merge"), "word", "left")
    odd = met.filter("form is null").select("word", F.explode(_holes(F.col("word"))).alias("hole"))
    entries = F.array_compact(F.array("word", F.when(F.col("word").rlike("^[؀-ۿ]"), F.concat(F.lit("ال"), "word"))))
    near = lexicon.select(F.explode(entries).alias("entry"), "form").select("entry", "form", F.explode(_holes(F.col("entry"))).alias("hole"))
    letters = lambda c: F.array_sort(F.split(c, ""))
    edits = F.levenshtein("word", "entry")
    edits = F.when((edits == 2) & (letters(F.col("word")) == letters(F.col("entry"))), 1).otherwise(edits)
    both = odd.join(near.hint("merge"), "hole").select("word", "entry", "form").distinct().withColumn("edits", edits)
    both = both.filter(F.col("edits") <= F.when(F.length("word") >= 6, 2).otherwise(1))
    first = both.groupBy("word").agg(F.min("edits").alias("edits"))
    found = both.join(first.hint("merge"), ["word", "edits"]).groupBy("word").agg(F.array_sort(F.collect_set("form")).alias("near"))
    rest = met.filter("form is null").select("word").join(found.hint("merge"), "word", "left")
    sure = F.size("near") == 1
    rest = rest.select("word", F.when(sure, F.col("near")[0]).otherwise(F.col("word")).alias("form"), F.coalesce(sure, F.lit(False)).alias("known"), F.coalesce("near", F.array().cast("array<string>")).alias("near"))
    return met.filter("form is not null").select("word", "form", F.lit(True).alias("known"), F.array("form").alias("near")).unionByName(rest)


def read_addresses(texts: DataFrame, districts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """text, tokens, digits, word, known, near, district, titles of the texts (plain, distinct) that state a building.

    tokens: 'n:' and the digits (building numbers, sorted), 's:' the street's word and kind, 'd:' the district, where one is named or has the postcode;
    word: the street's word; known, near: whether the lexicon has it, and its
    nearest entries there. titles: the names, in the lexicon's forms, of that district; where there is no postcode and several districts have the name, or a
    misspelt name may be read as several, district is null, titles has them all and the token is 'd?' and these. A part between commas that opens with a landmark word and has no digit is left out.
    """
    unit = r"(?<![\p{L}])(?:" + "|".join(map(plain, UNIT)) + r")\.? *(?:no\.? *|رقم *)?\d+[a-z]?(?![\p{L}\d])"
    near = r"(?<![\p{L}])(?:" + "|".join(map(plain, LANDMARK)) + r")(?![\p{L}])"
    s = F.regexp_replace(F.regexp_replace("text", r"\b(\d{5})-\d{4}\b", "$1"), unit, " , ")
    parts = F.filter(F.split(s, r"[,،/;|\n]| - "), lambda p: p.rlike(r"\d") | ~p.rlike(near))
    digits = F.regexp_extract_all(s, F.lit(r"(\d+)"), F.lit(1))
    short = F.transform(F.filter(digits, lambda d: F.length(d) <= 4), lambda d: F.regexp_replace(d, "^0+", ""))
    kinds = F.create_map(*(F.lit(x) for k, v in TYPES.items() for x in (plain(k), v)))
    cut = texts.filter(F.col("text").rlike(r"\d")).select(
        "text", F.array_join(F.array_sort(F.array_distinct(F.filter(short, lambda d: d != ""))), " ").alias("digits"),
        F.get(F.filter(digits, lambda d: F.length(d) == 5), F.lit(0)).alias("postcode"),
        F.flatten(F.transform(parts, lambda p: F.concat(_words(p), F.array(F.lit("|"))))).alias("words"),
    )
    at = F.array_position(F.transform("words", lambda w: kinds[w].isNotNull()), True).cast("int")
    name_at = F.when(F.get("words", at - 1).rlike("^[؀-ۿ]"), at + 1).otherwise(at - 1)
    cut = cut.filter("digits <> ''").withColumns({"type_at": at, "name_at": name_at}).filter((at > 0) & (name_at > 0))
    cut = cut.withColumns({"kind": kinds[F.get("words", F.col("type_at") - 1)], "spelt": F.get("words", F.col("name_at") - 1)}).filter("spelt is not null and spelt <> '|'")
    cut = materialize(cut, "cut")

    listed = districts.filter("district_id is not null").select("district_id", "name_en", "name_ar", "postcode")
    titles = listed.select("district_id", F.posexplode(F.array("name_en", "name_ar")).alias("side", "name")).filter("name is not null")
    titles = titles.select("district_id", "side", F.posexplode(_words(plain_col("name"))).alias("i", "word"))
    spelt = cut.select(F.explode(F.array_distinct("words")).alias("word")).unionByName(titles.select("word")).filter("word <> '|'").distinct()
    forms = materialize(nearest_forms(spelt, lexicon), "forms")
    by_name = titles.join(forms.hint("merge"), "word").groupBy("district_id", "side").agg(F.array_sort(F.collect_list(F.struct("i", "form"))).alias("f"))
    by_name = materialize(by_name.select(F.array_join("f.form", " ").alias("title"), "district_id").distinct(), "titles")
    titles = by_name.groupBy("district_id").agg(F.array_sort(F.collect_list("title")).alias("titles")).withColumnRenamed("district_id", "district")
    by_name = by_name.groupBy("title").agg(F.min("district_id").alias("named"), F.max("district_id").alias("last"))
    by_code = listed.filter("postcode is not null").groupBy(plain_col("postcode").alias("postcode")).agg(F.min("district_id").alias("coded"))

    coded = cut.join(small(by_code), "postcode", "left")
    words = coded.select("text", "coded", "name_at", F.posexplode("words").alias("i", "word")).filter("word <> '|' and (coded is null or i = name_at - 1)")
    said = words.join(forms.hint("merge"), "word").groupBy("text").agg(F.array_sort(F.collect_list(F.struct("i", "form", "known", "near"))).alias("f"))
    read = materialize(coded.join(said.hint("merge"), "text"), "said")
    street = F.get(F.filter("f", lambda x: x["i"] == F.col("name_at") - 1), F.lit(0))
    read = read.withColumns({"word": street["form"], "known": street["known"], "near": street["near"]})
    rest = F.filter("f", lambda x: ~x["i"].isin(F.col("name_at") - 1, F.col("type_at") - 1))
    # A misspelt word whose nearest entries disagree stands for each of them.
    ways = F.transform(rest, lambda x: F.when(x["known"] | (F.size(x["near"]) == 0), F.array(x["form"])).otherwise(x["near"]))
    joined = lambda j, n: F.aggregate(F.slice("rest", j + 2, n - 1), F.get("rest", j), lambda t, w: F.flatten(F.transform(t, lambda x: F.transform(w, lambda y: F.concat_ws(" ", x, y)))))
    run = lambda n: F.flatten(F.transform("rest", lambda x, j: F.transform(joined(j, F.lit(n)), lambda t: F.struct(F.lit(n).alias("n"), (-j).alias("j"), t.alias("title")))))
    titled = read.filter("coded is null").select("text", ways.alias("rest")).select("text", F.inline(F.concat(*map(run, (1, 2, 3, 4)))))
    titled = titled.join(small(by_name), "title").groupBy("text", "n", "j").agg(F.array_sort(F.collect_set("title")).alias("heard"), F.min("named").alias("named"), F.max("last").alias("last"))
    best = titled.groupBy("text").agg(F.max(F.struct("n", "j", "heard", F.when(F.col("named") == F.col("last"), F.col("named")).alias("named"))).alias("best")).select("text", "best.heard", "best.named")
    read = read.join(best.hint("merge"), "text", "left").withColumn("district", F.coalesce("coded", "named"))
    read = read.join(small(titles), "district", "left").withColumn("titles", F.coalesce(F.when(F.col("district").isNull(), F.col("heard")), "titles", F.array().cast("array<string>")))
    where = F.coalesce(F.concat(F.lit("d:"), "district"), F.when(F.size("titles") > 0, F.concat(F.lit("d?"), F.array_join("titles", "/"))))
    tokens = F.array_compact(F.array(F.concat(F.lit("n:"), "digits"), F.concat(F.lit("s:"), "word", F.lit("|"), "kind"), where))
    return read.select("text", tokens.alias("tokens"), "digits", "word", "known", "near", "district", "titles")


def token_weights(classes: DataFrame) -> DataFrame:
    """class, weights (map token -> rarity): the logarithm of one and how many times fewer addresses hold the token than there are; counted over all rows."""
    one = classes.select("class", "n", F.explode("tokens").alias("token"))
    total = classes.agg(F.sum("n")).first()[0] or 0
    seen = one.groupBy("token").agg(F.sum("n").alias("df"))
    weighed = one.join(seen.hint("merge"), "token")
    return weighed.groupBy("class").agg(F.map_from_entries(F.collect_list(F.struct("token", F.log(1 + F.lit(total) / F.col("df"))))).alias("weights"))


def same_address(rows: DataFrame, key: str, address: str, districts: DataFrame, names: DataFrame, overlap: float = 0.95, edits: int = 2, weigh=token_weights) -> DataFrame:
    """id_a < id_b, overlap: pairs of keys whose addresses state one building: same number, street and district.

    districts: district_id, name_en, name_ar, postcode; names: name_en, name_ar, from which (and from the districts) words are paired across languages.
    Addresses with equal tokens form a class. Classes are blocked on their sorted digits plus one rare word: the street's, and for streets that the lexicon
    does not know, the names of the district. The tokens of a blocked pair are intersected; street words left over, one of them unknown, count as shared if at most
    `edits` (and a third of their letters) apart, or if their nearest entries in the lexicon meet. What is shared must have `overlap` of the rarity (weigh) of the side that states less. Districts
    may have one name: an address that states the name without the postcode may lie in each of them, so it agrees with every address of one of them. A district
    that one side does not state counts as the same only if that number and street occur in one district alone; two stated districts of
    little rarity must still be equal. Units, shops, additional numbers and landmarks are not looked at. Null and blank addresses and those
    without a building number or a street are in no pair; repeated rows of a key count once; a key pairs with no second address of its
    own; other columns are not read. Pairs of classes are expanded to pairs of keys last; the result has as many rows as there are pairs.
    """
    lexicon = materialize(learn_lexicon(names.select("name_en", "name_ar").unionByName(districts.select("name_en", "name_ar"))), "lexicon")
    flat = rows.select(F.col(key).alias("k"), F.col(address).cast("string").alias("a")).filter("k is not null and a is not null")
    flat = materialize(flat.select("k", plain_col("a").alias("text")).filter(F.col("text").rlike(r"\d")), "plain")
    read = read_addresses(flat.select("text").distinct(), districts, lexicon)
    members = materialize(flat.join(read.hint("merge"), "text").withColumn("class", F.xxhash64("tokens")).drop("text").distinct(), "members")
    one = Window.partitionBy("digits", F.col("tokens")[1])
    classes = members.groupBy("class", "tokens", "digits", "word", "known", "near", "district", "titles").agg(F.count("*").alias("n"))
    classes = classes.withColumn("lone", F.coalesce(F.min("district").over(one) == F.max("district").over(one), F.lit(True)))
    classes = materialize(classes.join(weigh(classes).hint("merge"), "class"), "classes")

    a, b = classes.alias("a"), classes.alias("b")
    by_street = a.join(b.hint("merge"), (F.col("a.digits") == F.col("b.digits")) & (F.col("a.word") == F.col("b.word")) & (F.col("a.class") < F.col("b.class")))
    stated = F.when(F.size("titles") > 0, F.col("titles")).otherwise(F.array_compact(F.array("district")))
    said = classes.select("*", F.explode(stated).alias("title"))
    by_district = said.filter("not known").alias("a").join(said.alias("b").hint("merge"), (F.col("a.digits") == F.col("b.digits")) & (F.col("a.title") == F.col("b.title")) & (F.col("a.word") != F.col("b.word")))
    by_district = by_district.filter(F.col("b.known") | (F.col("a.class") < F.col("b.class")))

    def total(of: Column, weights: Column) -> Column:
        return F.aggregate(of, F.lit(0.0), lambda t, x: t + weights[x])

    def accepted(pairs: DataFrame) -> DataFrame:
        shared = F.array_intersect("a.tokens", "b.tokens")
        left, right = (F.filter(F.array_except(x, y), lambda t: t.startswith("s:")) for x, y in (("a.tokens", "b.tokens"), ("b.tokens", "a.tokens")))
        x, y = F.get(left, F.lit(0)), F.get(right, F.lit(0))
        apart = F.levenshtein("a.word", "b.word")
        close = (F.substring_index(x, "|", -1) == F.substring_index(y, "|", -1)) & (((apart <= edits) & (apart * 3 <= F.length("b.word"))) | F.arrays_overlap("a.near", "b.near"))
        spelt = F.when(~(F.col("a.known") & F.col("b.known")) & close, F.least(F.col("a.weights")[x], F.col("b.weights")[y])).otherwise(0.0)
        least = F.least(total(F.col("a.tokens"), F.col("a.weights")), total(F.col("b.tokens"), F.col("b.weights")) + F.lit(0.0))
        where = [F.get(F.filter(F.array_except(x, y), lambda t: t.startswith("d")), F.lit(0)) for x, y in (("a.tokens", "b.tokens"), ("b.tokens", "a.tokens"))]
        met = F.col("a.district").isNull() | F.col("b.district").isNull()
        named = F.when(met & F.arrays_overlap("a.titles", "b.titles"), F.least(F.col("a.weights")[where[0]], F.col("b.weights")[where[1]])).otherwise(0.0)
        scored = pairs.withColumn("overlap", F.least(F.lit(1.0), F.try_divide(total(shared, F.col("a.weights")) + spelt + F.coalesce(named, F.lit(0.0)), least))).filter(F.col("overlap") >= overlap)
        both = (F.size("a.titles") > 0) & (F.size("b.titles") > 0)
        place = F.coalesce(F.col("a.district") == F.col("b.district"), F.when(both, F.arrays_overlap("a.titles", "b.titles")), F.col("a.lone") & F.col("b.lone"))
        return scored.filter(place).select(F.col("a.class").alias("ca"), F.col("b.class").alias("cb"), "overlap")

    alike = accepted(by_street).unionByName(accepted(by_district)).groupBy("ca", "cb").agg(F.max("overlap").alias("overlap"))
    who = members.select("k", "class")
    across = alike.join(who.select(F.col("class").alias("ca"), F.col("k").alias("ka")).hint("merge"), "ca").join(who.select(F.col("class").alias("cb"), F.col("k").alias("kb")).hint("merge"), "cb")
    firm = classes.filter("(district is not null or size(titles) > 0 or lone) and n > 1").select("class")
    inner = who.join(firm.hint("merge"), "class")
    within = inner.alias("a").join(inner.alias("b").hint("merge"), (F.col("a.class") == F.col("b.class")) & (F.col("a.k") < F.col("b.k")))
    within = within.select(F.col("a.k").alias("id_a"), F.col("b.k").alias("id_b"), F.lit(1.0).alias("overlap"))
    across = across.filter("ka <> kb").select(F.least("ka", "kb").alias("id_a"), F.greatest("ka", "kb").alias("id_b"), "overlap")
    return within.unionByName(across).groupBy("id_a", "id_b").agg(F.max("overlap").alias("overlap"))

"""Survivors, addresses and entity matching."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from atlasmill.llm import matching
from atlasmill.llm.addresses import learn_lexicon, nearest_forms, plain, read_addresses, same_address, token_weights
from atlasmill.llm.matching import BUCKETS, DIM, Names, calibrate_cosine, candidates, core_name, fit_logistic, match_records, mend_places, phone_number, skip_gram, trigrams
from atlasmill.llm.survivors import credible_texts, quality_model, survivors, true_values

T = dt.datetime(2026, 1, 1)
MEMBER = "group string, field string, source_key string, source string, harvested_at timestamp, value string, skeleton string, weight double, p_true double, text string"


def members(spark, rows, field="name_ar"):
    return spark.createDataFrame([(g, field, k, s, T + dt.timedelta(days=d) if d is not None else None, v, "x", 9.0, 9.0, "t") for g, k, s, d, v in rows], MEMBER)


SHOPS = "نخيل كوثر رمال مشكاة زيتون فنار سلوان بدرية جمانة وسام حكمة ليان سحاب رواد قنديل غيمة".split()


def confirmed(n=16):
    """Groups whose members agree but for one that holds the same stand-in in each."""
    rows = []
    for i in range(n):
        name = f"صيدلية {SHOPS[i % 16]} و{SHOPS[(i + 3) % 16]}"
        rows += [(f"c{i}", f"lo:c{i}", "lo", 1, name), (f"c{i}", f"mid:c{i}", "mid", 2, name.replace("ي", "يي", 1)), (f"c{i}", f"hi:c{i}", "hi", 9, "غير معروف")]
    return rows


def test_survivors(spark):
    sources = spark.createDataFrame([("hi", 0.9), ("lo", 0.4), ("none", None), ("mid", 0.5)], "name string, reliability_weight double")
    rows = members(spark, confirmed() + [
        ("win", "hi:1", "hi", 2, "صيدلية نخيل"), ("win", "lo:1", "lo", 1, "صيدلية النخيل"), ("win", "lo:2", "lo", 9, "TBD"),
        ("late", "hi:1", "hi", 1, "اسم واحد"), ("late", "lo:1", "lo", 2, "اسم اثنان"), ("only", "lo:1", "lo", None, "اسم ثلاثة"), ("only", "hi:1", "hi", 3, "غير معروف"),
        ("tie", "mid:1", "mid", 2, "اسم اربعة"), ("tie", "none:1", "none", 1, "اسم اربعة"), ("date", "hi:1", "hi", 1, "اسم خمسة"), ("date", "lo:1", "lo", 1, "اسم خمسة"),
        ("odd", "hi:1", "hi", 2, "ﺻﻴﺪﻟﻴﺔ"), ("odd", "hi:1", "hi", 2, "ﺻﻴﺪﻟﻴﺔ ﻧﺨﻴﻞ"), ("blank", "hi:1", "hi", 1, " ​"), ("blank", "lo:1", "lo", 1, None), (None, "hi:1", "hi", 1, "اسم"),
        ("dup", "hi:1", "hi", 3, "اسم ستة"), ("dup", "hi:1", "hi", 3, "اسم ستة"), ("dup", "lo:1", "lo", 1, "اسم ستة"),
    ])
    got = {r["group"]: r for r in survivors(rows, sources).collect()}
    assert {g for g, r in got.items() if r["dominant"]} == {"win", "only", "odd", "dup", *(f"c{i}" for i in range(16))}
    assert set(got) == {"win", "late", "only", "tie", "date", "odd", "dup", *(f"c{i}" for i in range(16))}
    assert got["win"]["source_key"] == "hi:1" and got["only"]["source_key"] == "lo:1" and got["dup"]["source_key"] == "hi:1"
    assert all(got[f"c{i}"]["source_key"] == f"mid:c{i}" for i in range(16)), "the stand-in was recognised without a list of words"
    every = lambda claims, rounds: credible_texts(claims, rounds).withColumn("credible", F.lit(1.0))
    blind = {r["group"]: r["source_key"] for r in survivors(rows, sources, judge=every).collect()}
    assert blind["only"] == "hi:1" and blind["c0"] == "hi:c0", "without the posterior the stand-ins survive"
    assert survivors(rows.limit(0), sources).count() == 0
    kept = {(r["group"], r["value"]) for r in true_values(rows, sources).collect()}
    assert ("late", "اسم واحد") in kept and ("c0", "غير معروف") not in kept
    hours = members(spark, [(f"h{i}", f"{s}:{i}", s, d, v) for i in range(9) for s, d, v in (("hi", 2, "24/7"), ("lo", 1, f"0{i}:00-22:00"), ("mid", 5, "ask in store"))], "hours")
    assert {r["source_key"] for r in survivors(hours, sources).filter("dominant").collect()} == {f"hi:{i}" for i in range(9)}, "values that nobody confirms are kept where nothing is confirmed"


def test_quality_model_finds_the_liar_and_keeps_two_truths(spark):
    rng = random.Random(1)
    claims = []
    for i in range(400):
        for s in ("good1", "good2", "good3"):
            if rng.random() < 0.9:
                claims.append((f"g{i}", "f", "true", s))
            if rng.random() < 0.8 and i % 2:
                claims.append((f"g{i}", "f", "also", s))
        claims.append((f"g{i}", "f", f"lie{rng.randrange(9)}", "liar"))
    df = spark.createDataFrame(claims, "group string, field string, value string, source string")
    judged, quality = quality_model(df, rounds=8)
    p = {(r["group"], r["value"]): r["llr"] for r in judged.collect()}
    truths, lies = [v for k, v in p.items() if not k[1].startswith("lie")], [v for k, v in p.items() if k[1].startswith("lie")]
    assert np.mean([v > 0 for v in truths]) > 0.9 and np.mean([v < 0 for v in lies]) > 0.9
    assert quality["f", "liar"][1] < min(quality["f", s][1] for s in ("good1", "good2", "good3"))


DISTRICTS = [("d1", "Burj Al Shaheen", "برج الشاهين", "42886"), ("d2", "Al Zaytun", None, "60730"), ("d3", "Wadi Al Rawasi", "وادي الرواسي", "21768")]
NAMES = [("Kawthar Pharmacy", "صيدلية كوثر"), ("Raihan Misk Pharmacy", "صيدلية ريحان ومسك"), ("Mishkat Pharmacy", "صيدلية مشكاة"), ("Al Zaytun Pharmacy", "صيدلية الزيتون")]


def place_tables(spark):
    districts = spark.createDataFrame(DISTRICTS, "district_id string, name_en string, name_ar string, postcode string")
    return districts, spark.createDataFrame(NAMES, "name_en string, name_ar string")


def test_lexicon_and_nearest_entries(spark):
    districts, names = place_tables(spark)
    lexicon = learn_lexicon(names.unionByName(districts.select("name_en", "name_ar")))
    forms = dict(tuple(r) for r in lexicon.collect())
    assert forms["كوثر"] == "kawthar" and forms["مسك"] == "misk" and forms["برج"] == "burj" and forms["raihan"] == "raihan" and "صيدليه" not in forms
    words = spark.createDataFrame([(w,) for w in ("mishkta", "rihan", "كوثر", "كوتر", "unheard", "x")], "word string")
    got = {r["word"]: (r["form"], r["known"]) for r in nearest_forms(words, lexicon).collect()}
    assert got == {"mishkta": ("mishkat", True), "rihan": ("raihan", True), "كوثر": ("kawthar", True), "كوتر": ("kawthar", True), "unheard": ("unheard", False), "x": ("x", False)}
    assert nearest_forms(words, lexicon.limit(0)).filter("known").count() == 0


SAME = (
    "P.C. 42886, 8539 Raihan St.", "8539 raihan street burj al shaheen riyadh 42886", "BURJ AL SHAHEEN DISTRICT / RAIHAN STREET / 8539 / 42886", "Shop 33, 8539 Rihan Street, Burj Al Shaheen, Riyadh, KSA 42886",
    "Bldg 8539, Raihan St, Burj Al Shahen, Riyadh 42886-3597", "Raihan St No. 8539, Burj Al Shaheen, Riyadh", "Riyadh 42886, Burj Al Shaheen District, Raihan Str. 8539", "مبنى رقم ٨٥٣٩، شارع ريحان، الرمز البريدي ٤٢٨٨٦",
    "الرياض - حي برج الشاهين - شارع ريحان - مبنى 8539", "8539 شارع ريحان، حي برج الشاهين، الرياض 42886‏", "next to the post office, 8539 Raihan St, Burj Al Shaheen 42886", "  8539  Raihan  Street, Burj  Al  Shaheen Dist., Riyadh 42886\t",
)
NOT = ("", " ", "Riyadh 42886", "Raihan Street, Riyadh", "حي برج الشاهين، الرياض", "near the metro stop", "x" * 100_000, "12 " * 20_000, "street")


def test_address_reading(spark):
    districts, names = place_tables(spark)
    lexicon = learn_lexicon(names.unionByName(districts.select("name_en", "name_ar")))
    texts = spark.createDataFrame([(plain(t),) for t in SAME + NOT], "text string").distinct()
    got = {r["text"]: r for r in read_addresses(texts, districts, lexicon).collect()}
    assert set(got) == {plain(t) for t in SAME}
    assert {tuple(r["tokens"]) for r in got.values()} == {("n:8539", "s:raihan|street", "d:d1")}


def test_same_address(spark):
    rows = [
        ("a", "P.C. 42886, 8539 Raihan St."), ("b", "مبنى رقم ٨٥٣٩، شارع ريحان، الرمز البريدي ٤٢٨٨٦"), ("c", "8539 Raihan Street, Wadi Al Rawasi, Riyadh 21768"), ("d", "8539 Misk Street, Burj Al Shaheen 42886"),
        ("e", "8539 Raihan Road, Burj Al Shaheen 42886"), ("f", "Raihan Street, Burj Al Shaheen"), ("g", None), ("h", ""), ("i", "8539 Raehan Str, Burj Al Shaheen 42886"), ("a", "P.C. 42886, 8539 Raihan St."), (None, "P.C. 42886, 8539 Raihan St."),
        ("j", "12 Kawthar Lane, Al Zaytun 60730"), ("k", "12 Kawthar Ln, الزيتون"), ("l", "12 Kawthar Ln"), ("m", "77 Qwertz Street, Al Zaytun 60730"), ("n", "77 Qwerts Street, Al Zaytun 60730"), ("o", "77 Qabcn Street, Al Zaytun 60730"),
    ]
    df = spark.createDataFrame([(k, a, "s", "n", "w") for k, a in rows], "id string, address string, street string, number string, word string")
    pairs = lambda **kw: {(r["id_a"], r["id_b"]) for r in same_address(df, "id", "address", *place_tables(spark), **kw).collect()}
    want = {("a", "b"), ("a", "i"), ("b", "i"), ("j", "k"), ("j", "l"), ("k", "l"), ("m", "n")}
    assert pairs() == want
    assert pairs(overlap=0.1) > want, "the weights reject pairs of a block"
    one = lambda classes: token_weights(classes).withColumn("weights", F.transform_values("weights", lambda t, w: F.when(t.startswith("d:"), 1.0).otherwise(0.0)))
    assert pairs(weigh=one) != want, "with all weight on the district, kinds of streets tell nothing apart"
    assert same_address(df.limit(0), "id", "address", *place_tables(spark)).count() == 0
    districts, names = place_tables(spark)
    bare = same_address(df, "id", "address", districts.limit(0), names.limit(0))
    assert ("a", "b") not in {(r["id_a"], r["id_b"]) for r in bare.collect()}


def test_districts_of_one_name_and_misread_names(spark):
    districts = spark.createDataFrame([("d1", "Burj Al Misk", "برج المسك", "42886"), ("d2", "Burj Al Misk", "برج المسك", "60730"), ("d3", "Hazm Al Kawthar", None, "21768"), ("d4", "Hazm Al Raihan", "حزم الريحان", "31768"), ("d5", "Hazm Al Layan", "حزم الليان", "41768")], "district_id string, name_en string, name_ar string, postcode string")
    names = spark.createDataFrame([*NAMES, ("Layan Pharmacy", "صيدلية ليان")], "name_en string, name_ar string")
    rows = [
        ("a", "12 Kawthar Street, Burj Al Misk, Riyadh"), ("b", "12 Kawthar Street, Burj Al Misk 60730"), ("c", "مبنى 12، شارع كوثر، برج المسك"), ("d", "P.C. 42886, 77 Kawthar Str."), ("e", "77 Kawthar Street, Burj Al Misk, Riyadh"), ("f", "77 Kawthar Street, Hazm Al Kawthar, Riyadh"),
        ("g", "9 Mishkat Lane, Burj Al Misk 42886"), ("h", "9 Mishkat Lane, Burj Al Misk 60730"), ("i", "5 Raihan Road, Burj Al Misk"), ("j", "5 Raihan Road, Hazm Al Kawthar"), ("k", "الرياض - حي برج السك - طريق ريحان - مبنى 5"), ("l", "P.C. 60730, 12 Kawthr Street"), ("m", "3 Qwertz Street, Burj Al Misk"), ("n", "3 Qwerts Street, Burj Al Misk 60730"),
        ("o", "الرياض - حي حزم الريان - شارع كوثر - مبنى 44"), ("p", "44 Kawthar Street, Hazm Al Raihan 31768"), ("q", "44 Kawthar Street, Hazm Al Kawthar 21768"),
    ]
    df = spark.createDataFrame(rows, "id string, address string")
    got = {(r["id_a"], r["id_b"]) for r in same_address(df, "id", "address", districts, names).collect()}
    assert got == {("a", "b"), ("a", "c"), ("b", "c"), ("a", "l"), ("b", "l"), ("c", "l"), ("d", "e"), ("i", "k"), ("m", "n"), ("o", "p")}


def test_names_and_phones():
    assert core_name("Al Kawthar Pharmacy", False) == core_name("El Kauthar pharmacy", False) == ("kauthar", None)
    assert core_name("Pharmacy Dawhat Murooj #37", False) == ("dauhat muruj", 37) and core_name("TBD", False) == ("", None) and core_name(None, True) == ("", None)
    assert core_name("صیدلیة الکوثر فرع 5", True) == (core_name("صيدلية الكوثر", True)[0], 5) and core_name("Pharmacy", True) == ("", None)
    assert phone_number("+966 11 166 0567 ext. 3") == phone_number("tel: ٠١١.١٦٦.٠٥٦٧") == phone_number("00966-11-1660567") == "111660567" and phone_number("12") is None


def test_fits():
    rng = np.random.default_rng(0)
    x = np.column_stack([np.ones(400), rng.standard_normal(400)])
    y = (x[:, 1] > 0.3).astype(float)
    assert (((1 / (1 + np.exp(-x @ fit_logistic(x, y)))) > 0.5) == y).mean() > 0.95
    pairs = np.array([(1, 2), (2, 1), (1, 2)] * 300 + [(3, 4), (4, 3)] * 300, dtype=np.int32)
    v = skip_gram(pairs, np.random.default_rng(1), epochs=10, batch=64)
    assert v.shape[0] > 4 and np.isfinite(v).all()


def shops(spark, n, groups):
    rng = random.Random(6)
    words = ["nakheel", "kawthar", "rimal", "mishkat", "zaytun", "anfal", "fanar", "silwan", "badriya", "jumanah", "wisam", "hikmah", "layan", "oryx", "sahab", "ruwad"]
    arabic = dict(zip(words, "نخيل كوثر رمال مشكاة زيتون أنفال فنار سلوان بدرية جمانة وسام حكمة ليان أوريكس سحاب رواد".split()))
    left, right, pairs, labels = [], [], set(), []
    for i in range(n):
        a, b = rng.sample(words, 2)
        y, x, phone = 24.6 + rng.random() * 0.3, 46.6 + rng.random() * 0.3, f"011{rng.randrange(10**6, 10**7)}"
        en, ar = f"{a.title()} {b.title()} Pharmacy", f"صيدلية {arabic[a]} و{arabic[b]}"
        left.append((f"l{i}", en, ar, phone if i % 9 else None, y, x, f"L:l{i}"))
        right.append((f"r{i}", en.replace("ee", "i") if i % 2 else None, ar if i % 3 == 0 or not i % 2 else None, phone if i % 4 else None, (x if i % 11 == 0 else y + 0.0001), (y if i % 11 == 0 else x), f"R:r{i}"))
        if i < groups:
            labels += [(f"e{i}", f"L:l{i}"), (f"e{i}", f"R:r{i}")]
        else:
            pairs.add((f"l{i}", f"r{i}"))
    schema = "id string, name_en string, name_ar string, phone string, lat double, lon double, source_key string"
    return spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), spark.createDataFrame(labels, "entity_id string, source_key string"), pairs


def test_places_are_mended_by_where_most_rows_lie(spark):
    rng = random.Random(2)
    rows = [(f"c{i}", 24.6 + rng.random() * 0.3, 46.6 + rng.random() * 0.3) for i in range(900)] + [(f"t{i}", 27.7 + rng.random() * 0.1, 49.7 + rng.random() * 0.1) for i in range(9)]
    rows += [(f"s{i}", 46.7, 24.7) for i in range(20)] + [("scaled", 247.1, 46.7), ("zero", 0.0, 0.0), ("far", 999.0, 46.7), ("null", None, 46.7), ("nan", float("nan"), 1.0), ("lonely", -33.0, 151.0)]
    got = {r["k"]: (r["y"], r["x"]) for r in mend_places(spark.createDataFrame(rows, "k string, lat double, lon double")).collect()}
    assert all(got[f"t{i}"] == (rows[900 + i][1], rows[900 + i][2]) for i in range(9)), "a town of one in a hundred rows stays where it is"
    assert got["lonely"] == (-33.0, 151.0) and all(got[f"s{i}"] == (24.7, 46.7) for i in range(20))
    assert got["scaled"] == (24.71, 46.7)
    assert all(got[k] == (None, None) for k in ("zero", "far", "null", "nan"))
    assert mend_places(spark.createDataFrame([], "k string, lat double, lon double")).count() == 0


def test_a_second_town_and_a_shared_phone_lose_no_pairs(spark):
    left, right, groups, want = shops(spark, 700, 300)
    town = [f"{i}" for i in range(640, 650)]  # one and a half in a hundred
    moved = F.substring("id", 2, 9).isin(*town)
    away = lambda d, phones: d.withColumns({"lat": F.when(moved & (F.col("lat") < 40), F.col("lat") + 3).when(moved, F.col("lat") + 3).otherwise(F.col("lat")), "lon": F.when(moved, F.col("lon") + 3).otherwise(F.col("lon")), "phone": F.when(moved & F.lit(not phones), None).otherwise(F.col("phone"))})
    for phones in (True, False):
        got = {(r["id"], r["alt_id"]) for r in match_records(away(left, phones), away(right, phones), groups).collect()}
        kept = {(f"l{t}", f"r{t}") for t in town if phones or int(t) % 11} & want
        assert len(kept & got) >= 0.95 * len(kept), (phones, kept - got)
    centre = lambda d: d.withColumn("phone", F.when(F.substring("id", 2, 9).cast("int") % 5 == 0, "920001418").otherwise(F.col("phone")))
    got = {(r["id"], r["alt_id"]) for r in match_records(centre(left), centre(right), groups).collect()}
    assert len(want & got) >= 0.95 * len(want) and len(got - want) <= 0.05 * len(want)


def test_recall_falls_without_walks(spark):
    left, right, groups, want = shops(spark, 500, 250)
    late = F.substring("id", 2, 9).cast("int") >= 250
    left = left.withColumns({c: F.when(~late, F.col(c)) for c in ("name_ar", "phone")})
    right = right.withColumns({c: F.when(~late, F.col(c)) for c in ("name_en", "phone")}).filter("name_ar is not null or name_en is not null")
    there = {r["id"][1:] for r in right.collect()}
    cross = {p for p in want if p[1][1:] in there}
    blocked = lambda train: len(cross & {(r["id"], r["alt_id"]) for r in candidates(left, right, groups, train).collect()}) / len(cross)
    untrained = lambda pairs, rng, weights=None: skip_gram(np.zeros((0, 2), int), rng)
    assert blocked(skip_gram) > 1.3 * blocked(untrained), "an English and an Arabic name meet only in the trained space"


def test_names_and_calibration():
    rng = np.random.default_rng(0)
    made = Names(rng.standard_normal((BUCKETS, DIM)).astype(np.float32), np.ones(BUCKETS, dtype=np.float32))
    import pandas as pd

    v = made.records(pd.Series(["kauthar", "", None]), pd.Series(["", "", ""]))
    u = made.tokens[trigrams("kauthar")].sum(axis=0)
    assert np.allclose(v[0], u / np.linalg.norm(u), atol=1e-5) and not v[1:].any()
    cosine = rng.random(500)
    w = calibrate_cosine(np.append(cosine, np.nan), np.append(cosine > 0.7, False).astype(float))
    odds = np.column_stack([np.ones(3), [0.1, 0.7, 0.95], [0.01, 0.49, 0.9025], np.zeros(3)]) @ w
    assert odds[0] < odds[1] < odds[2] and odds[0] < 0 < odds[2]


def test_match_records_held_out(spark):
    left, right, groups, want = shops(spark, 400, 250)
    extra = lambda d: d.withColumns({"side": F.lit("x"), "k": F.lit("y"), "bits": F.lit(1)})
    got = {(r["id"], r["alt_id"]): r["confidence"] for r in match_records(extra(left), extra(right), groups).collect()}
    assert len(want & set(got)) >= 0.95 * len(want) and len(set(got) - want) <= 0.05 * len(want) and all(0.5 <= c <= 1 for c in got.values())


def test_match_records_edges(spark):
    left, right, groups, _ = shops(spark, 5, 0)
    assert match_records(left.limit(0), right, groups).count() == 0 and match_records(left, right.limit(0), groups).count() == 0
    nulls = spark.createDataFrame([("n", None, None, None, None, None, None), (None, "A", "ب", "1", 1.0, 1.0, "x"), ("z", "", " ", "", 0.0, 0.0, "y"), ("w", "W" * 50_000, None, "011", 999.0, float("nan"), "z")], left.schema)
    assert match_records(left.unionByName(nulls), right.unionByName(nulls), groups).filter("id in ('n', 'z')").count() == 0


def test_a_full_block_of_one_phone_loses_no_pairs(spark, monkeypatch):
    left, right, groups, _ = shops(spark, 400, 250)
    late = F.substring("id", 2, 9).cast("int") >= 250
    one = F.substring("id", 2, 9).cast("int") % 5 == 0
    rows = lambda d, k: d.withColumns({"phone": F.when(one, "920001418").otherwise(F.col("phone")), "lat": F.when(~(late & one), F.col("lat")), "name_en": F.when(late & one, "Kawthar Rimal Pharmacy").otherwise(F.col("name_en")), "name_ar": F.when(late & one, "صيدلية كوثر ورمال").otherwise(F.col("name_ar"))})
    left, right = rows(left, "l"), rows(right, "r")
    run = lambda: {(r["id"], r["alt_id"]): r["confidence"] for r in match_records(left, right, groups, least=0.02).collect()}
    monkeypatch.setattr(matching, "SHARED", 10)
    whole = run()
    monkeypatch.setattr(matching, "HOT_BLOCK", 12)
    split = run()
    shared = {(f"l{i}", f"r{j}") for i in range(250, 400, 5) for j in range(250, 400, 5)}
    assert shared <= set(whole) and shared <= set(split), (len(shared & set(whole)), len(shared & set(split)))

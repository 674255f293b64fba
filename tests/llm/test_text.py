"""Confusables, tokenizer, leakage and personal information."""

import random
import string

import numpy as np
import pytest
import tiktoken

from atlasmill.llm.bpe import PATTERN, RANKS_PATH, Encoder, encode_corpus
from atlasmill.llm.confusables import matches_register, skeleton_groups
from atlasmill.llm.leakage import COSINE, RUN, WIDTH, Retrieval, _Numbers, latent_basis, lcs_lengths, leaks, longest_run, passages, words
from atlasmill.llm.pii import GIVEN_NAMES, check_digit, find_pii, learn_names, mentions, people_in, redact

DOC = "doc_id long, text string, item_id long, ids string, k string, kind string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, 7, "x", "y", "z") for i, t in enumerate(texts)], DOC)


def test_register_matches(spark):
    reg = spark.createDataFrame([(1, "Nakheel Pharmacy", "صيدلية النخيل"), (2, "Élan", None), (3, "", " ")], "name_id long, name_en string, name_ar string")
    rows = spark.createDataFrame([
        ("same", "Nakheel Pharmacy", "صيدلية النخيل", "x"), ("look", "Nаkheel　Ｐharmacy", "صیدلیة النخیل‏", "x"), ("case", "nakheel pharmacy", "صيدليه النخيل", "x"),
        ("nfd", "E\u0301lan", None, "x"), ("blank", "​", "", "x"), ("null", None, None, "x"), ("look", "Nаkheel　Ｐharmacy", None, "x"), ("long", "Nakheel " * 20_000, "ب", "x"), (None, "Nаkheel Pharmacy", None, "x"),
    ], "id string, name_en string, name_ar string, skeleton string")
    got = {tuple(r) for r in matches_register(rows, "id", reg, "name_id", ["name_en", "name_ar"]).collect()}
    assert got == {("look", "name_en", 1), ("look", "name_ar", 1), ("nfd", "name_en", 2), (None, "name_en", 1)}
    assert matches_register(rows.limit(0), "id", reg, "name_id", ["name_en"]).count() == 0
    assert matches_register(rows, "id", reg.limit(0), "name_id", ["name_en"]).count() == 0


def test_skeleton_groups(spark):
    rows = spark.createDataFrame([("abc",), ("аbc",), ("abc",), ("ABC",), (None,), ("​",)], "text string")
    got = {r["original"]: (r["skeleton"], r["n_rows"], r["n_originals"]) for r in skeleton_groups(rows).collect()}
    assert got == {"abc": ("abc", 2, 2), "аbc": ("abc", 1, 2), "ABC": ("ABC", 1, 1)}
    assert skeleton_groups(rows.limit(0)).count() == 0


@pytest.fixture(scope="module")
def encoder():
    return Encoder(open(RANKS_PATH, "rb").read())


def test_bpe_equals_public_encoder(encoder):
    ref = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    rng = random.Random(4)
    texts = [None, "", " ", "\n\n\t ", "<|endoftext|>", "it's we'll 123", "صيدلية النخيل 🙂👍🏽", "a" * 30_000, "ab" * 9_999, "  x  " * 2000]
    texts += ["".join(rng.choice(string.printable + "éßقم中🙂") for _ in range(rng.randrange(400))) for _ in range(200)]
    texts += ["".join(rng.choice("abc") for _ in range(3000)) for _ in range(5)]
    for t in texts:
        assert encoder.encode(t) == ref.encode_ordinary(t or "")


def test_encode_corpus(spark, encoder):
    texts = ["hello world", "", None, "hello world"]
    got = {r["doc_id"]: r["ids"] for r in encode_corpus(docs(spark, texts), "doc_id", "text").collect()}
    assert got == {i: encoder.encode(t) for i, t in enumerate(texts)} and got[1] == got[2] == []
    assert dict(encode_corpus(docs(spark, []), "doc_id", "text").dtypes)["ids"] == "array<int>"


ITEM = "the auditor reopens a torn walnut receipt after the rota was exchanged so that copper outranks lantern in round 362 and then leaves velvet beside ember in round 17"


def test_leaks_equal_brute_force(spark):
    rng = random.Random(9)
    pool = ITEM.split() + [f"filler{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.randrange(12, 60))) if i else ITEM) for i in range(12)] + [(90, None), (91, ""), (92, "too short")]
    item_words = [(k, t.split()) for k, t in items if t]
    texts = [None, "", " \n", "word " * 30_000]
    for _ in range(150):
        body = [rng.choice(pool) for _ in range(rng.randrange(5, 90))]
        k, w = rng.choice(item_words)
        n = rng.randrange(8, 17)
        if len(w) >= n:
            o = rng.randrange(len(w) - n + 1)
            cut = w[o : o + n]
            body[rng.randrange(len(body)) :] = [x.upper() if rng.random() < 0.2 else x + rng.choice(["", ",", "."]) for x in cut] + body[:30]
        texts.append(rng.choice([" ", "\n", " ", "  "]).join(body))
    texts.append(texts[-1])
    want = set()
    for d, t in enumerate(texts):
        w = words(t)
        grams = {tuple(w[i : i + 12]) for i in range(len(w) - 11)}
        want |= {(d, k) for k, v in item_words for i in range(len(v) - 11) if tuple(v[i : i + 12]) in grams}
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaks(docs(spark, texts), frame).filter("kind = 'verbatim'").collect()}
    assert got == want and len(want) > 30


def test_leaks_paraphrase_and_empty(spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    swapped = ITEM.replace("torn ", "").replace("leaves ", "").replace("receipt after", "receipt just after").replace("outranks", "really outranks").replace(" in round 362", " 362")
    got = {r["doc_id"]: r["kind"] for r in leaks(docs(spark, [swapped, "nothing like it"]), items).collect()}
    assert got.get(0) == "paraphrase" and 1 not in got
    assert leaks(docs(spark, []), items).count() == 0 and leaks(docs(spark, ["x"]), items.limit(0)).count() == 0


def test_rows_come_through_the_latent_space(spark):
    """With the singular vectors of another corpus, or any fewer that do not carry the wording, the same leaks are no longer retrieved."""
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 300, 60).astype(np.int32) for _ in range(30)]
    docs = spark.createDataFrame([(i, t[5:40].tolist()) for i, t in enumerate(texts)], "k long, w array<int>")
    p = passages(texts[4][5:40], WIDTH, WIDTH - RUN)

    def found(basis):
        r = Retrieval(texts, idf, basis)
        i, j, near = r.candidates(p, COSINE)
        return set(r.owner[j[r.verbatim(p, i, j)]]), len(i)

    idf, basis = latent_basis(docs, 300)
    one, some = found(basis)
    assert one == {4} and some < 0.02 * len(p) * 30 * 12
    foreign = np.linalg.qr(rng.standard_normal((300, 96)))[0][:, :2].astype(np.float32)
    _, many = found(foreign)
    assert many > 5 * some, "two directions that mean nothing tell nothing apart"
    hidden = basis.copy()
    hidden[texts[4]] = 0
    assert found(hidden)[0] == set()


def test_numbers_remember_spellings():
    n = _Numbers({"cat": 0, "12": 1, "محمد": 2})
    for t in ("The CAT, it’s  «مُحَمَّد» １２", "c\u200bat\u00a0cat\tcat-12"):
        assert n.read(t).tolist() == [n.vocabulary.get(w, -1) for w in words(t)]


def test_runs_and_subsequences():
    a, b = np.array([1, 2, 3, -1, 4, 5]), [np.array([9, 1, 2, 3, 4, 5, -1]), np.array([4, 5, 1])]
    assert [longest_run(a, x) for x in b] == [3, 2]
    assert lcs_lengths(np.array([[1, 2, 3, 4], [-1, 5, -1, 6]]), np.array([[1, 3, 9, 4], [5, 6, -1, -1]])).tolist() == [3, 2]
    assert [len(passages(np.arange(n), 16, 4)) for n in (0, 5, 16, 17, 20, 21)] == [1, 1, 1, 2, 2, 3] and passages(np.arange(17), 16, 4)[1].tolist()[-3:] == [-1, -1, -1]
    assert words("The CAT, it’s  «مُحَمَّد» １２") == ["the", "cat", "it", "s", "محمد", "12"]


def kinds(text):
    return [(k, text[a:b]) for k, a, b in find_pii(text)]


def test_pii_kinds():
    assert kinds("Write to jo.x+rx@mail.example now") == [("email", "jo.x+rx@mail.example")]
    assert kinds("mail=usman dot gh [at] letters dot invalid; x") == [("email", "usman dot gh [at] letters dot invalid")]
    assert kinds("Either FARIS74＠EXAMPLE.COM or none") == [("email", "FARIS74＠EXAMPLE.COM")]
    assert kinds("the build tag is release@4.0. Follow @rx_shop at 12:30.") == []
    for p in ("+966 52 807 5081", "(011) 057-1501", "052.226.0377", "00966 11 0611485", "٠٥٢ ٨ ٦٦ ٦٩ ٢١", "+٩٦٦١١١٣٤٧٦٨٥", "+966 11 089 6601"):
        assert kinds(f"call {p}, please") == [("phone", p)]
    assert kinds("hotline 920 00670 and order 1123440140 and 24.71361, 46.67530") == []
    for n in ("1008364794", "2031 956 010", "1-476-470-503", "11637.54698", "٢-٣٦٠-١٢٣-٨٦٩"):
        assert kinds(f"id:{n} | x") == [("id_number", n)]
    assert kinds("batch 1008364795 or 31008364794") == [] and check_digit("1008364794") and not check_digit("1008364795")
    for a, start in (("Bldg 7462, Qaysum Lane, Burj", "Bldg"), ("1372 shaheen avenue, riyadh", "1372"), ("Nawras Avenue 7614, Apt 2", "Nawras"), ("شارع حياة مبنى 3798 حي", "شارع"), ("4701 ممر شروق، حي", "4701"), ("مبنى رقم 3398، طريق غيمة", "مبنى")):
        got = kinds(f"goes to {a} x")
        assert len(got) == 1 and got[0][0] == "address" and got[0][1].startswith(start), (a, got)
    assert kinds("A hatch facing Rimal Avenue. On Oryx Road 2026-01-04; 280 مترا من شارع قنديل.") == []
    for n in ("Sara M. Al-Bukhtami", "Marco Joseph Van Drusel", "OMAR AL-ZUBQANI", "AL-TUFAYHI, Rania", "VAN DRUSEL, Tarek", "وفاء نواف بن هرثوم", "ماجد كالبافينكو"):
        assert kinds(f"by {n} without"), n
        assert kinds(f"by {n} without")[0] == ("person_name", n), (n, kinds(f"by {n} without"))
    assert kinds("Harith Pharmacy and Salma Street are places; Omar left. salma.hajzumi") == []


def test_pii_positions_edges_and_redaction(spark):
    text = "👍​ call +966 52 807 5081​ or a@b.example"
    (one, two) = find_pii(text)
    assert text[one[1]] == "+" and text[two[1] : two[2]] == "a@b.example"
    assert redact(text) == "👍​ call <PHONE>​ or <EMAIL>" and redact(None) is None and redact("") == ""
    for t in (None, "", " ", "1" * 50_000, "@" * 5_000, "at " * 20_000, "Omar " * 5_000):
        assert find_pii(t) == []
    rows = docs(spark, [text, None, "", text])
    got = sorted(tuple(r)[:3] for r in mentions(rows, "doc_id", "text").collect())
    assert got == [(0, "email", two[1] + 1), (0, "phone", one[1] + 1), (3, "email", two[1] + 1), (3, "phone", one[1] + 1)]
    assert mentions(docs(spark, []), "doc_id", "text").count() == 0


def test_given_names_are_learned_from_cues(spark):
    rng = random.Random(5)
    given, family = ["Zorvan", "Quilla", "Mirela", "Tashko"], ["Al-Hamdi", "Brennock", "Ostrava", "Lindqvist"]
    texts, want = [], set()
    for i in range(120):
        g, f = rng.choice(given), rng.choice(family)
        cue = rng.choice(["Dr ", "Customer ", "Signed, ", "Photo taken by ", "name="]) if i % 3 else "The counter saw "
        texts.append(f"Stock was low. {cue}{g} {f} left. The Ostrava Pharmacy on Brennock Street is open.")
        want.add((i, texts[-1].index(f"{g} {f}") + 1))
    texts += ["قالت هذه المراجعة نعم", None, "", "by the way by car", "باسم سندس الغامدي", "رأت سندس الغامدي ذلك", "باسم سندس الغامدي", "مرحبا سندس الغامدي"]
    frame = docs(spark, texts)
    assert set(learn_names(frame)) == {*(g.lower() for g in given), "سندس"} and not set(map(str.lower, given)) & set(GIVEN_NAMES)
    got = {(r["doc_id"], r["start_pos"]) for r in mentions(frame, "doc_id", "text", ()).filter("pii_kind = 'person_name' and doc_id < 120").collect()}
    assert got == want, "with an empty list, also where no cue stands"
    arabic = {r["doc_id"] for r in mentions(frame, "doc_id", "text", ()).filter("doc_id >= 120").collect()}
    assert {124, 125, 126, 127} <= arabic
    assert mentions(frame, "doc_id", "text", (), learn=False).filter("pii_kind = 'person_name'").count() == 0
    assert learn_names(docs(spark, [])) == () and people_in("Dr. Zorvan Brennock, by Ostrava Pharmacy") == ["zorvan"]


def test_many_mentions_take_linear_time():
    import time

    one, took = "call +966 52 807 5081 or a.b@c.example, Sara Al-Bukhtami; ", []
    find_pii(one)
    for n in (1500, 6000):
        start = time.perf_counter()
        assert len(find_pii(one * n)) == 3 * n
        took.append(time.perf_counter() - start)
    assert took[1] < 8 * took[0]


def test_schemes_and_cues():
    assert kinds("see mailto:x.y@mail.example; tel:0522260377; id no: 1008364794")[0:3] == [("email", "x.y@mail.example"), ("phone", "0522260377"), ("id_number", "1008364794")]

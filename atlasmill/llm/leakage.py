"""Evaluation texts that leaked into a corpus: latent semantic retrieval of passages, then exact runs, subsequences and answers."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasmill.functions.visible import skeleton
from atlasmill.session import materialize

#: Words in a row that make a leak; passages are WIDTH words long and start every WIDTH - RUN words, so each such run lies in one passage.
RUN, WIDTH = 12, 16
#: Latent dimensions and surplus of the randomised SVD, and the cosine from which two passages are compared word by word.
DIMENSIONS, SURPLUS, COSINE = 96, 16, 0.6
#: The held-out set is a stated query set of at most so many items.
MAX_ITEMS = 20_000
#: Cosines held at a time, and spellings whose words a task remembers.
_CELLS, _SPELLINGS = 4_000_000, 200_000
_MARKS = re.compile("[\u0610-\u061a\u064b-\u065f\u0670\u06d6-\u06ed\u0640]")
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Words (numbers too) without case, punctuation, spacing, widths, unseen characters, Arabic vowel marks and stretching."""
    if not text:
        return []
    s = unicodedata.normalize("NFC", skeleton(text)).casefold()
    return _WORD.findall(_MARKS.sub("", s))


class _Numbers(dict):
    """Spelling between two spaces -> numbers of its words in the vocabulary, -1 for others; what was read once is remembered."""

    def __init__(self, vocabulary: dict[str, int]) -> None:
        self.vocabulary = vocabulary

    def __missing__(self, spelling: str) -> list[int]:
        if len(self) >= _SPELLINGS:
            self.clear()
        self[spelling] = out = [self.vocabulary.get(w, -1) for w in words(spelling)]
        return out

    def read(self, text: str) -> np.ndarray:
        return np.fromiter((i for s in text.split() for i in self[s]), dtype=np.int32)


def passages(ids: np.ndarray, width: int, step: int) -> np.ndarray:
    """Rows of `width` word numbers starting every `step` words, the last one at or before the end; padded with -1."""
    n = 1 + max(0, -(-(len(ids) - width) // step))
    padded = np.full((n - 1) * step + width, -1, dtype=np.int32)
    padded[: len(ids)] = ids
    return np.lib.stride_tricks.sliding_window_view(padded, width)[::step]


def run_codes(p: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit code of each run of n words of each row (equal runs have equal codes), 0 where a word is unknown."""
    code = np.zeros((len(p), p.shape[1] - n + 1), dtype=np.uint64)
    holes = np.zeros(code.shape, dtype=bool)
    for i in range(n):
        w = p[:, i : i + code.shape[1]]
        code = code * np.uint64(0x9E3779B97F4A7C15) + (w.astype(np.int64) + 7).astype(np.uint64)
        holes |= w < 0
    code[holes] = 0
    return code


def longest_run(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest run of equal consecutive words of two texts; unknown words (-1) equal nothing."""
    run, best = np.zeros(len(b) + 1, dtype=np.int32), 0
    for w in a:
        run[1:] = np.where(b == w, run[:-1] + 1, 0) if w >= 0 else 0
        best = max(best, int(run.max()))
    return best


def lcs_lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each row of a with that row of b (at most 62 columns), bit by bit; -1 equals nothing."""
    bits = np.int64(1) << np.arange(b.shape[1], dtype=np.int64)
    full = np.int64((1 << b.shape[1]) - 1)
    rest = np.full(len(a), full, dtype=np.int64)
    for j in range(a.shape[1]):
        w = a[:, j : j + 1]
        hit = rest & (((b == w) & (w >= 0)) @ bits)
        rest = ((rest + hit) | (rest - hit)) & full
    return b.shape[1] - np.bitwise_count(rest).astype(np.int64)


class Weights:
    """TF-IDF rows of passages, kept as word numbers: no row of the width of the vocabulary is ever made."""

    def __init__(self, idf: np.ndarray) -> None:
        self.idf = np.append(idf, 0).astype(np.float32)  # word -1 weighs nothing

    def times(self, p: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Unit rows of p times a matrix of one row per word."""
        padded = np.vstack([m, np.zeros((1, m.shape[1]), m.dtype)]) * self.idf[:, None]
        return sum(padded[p[:, j]] for j in range(p.shape[1])) / self.norms(p)[:, None]

    def transposed(self, p: np.ndarray, y: np.ndarray, size: int) -> np.ndarray:
        """The transpose of the unit rows of p times y."""
        rows, cols = np.nonzero(p >= 0)
        w = p[rows, cols]
        order = np.argsort(w, kind="stable")
        at = np.flatnonzero(np.r_[True, np.diff(w[order]) > 0])
        out = np.zeros((size, y.shape[1]), dtype=np.float32)
        if len(w):
            seen = w[order][at]
            out[seen] = np.add.reduceat((y / self.norms(p)[:, None])[rows[order]], at, axis=0) * self.idf[seen, None]
        return out

    def norms(self, p: np.ndarray) -> np.ndarray:
        square = self.idf[p] ** 2
        total = sum(((p == p[:, j : j + 1]) * square).sum(axis=1) for j in range(p.shape[1]))
        return np.sqrt(np.maximum(total, 1e-12))

    def latent(self, p: np.ndarray, basis: np.ndarray) -> np.ndarray:
        """Unit latent vectors of passages."""
        v = self.times(p, basis)
        return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _doc_words(documents: DataFrame, key: str, text: str, vocabulary: dict[str, int], run: int, width: int) -> DataFrame:
    """key, w: word numbers (-1 outside the items' vocabulary) of documents in which a passage has `run` words of it."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = _Numbers(shared.value)
        for batch in batches:
            keep, out = [], []
            for i, t in enumerate(batch["t"]):
                ids = numbers.read(t)
                if len(ids) >= run:
                    known = np.concatenate([[0], np.cumsum(ids >= 0)])
                    if (known[min(width, len(ids)) :] - known[: len(known) - min(width, len(ids))]).max() >= run:
                        keep.append(i)
                        out.append(ids)
            yield pd.DataFrame({"k": batch["k"].iloc[keep].reset_index(drop=True), "w": pd.Series(out, dtype=object)})

    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).filter("t is not null and k is not null")
    return rows.mapInPandas(number, f"k {kind}, w array<int>")


def _blocks(batch: pd.DataFrame, run: int, width: int, block: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row of the batch, first word and words of its passages that have at least `run` words of the vocabulary, `block` at a time."""
    step = width - run
    parts = [passages(np.asarray(w, dtype=np.int32), width, step) for w in batch["w"]]
    if not parts:
        return
    at = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    start = np.concatenate([np.arange(len(x)) for x in parts]) * step
    p = np.concatenate(parts)
    full = (p >= 0).sum(axis=1) >= run
    at, start, p = at[full], start[full], p[full]
    for i in range(0, len(p), block):
        yield at[i : i + block], start[i : i + block], p[i : i + block]


def _sum_by_term(rows: DataFrame, width: int) -> np.ndarray:
    """Sum arrays by term: partial sums of the tasks meet in a shuffle by term and leave it as one row each."""

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for t, v in zip(b["term"], b["v"]):
                sums[t] = sums.get(t, 0.0) + np.asarray(v, dtype=np.float64)
        yield pd.DataFrame({"term": pd.Series(list(sums), dtype="int32"), "v": pd.Series(list(sums.values()), dtype=object)})

    got = rows.repartition("term").mapInPandas(total, "term int, v array<double>").collect()
    out = np.zeros((max([r["term"] for r in got], default=-1) + 1, width))
    for r in got:
        out[r["term"]] = r["v"]
    return out


def latent_basis(docs: DataFrame, size: int, run: int = RUN, width: int = WIDTH, dimensions: int = DIMENSIONS, surplus: int = SURPLUS) -> tuple[np.ndarray, np.ndarray]:
    """idf and the leading right singular vectors of all passages' TF-IDF rows, by a randomised SVD in three passes.

    Pass 1 counts the passages that hold each word; passes 2 and 3 multiply a random matrix, then its orthonormal range, by A'A.
    Each task sends one row per word of the items' vocabulary, whose size the held-out set bounds.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            for _, _, p in _blocks(batch, run, width, 1 << 14):
                s = np.sort(p, axis=1)
                df += np.bincount(s[(s >= 0) & np.c_[np.ones(len(s), bool), s[:, 1:] != s[:, :-1]]], minlength=size)
                n += len(p)
        yield pd.DataFrame({"term": np.arange(size + 1, dtype=np.int32), "v": [[float(x)] for x in (*df, n)]})

    counted = _sum_by_term(docs.mapInPandas(count, "term int, v array<double>"), 1)[:, 0]
    counted = counted if len(counted) else np.zeros(size + 1)
    idf = np.log((1 + counted[-1]) / (1 + counted[:-1])).astype(np.float32) + 0.1
    columns = min(size, dimensions + surplus)
    q = np.random.default_rng(7).standard_normal((size, columns)).astype(np.float32)
    for turn in range(2):

        def multiply(batches: Iterator[pd.DataFrame], q: np.ndarray = q) -> Iterator[pd.DataFrame]:
            z, some, weights = np.zeros((size, columns), dtype=np.float32), False, Weights(idf)
            for batch in batches:
                for _, _, p in _blocks(batch, run, width, 1 << 12):
                    z += weights.transposed(p, weights.times(p, q), size)
                    some = True
            if some:
                yield pd.DataFrame({"term": np.arange(size, dtype=np.int32), "v": list(z)})

        z = _sum_by_term(docs.mapInPandas(multiply, "term int, v array<double>"), columns)
        if not len(z):
            return idf, np.eye(size, columns, dtype=np.float32)[:, :dimensions]
        if turn == 0:
            q = np.linalg.qr(z)[0].astype(np.float32)
        else:
            small = q.T @ z
            values, rotation = np.linalg.eigh((small + small.T) / 2)
            q = (q @ rotation[:, np.argsort(-values)][:, :dimensions]).astype(np.float32)
    return idf, q


class Retrieval:
    """The held-out passages in latent space, and the search of a document's passages among them."""

    def __init__(self, texts: list[np.ndarray], idf: np.ndarray, basis: np.ndarray, run: int = RUN, width: int = WIDTH) -> None:
        self.run, self.width, self.weights, self.basis, self.texts = run, width, Weights(idf), basis, texts
        cut = [passages(t, width, width - run) for t in texts]
        self.owner = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
        self.cut = np.concatenate(cut)
        self.latent = np.concatenate([self.weights.latent(self.cut[i : i + 4096], basis) for i in range(0, len(self.cut), 4096)]).T.copy()
        self.codes = run_codes(self.cut, run)
        self.block = max(16, _CELLS // len(self.cut))

    def candidates(self, p: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of p, held-out passage and cosine of the pairs of at least `cosine`."""
        near = self.weights.latent(p, self.basis) @ self.latent
        flat = np.flatnonzero(near.ravel() >= cosine)
        i, j = np.divmod(flat, near.shape[1])
        return i, j, near.ravel()[flat]

    def verbatim(self, p: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which candidates have a run of `run` words in common."""
        ours, hit = run_codes(p, self.run), np.zeros(len(i), dtype=bool)
        for a in range(ours.shape[1]):
            mine = ours[i, a]
            for b in range(self.codes.shape[1]):
                hit |= (mine == self.codes[j, b]) & (mine != 0)
        return hit


def leaks(
    documents: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", kinds: tuple[str, ...] = ("verbatim", "paraphrase"),
    run: int = RUN, width: int = WIDTH, dimensions: int = DIMENSIONS, cosine: float = COSINE, paraphrase_cosine: float = 0.75, paraphrase_lcs: float = 0.75,
) -> DataFrame:
    """doc_key, item_key, kind, longest_run: documents that hold `run` consecutive words of an item ('verbatim'), or reword one ('paraphrase').

    Documents and items are cut into overlapping passages of `width` words; passages are compared in the latent space of a randomised
    SVD of all passages' TF-IDF rows, and only pairs of at least `cosine` go on. Such a pair with a common run of `run` words is a leak;
    longest_run is then taken over both whole texts. A pair of at least paraphrase_cosine whose longest common subsequence covers
    paraphrase_lcs of the item's passage, and all of whose numbers (the answers; at least one, if the item has any) occur there, is a paraphrase
    (longest_run is then below `run`), looked for in the document's passage and half a passage on either side; a document and item with both are 'verbatim'.
    Words ignore case, punctuation, spacing and Arabic vowel marks. Null, empty and shorter texts leak nothing; a text of any length is
    read whole; repeated rows give one row; other columns are not read. The items are a stated query set (at most MAX_ITEMS, checked)
    and are held against all passages in blocks; passages with fewer than `run` words of the items' vocabulary cannot hold a leak and
    are skipped. `kinds` names what is looked for.
    """
    spark = documents.sparkSession
    rows = items.select(item_key, text).filter(f"{text} is not null and {item_key} is not null").limit(MAX_ITEMS + 1).collect()
    if len(rows) > MAX_ITEMS:
        raise ValueError(f"more than {MAX_ITEMS} evaluation items")
    held = [(r[0], words(r[1])) for r in rows]
    held = [(k, w) for k, w in held if len(w) >= run]
    dk, ik = documents.schema[doc_key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    schema = f"{doc_key} {dk}, {item_key} {ik}, kind string, longest_run int"
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in held for w in ws}))}
    if not held:
        return spark.createDataFrame([], schema)
    numeric = np.array([w.isdecimal() for w in vocabulary] + [False])
    texts = [np.array([vocabulary[w] for w in ws], dtype=np.int32) for _, ws in held]
    docs = materialize(_doc_words(documents, doc_key, text, vocabulary, run, width), "words")
    idf, basis = latent_basis(docs, len(vocabulary), run, width, dimensions)
    keys = np.array([k for k, _ in held], dtype=object)
    answers = np.array([numeric[t].any() for t in texts])
    shared = spark.sparkContext.broadcast((Retrieval(texts, idf, basis, run, width), keys, numeric, answers))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, keys, numeric, answers = shared.value
        for batch in batches:
            exact: set[tuple[int, int]] = set()
            like: set[tuple[int, int]] = set()
            for at, start, p in _blocks(batch, run, width, held.block):
                i, j, near = held.candidates(p, cosine)
                hit = held.verbatim(p, i, j)
                exact |= set(zip(at[i[hit]].tolist(), held.owner[j[hit]].tolist()))
                if "paraphrase" in kinds:
                    some = (near >= paraphrase_cosine) & ~hit
                    i, j = i[some], j[some]
                    wide = _widened(batch["w"], at, start, p.shape[1], np.unique(i))
                    theirs = held.cut[j]
                    enough = lcs_lengths(wide[i], theirs) >= paraphrase_lcs * (theirs >= 0).sum(axis=1)
                    enough &= numeric[theirs].any(axis=1) | ~answers[held.owner[j]]
                    i, j, theirs = i[enough], j[enough], theirs[enough]
                    there = np.ones(len(i), dtype=bool)
                    for c in range(theirs.shape[1]):
                        there &= ~numeric[theirs[:, c]] | (wide[i] == theirs[:, c : c + 1]).any(axis=1)
                    like |= set(zip(at[i[there]].tolist(), held.owner[j[there]].tolist()))
            out = [(d, o, "verbatim") for d, o in sorted(exact) if "verbatim" in kinds] + [(d, o, "paraphrase") for d, o in sorted(like - exact)]
            docs_ = batch["k"].to_numpy()
            longest = [longest_run(np.asarray(batch["w"].iloc[d], dtype=np.int32), held.texts[o]) for d, o, _ in out]
            yield pd.DataFrame({doc_key: docs_[[d for d, _, _ in out]], item_key: keys[[o for _, o, _ in out]], "kind": [k for _, _, k in out], "longest_run": longest})

    found = docs.mapInPandas(search, schema)
    return found.groupBy(doc_key, item_key).agg(F.max("kind").alias("kind"), F.max("longest_run").cast("int").alias("longest_run"))


def _widened(texts: pd.Series, at: np.ndarray, start: np.ndarray, width: int, rows: np.ndarray) -> np.ndarray:
    """The passages named by `rows` with half a passage of their text on either side, padded with -1; other rows are all -1."""
    half = width // 2
    out = np.full((len(at), width + 2 * half), -1, dtype=np.int32)
    for i in rows:
        w, a = texts.iloc[at[i]], int(start[i]) - half
        part = w[max(0, a) : a + out.shape[1]]
        out[i, max(0, -a) : max(0, -a) + len(part)] = part
    return out

"""Byte-level BPE of a whole corpus: merges found by a segment tree over the ranks of adjacent pairs."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where byte_bpe_50k.tiktoken lies. A parameter of encode_corpus(); the file is never copied into the repository.
RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The public splitting pattern of this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct pieces whose ids a worker remembers, and their longest length in bytes; others are encoded afresh.
CACHED_PIECES, CACHED_BYTES = 300_000, 64
_NONE = 1 << 62


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes -> rank (which is also the id), from the lines 'base64 rank' of a .tiktoken file."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


class PairTree:
    """Segment tree over the pairs (i, next part of i) of one piece.

    A leaf holds rank * size + i, so the least value at the root is the lowest rank and, of equal ones, the leftmost pair.
    """

    def __init__(self, keys: list[int]) -> None:
        self.size = 1
        while self.size < len(keys):
            self.size *= 2
        self.node = [_NONE] * self.size + [k * self.size + i if k != _NONE else _NONE for i, k in enumerate(keys)] + [_NONE] * (self.size - len(keys))
        for i in range(self.size - 1, 0, -1):
            a, b = self.node[2 * i], self.node[2 * i + 1]
            self.node[i] = a if a < b else b

    def best(self) -> int:
        """Position of the leftmost pair of the lowest rank, or -1 if no pair can be merged."""
        return self.node[1] % self.size if self.node[1] != _NONE else -1

    def set(self, at: int, rank: int) -> None:
        node, i = self.node, at + self.size
        node[i] = rank * self.size + at if rank != _NONE else _NONE
        i //= 2
        while i:
            a, b = node[2 * i], node[2 * i + 1]
            least = a if a < b else b
            if node[i] == least:
                break
            node[i] = least
            i //= 2


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: merge the root's pair until none is left. O(n log n) for n bytes."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))  # part i is piece[i:end[i]]
    left = list(range(-1, n - 1))
    tree = PairTree([ranks.get(piece[i : i + 2], _NONE) for i in range(n - 1)])
    while (i := tree.best()) >= 0:
        j = end[i]
        stop = end[j]
        end[i] = stop
        if j < n - 1:
            tree.set(j, _NONE)
        if stop < n:
            left[stop] = i
            tree.set(i, ranks.get(piece[i : end[stop]], _NONE))
        else:
            tree.set(i, _NONE)
        if (k := left[i]) >= 0:
            tree.set(k, ranks.get(piece[k:stop], _NONE))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Text -> ids; special tokens' strings are ordinary text."""

    def __init__(self, raw: bytes, pattern: str = PATTERN) -> None:
        self.ranks, self.split, self.known = read_ranks(raw), regex.compile(pattern), {}

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        known = self.known
        for piece in self.split.findall(text or ""):
            ids = known.get(piece)
            if ids is None:
                data = piece.encode("utf-8", "replace")
                ids = encode_piece(data, self.ranks)
                if len(data) <= CACHED_BYTES:
                    if len(known) >= CACHED_PIECES:
                        known.clear()
                    known[piece] = ids
            out += ids
        return out


@lru_cache(maxsize=2)
def _encoder(raw: bytes, pattern: str) -> Encoder:
    return Encoder(raw, pattern)


def encode_corpus(documents: DataFrame, key: str, text: str, ranks_path: str = RANKS_PATH, pattern: str = PATTERN) -> DataFrame:
    """key, ids (array<int>): one row for each row of documents; null and empty texts have an empty list.

    Blank and very long texts are encoded whole; a piece of any length takes O(n log n). The vocabulary file (under 1 MB, checked)
    is read once on the driver and sent to the executors. No shuffle. Repeated rows stay repeated; other columns are not read.
    """
    with open(ranks_path, "rb") as f:
        raw = f.read()
    if len(raw) > 8 << 20:
        raise ValueError(f"{ranks_path} is too large to send to every executor")
    shared = documents.sparkSession.sparkContext.broadcast(raw)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(shared.value, pattern)
        for texts in batches:
            yield pd.Series([encoder.encode(t) for t in texts], index=texts.index, dtype=object)

    ids = F.pandas_udf(run, "array<int>", F.PandasUDFType.SCALAR_ITER)
    return documents.select(F.col(key), ids(F.col(text).cast("string")).alias("ids"))

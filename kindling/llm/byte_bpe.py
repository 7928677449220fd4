"""Byte-level BPE encoding with a segment tree, and decoding."""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.llm.common import binary_array, per_batch, table

RANKS = "byte_bpe_50k.tiktoken"
#: What public_tokenizers.PATTERN matches in ASCII texts.
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
#: Encoded pieces that a worker remembers; their memory is bounded, what they encode to is not changed.
REMEMBERED, REMEMBERED_LENGTH, TOGETHER = 400_000, 64, 1 << 20


@lru_cache(4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: again and again the adjacent pair of least rank,
    the leftmost of equal ones, becomes one token.

    A segment tree over the byte positions has at each leaf the rank of the
    pair that begins there (rank * size + position, so the root is the leftmost
    minimum) and at each node the lesser child. A merge changes three leaves:
    the merged pair's, the one it swallowed, and the live neighbour's on the
    left; each is brought up the tree in logarithmic time.
    """
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    size = 1 << max(1, (n - 1).bit_length())
    none = 1 << 62
    tree = [none] * (2 * size)
    get = ranks.get
    for i in range(n - 1):
        if (r := get(piece[i:i + 2])) is not None:
            tree[size + i] = r * size + i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n))
    while (key := tree[1]) != none:
        i = key & (size - 1)
        j = after[i]
        end = after[j]
        after[i] = end
        before[end] = i
        r = get(piece[i:after[end]]) if end < n else None
        changed = [(i, r), (j, None)]
        if (left := before[i]) >= 0:
            changed.append((left, get(piece[left:end])))
        for at, r in changed:
            now = none if r is None else r * size + at
            at += size
            while tree[at] != now:
                tree[at] = now
                other = tree[at ^ 1]
                if other < now:
                    now = other
                at >>= 1
                if not at:
                    break
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class _Pairs:
    """Rank of the token that two adjacent tokens make, for arrays of pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        at = [(ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.keys, self.ranks = np.array(sorted(at), np.int64).T.copy() if at else np.empty((2, 0), np.int64)
        self.of_bytes = np.full(256, -1, np.int64)
        for i in range(256):
            self.of_bytes[i] = ranks.get(bytes([i]), -1)
        both = np.full((256, 256), -1, np.int64)
        for t, r in ranks.items():
            if len(t) == 2:
                both[t[0], t[1]] = r
        self.of_two_bytes = both

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], -1)


def merge_many(pieces: list[bytes], pairs: _Pairs, size: int) -> list[bytes]:
    """:func:`merge` for many pieces of at most ``size`` bytes (a power of two)
    side by side: a segment tree each, whose leaves are updated together. The
    ids come as 32-bit integers."""
    rows = len(pieces)
    lengths = np.fromiter(map(len, pieces), np.int64, rows)
    data = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(rows, size)
    places = np.arange(size)
    token = np.full((rows, size + 1), -1, np.int64)
    token[:, :size] = np.where(places < lengths[:, None], pairs.of_bytes[data], -1)
    after, before = np.tile(np.arange(1, size + 2), (rows, 1)), np.tile(np.arange(-1, size), (rows, 1))
    none = np.int64(1) << 62
    tree = np.full((rows, 2 * size), none)
    first = pairs.of_two_bytes[data[:, :-1], data[:, 1:]]
    tree[:, size:-1] = np.where((first >= 0) & (places[1:] < lengths[:, None]), first * size + places[:-1], none)
    level = size
    while level > 1:
        tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
        level //= 2

    def update(row: np.ndarray, at: np.ndarray, rank: np.ndarray) -> None:
        value = np.where(rank >= 0, rank * size + at, none)
        at = at + size
        tree[row, at] = value
        while at[0] > 1:
            value = np.minimum(value, tree[row, at ^ 1])
            at = at >> 1
            tree[row, at] = value

    live = np.flatnonzero(tree[:, 1] != none)
    while len(live):
        key = tree[live, 1]
        i, merged = key & (size - 1), key // size
        j = after[live, i]
        end = after[live, j]
        after[live, i], token[live, i], token[live, j] = end, merged, -1
        before[live, np.minimum(end, size)] = i
        update(live, j, np.full(len(live), -1))
        update(live, i, pairs(merged, token[live, np.minimum(end, size)]))
        left = before[live, i]
        has = left >= 0
        if has.any():
            row, at = live[has], left[has]
            update(row, at, pairs(token[row, at], merged[has]))
        live = live[tree[live, 1] != none]
    kept = token[:, :size] >= 0
    ids, ends = token[:, :size][kept].astype(np.int32).tobytes(), (4 * np.cumsum(kept.sum(1))).tolist()
    return [ids[a:z] for a, z in zip([0, *ends], ends)]  # noqa: B905


class _Pieces(dict):
    """Piece of text -> its ids as 32-bit integers; those that texts have are encoded many at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pairs, self.older = ranks, _Pairs(ranks), {}

    def learn(self, pieces: set[str]) -> None:
        by_size: dict[int, list[str]] = {}
        for p in pieces:
            raw = p.encode()
            if (r := self.ranks.get(raw)) is not None:
                self[p] = r.to_bytes(4, "little")
            elif len(raw) > 32:
                self[p] = array("i", merge(raw, self.ranks)).tobytes()
            else:
                by_size.setdefault(max(4, 1 << (len(raw) - 1).bit_length()), []).append(p)
        for size, some in by_size.items():
            for at in range(0, len(some), 16384):
                part = some[at:at + 16384]
                self.update(zip(part, merge_many([p.encode() for p in part], self.pairs, size), strict=True))

    def encode(self, texts: list[list[str]]) -> list[bytes]:
        """The ids of texts given as their pieces."""
        new = set().union(*texts).difference(self)
        if len(self) + len(new) > REMEMBERED // 2:
            self.older = dict(self)
            self.clear()
            new = set().union(*texts)
        # What is met again stays known; the rest goes when the next half is full.
        again = new.intersection(self.older)
        self.update((p, self.older[p]) for p in again)
        self.learn(new - again)
        out = [b"".join(map(self.__getitem__, t)) for t in texts]
        for p in [p for p in new if len(p) > REMEMBERED_LENGTH]:
            del self[p]
        return out


@lru_cache(4)
def _pieces(path: str) -> _Pieces:
    return _Pieces(load_ranks(path))


@lru_cache(4)
def _vocabulary(path: str) -> list[bytes]:
    ranks = load_ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


@lru_cache(4)
def _splitter(pattern: str):
    return regex.compile(pattern).findall


def encode_texts(texts: list[str | None], path: str, pattern: str = public_tokenizers.PATTERN) -> list[np.ndarray]:
    """The ids of each whole text; about ``TOGETHER`` characters of texts share one round of encoding."""
    known, out, held, chars = _pieces(path), [], [], 0
    own, general = pattern == public_tokenizers.PATTERN, _splitter(pattern)
    for i, text in enumerate(texts):
        text = text or ""
        held.append(_ASCII.findall(text) if own and text.isascii() else general(text))
        chars += len(text)
        if chars >= TOGETHER or i == len(texts) - 1:
            out += [np.frombuffer(ids, np.int32) for ids in known.encode(held)]
            held, chars = [], 0
    return out


def decode_ids(ids: list[int], path: str) -> bytes:
    return b"".join(map(_vocabulary(path).__getitem__, ids))


def _ids(batch: pa.RecordBatch, path: str, pattern: str) -> pa.ListArray:
    ids = encode_texts(batch.column(0).to_pylist(), path, pattern)
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))


def _decoded(ids: pa.ListArray, path: str) -> pa.Array:
    # Offsets and values are taken as arrays: as Python lists of a whole batch they cost more than the decoding.
    offsets = ids.offsets.to_numpy()
    values = ids.values.to_numpy(zero_copy_only=False)
    return binary_array([decode_ids(values[a:z].tolist(), path) for a, z in zip(offsets[:-1], offsets[1:], strict=True)])


def _by_row(docs: DataFrame) -> tuple[DataFrame, str]:
    rows = docs.select("text", F.struct(*(c for c in docs.columns if c != "text")).alias("row"))
    return rows, f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>"


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``row`` (the columns of ``docs`` but the text) and ``ids`` (array of
    ints), the tokens of each whole text by the rank file at ``path``, every match of
    ``pattern`` for itself, without special tokens.

    Null and empty texts have no ids. Repeated rows are encoded alike; no rows
    give no rows. Long texts and long matches are encoded whole, in time n log n."""

    @per_batch
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column(1), _ids(batch, path, pattern)], ["row", "ids"])

    rows, kind = _by_row(docs)
    return rows.mapInArrow(run, kind)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (``row``, ``ids``) with ``decoded``, the bytes of the ids; null ids decode to nothing."""

    @per_batch
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([*batch.columns, _decoded(batch.column(1), path)], ["row", "ids", "decoded"])

    encoded = encoded.select("row", "ids")
    return encoded.mapInArrow(run, f"row {encoded.schema['row'].dataType.simpleString()}, ids array<int>, decoded binary")


def encode_and_decode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """:func:`decode` of :func:`encode`, in the same Python workers: half as many of them, and ids cross to the JVM once."""

    @per_batch
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = _ids(batch, path, pattern)
        return pa.record_batch([batch.column(1), ids, _decoded(ids, path)], ["row", "ids", "decoded"])

    rows, kind = _by_row(docs)
    return rows.mapInArrow(run, f"{kind}, decoded binary")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    coded = encode_and_decode(table(spark, sf_dir, "documents", "doc_id", "text"), path)
    return coded.select(
        "row.doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), " "), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))

"""Alignment of two tokenizers' tokens by sparse products of incidence matrices."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.llm.common import mix, table, written
from kindling.llm.token_counts import byte_characters, counter

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters of texts aligned in one go, terms of a sparse product and postings held in one go. They bound memory only.
TOGETHER, TERMS, POSTINGS = 1 << 18, 1 << 21, 1 << 21
#: Encoded chunks that a worker remembers for each side, and their greatest length: they bound memory only, too.
REMEMBERED, REMEMBERED_LENGTH = 400_000, 64
#: Bits of a document's number in its block and of a block's number in its partition; partitions that share a key of the joins.
DOC_BITS, BLOCK_BITS, PARTITIONS_A_KEY = 16, 20, 1 << 10


@dataclass
class Csr:
    """A sparse matrix by rows: row i has the columns ``columns[starts[i]:starts[i + 1]]`` and their values."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, height: int, width: int) -> Csr:
        """From triples sorted by row."""
        return cls(np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=height)))), columns, values, width)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> Csr:
        by_column = np.argsort(self.columns, kind="stable")
        return Csr.of(self.columns[by_column], self.rows[by_column], self.values[by_column], self.width, len(self.starts) - 1)


def product(left: Csr, right: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The product's entries as (rows, columns, values), by row and column, in
    blocks of whole rows: Gustavson's way, each row of ``left`` adds up the
    rows of ``right`` that its columns name. A block has about ``TERMS`` terms,
    or one row."""
    terms = np.diff(right.starts)[left.columns]
    upto = np.concatenate(([0], np.cumsum(terms)))[left.starts]  # terms before each row
    rows, at = left.rows, 0
    while at < len(upto) - 1:
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + TERMS, "right")) - 1)
        some = slice(left.starts[at], left.starts[end])
        n = terms[some]
        if total := int(n.sum()):
            first = right.starts[left.columns[some]]
            place = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(total)
            key = np.repeat(rows[some], n) * right.width + right.columns[place]
            value = np.repeat(left.values[some], n) * right.values[place]
            if not (key[1:] >= key[:-1]).all():
                order = np.argsort(key, kind="stable")
                key, value = key[order], value[order]
            begins = np.flatnonzero(np.diff(key, prepend=-1))
            yield key[begins] // right.width, key[begins] % right.width, np.add.reduceat(value, begins)
        at = end


#: Bytes of white space in characters beyond ASCII, as one number of their last two and of their last three bytes.
_WIDE_SPACES = [int.from_bytes(c.encode()) for c in "\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"]
_STEPS = mix(np.arange(1, (1 << 12) + 1, dtype=np.uint64)) | np.uint64(1)
_BYTES = mix(np.arange(257, 513, dtype=np.uint64))


def _cuts(data: np.ndarray) -> np.ndarray:
    """Where texts can be cut without a change of their tokens: before a space that follows a character that is no white space."""
    at = np.flatnonzero(data == 32)
    at = at[at > 0]
    before = data[at - 1]
    after_wide = before >= 128
    plain = (before > 32) & (before < 127)
    wide = at[after_wide]
    two = data[wide - 2].astype(np.int64) << 8 | data[wide - 1]
    plain[after_wide] = ~(np.isin(two, _WIDE_SPACES) | np.isin(data[wide - 3].astype(np.int64) << 16 | two, _WIDE_SPACES))
    return at[plain]


@dataclass
class Chunks:
    """Texts cut into chunks: the distinct ones, which of them each chunk is, and the first chunk of each text (and after the last)."""

    distinct: list[bytes]
    of: np.ndarray
    first: np.ndarray

    @classmethod
    def cut(cls, texts: list[str], whole: bool) -> Chunks:
        """Texts that begin with a space, or are empty. Equal chunks are found by hashes and compared byte by
        byte, about ``TOGETHER`` bytes (or a chunk) at a time, so that no chunk but the distinct ones becomes a Python object."""
        raw = "".join(texts).encode()
        data, size = np.frombuffer(raw, np.uint8), np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in texts), np.int64, len(texts))
        edges = np.cumsum(np.append(0, size))
        begins = np.zeros(len(data), bool)
        if not whole:
            begins[_cuts(data)] = True
            spaces = np.fromiter((len(t) - len(t.rstrip(" ")) for t in texts), np.int64, len(texts))
            begins[(edges[1:] - spaces)[spaces > 0]] = False  # spaces at a text's end stay with the word before them
        begins[edges[:-1][size > 0]] = True
        starts = np.flatnonzero(begins)
        lengths = np.diff(np.append(starts, len(data)))
        hashes = np.empty(len(starts), np.uint64)
        for s, byte, place in cls._parts(starts, lengths):
            step = place & (len(_STEPS) - 1)
            hashes[s] = np.add.reduceat(_BYTES[data[byte]] * _STEPS[step], np.cumsum(lengths[s]) - lengths[s])
        _, like, of = np.unique(mix(hashes), return_index=True, return_inverse=True)
        first = like[of]
        same = bool((lengths == lengths[first]).all()) and all(
            (data[byte] == data[np.repeat(starts[first[s]], lengths[s]) + place]).all() for s, byte, place in cls._parts(starts, lengths))
        if same:
            distinct = [raw[x:y] for x, y in zip(starts[like].tolist(), (starts + lengths)[like].tolist(), strict=True)]
        else:  # different chunks of one hash
            chunks = [raw[x:y] for x, y in zip(starts.tolist(), (starts + lengths).tolist(), strict=True)]
            number = {c: i for i, c in enumerate(dict.fromkeys(chunks))}
            distinct, of = list(number), np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks))
        return cls(distinct, of, np.searchsorted(starts, edges))

    @staticmethod
    def _parts(starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[slice, slice, np.ndarray]]:
        """Runs of whole chunks: which chunks, which bytes, and the bytes' places in their chunks."""
        upto, at = np.append(starts, starts[-1:] + lengths[-1:]), 0
        while at < len(starts):
            end = max(at + 1, int(np.searchsorted(upto, upto[at] + TOGETHER, "right")) - 1)
            yield slice(at, end), slice(int(upto[at]), int(upto[end])), np.arange(upto[at], upto[end]) - np.repeat(starts[at:end], lengths[at:end])
            at = end


class _Side:
    """A vocabulary's token bytes, and the ids of chunks of texts. ``encode``
    gives the ids of many chunks one after the other, each as in a whole text."""

    def __init__(self, tokens: list[bytes], encode: Callable[[list[str]], list[int]], whole: bool):
        self.tokens, self.encode, self.whole, self.known, self.before = tokens, encode, whole, {}, {}
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))

    def learn(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of chunks as 32-bit integers; none if a chunk is not spelled back. The bytes of ids spelled back tell
        where each chunk ends; if they don't, the chunks are halved until those are alone that are not spelled back."""
        if not chunks:
            return []
        ids = self.encode(list(map(bytes.decode, chunks)))
        if b"".join(map(self.tokens.__getitem__, ids)) == b"".join(chunks):
            ids = np.array(ids, np.int32)
            ends = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
            after, coded = (4 * (np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1)).tolist(), ids.tobytes()
            return [coded[x:y] for x, y in zip([0, *after], after)]  # noqa: B905
        if len(chunks) == 1:
            return [b""]
        half = len(chunks) // 2
        return self.learn(chunks[:half]) + self.learn(chunks[half:])

    def look_up(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of distinct chunks. Half of what is remembered is forgotten at a time: what was not asked for since the half before."""
        found = list(map(self.known.get, chunks))
        if missing := [i for i, ids in enumerate(found) if ids is None]:
            asked = [chunks[i] for i in missing]
            again = list(map(self.before.get, asked))
            learned = iter(self.learn([c for c, ids in zip(asked, again, strict=True) if ids is None]))
            again = [next(learned) if ids is None else ids for ids in again]
            for i, ids in zip(missing, again, strict=True):
                found[i] = ids
            if len(self.known) + len(missing) > REMEMBERED // 2:
                self.before, self.known = self.known, {}
            self.known.update(zip(asked, again, strict=True))
            for chunk in asked:
                if len(chunk) > REMEMBERED_LENGTH:
                    del self.known[chunk]
        return found

    def __call__(self, texts: list[str], chunks: Chunks | None = None) -> list[bytes | None]:
        """The ids of whole texts as 32-bit integers; None if the text is not spelled back."""
        chunks = chunks or Chunks.cut(texts, self.whole)
        found = self.look_up(chunks.distinct)
        n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        size = n[chunks.of]
        upto = np.cumsum(np.append(0, size))
        place = np.repeat((np.cumsum(n) - n)[chunks.of] - upto[:-1], size)
        place += np.arange(len(place))
        raw, ends = np.frombuffer(b"".join(found), np.int32)[place].tobytes(), (4 * upto[chunks.first]).tolist()
        odd = np.diff(np.cumsum(np.append(0, size == 0))[chunks.first]).tolist()
        return [None if bad else raw[x:y] for x, y, bad in zip(ends[:-1], ends[1:], odd, strict=True)]


class Tokenizers:
    """A byte-level BPE of the tokenizers library (A) and a sentencepiece model
    that puts a space before the text (B).

    A's library splits texts by its pattern before it merges, always before a space that follows no white space. B has no
    token with a space behind another character (else texts are not cut), so none reaches from one run of spaces and
    the word behind it into the next. So both have the ids of chunks that begin at such spaces, one after the other."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        a, b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        a.encode_special_tokens = True
        with open(path_a, encoding="utf-8") as f:
            added = {t["id"]: t["content"].encode() for t in json.load(f)["added_tokens"]}
        of = byte_characters()
        spelled = {i: added[i] if i in added else bytes(map(of.__getitem__, t)) for t, i in a.get_vocab().items()}
        tokens = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
        crossing = any(re.search("[^▁]▁", b.id_to_piece(i)) for i in range(b.get_piece_size()))
        split, sentences = counter(path_a).pieces, iter if crossing else _sentences
        self.a = _Side([spelled.get(i, b"") for i in range(max(spelled) + 1)], lambda chunks: a.encode_batch_fast(
            [list(chain.from_iterable(map(split, chunks)))], is_pretokenized=True, add_special_tokens=False)[0].ids, crossing)
        self.b = _Side(tokens, lambda chunks: list(chain.from_iterable(b.encode([t[1:] for t in sentences(chunks)], num_threads=1))), crossing)
        sizes = len(self.a.tokens), len(tokens)
        #: For each side and what follows (a comma, a bar, a semicolon) the ids as texts, one after the other.
        self.names = [f"{i}{mark}" for n in sizes for mark in ",|;" for i in range(n)]
        self.first_name = np.cumsum([0, *[n for n in sizes for _ in range(3)]])[:6]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of A and B of each text with a space before it; none if either side does not spell that."""
        spaced = [" " + t if t else "" for t in texts]
        chunks = Chunks.cut(spaced, self.a.whole)
        return [tuple(np.frombuffer(b"" if a is None or b is None else ids, np.int32).astype(np.int64) for ids in (a, b))
                for a, b in zip(self.a(spaced, chunks), self.b(spaced, chunks), strict=True)]


def _sentences(pieces: list[str]) -> Iterator[str]:
    """Chunks put together again; one that ends in spaces is the last of its sentence, and a sentence has about 4,096 chunks."""
    held = []
    for piece in pieces:
        held.append(piece)
        if piece[-1] == " " or len(held) == 1 << 12:
            yield "".join(held)
            held = []
    if held:
        yield "".join(held)


@lru_cache(2)
def load(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def incidence(ends: np.ndarray) -> Csr:
    """Tokens x bytes, of tokens that follow each other and end at ``ends``."""
    n = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate(([0], ends)), np.arange(n), np.ones(n, np.int64), n)


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, bytes that both have) of all tokens that overlap, in order: A's incidence with the bytes times B's transposed."""
    blocks = list(product(incidence(ends_a), incidence(ends_b).transposed()))
    return tuple(np.concatenate(x) for x in zip(*blocks, strict=True)) if blocks else (np.empty(0, np.int64),) * 3


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B. In the row of overlaps a new
    group begins where both tokens change: there both sides' tokens end."""
    a, b, _ = overlaps(ends_a, ends_b)
    group = np.cumsum((np.diff(a, prepend=-1) != 0) & (np.diff(b, prepend=-1) != 0)) - 1
    of_a, of_b = np.zeros(len(ends_a), np.int64), np.zeros(len(ends_b), np.int64)
    of_a[a], of_b[b] = group, group
    return of_a, of_b


def _by_id(doc: np.ndarray, ids: np.ndarray, group: np.ndarray, width: int) -> tuple[np.ndarray, Csr]:
    """The distinct (document, id) as keys, and how often each has a token in each group."""
    key = doc << 32 | ids
    order = np.argsort(key, kind="stable")  # along the tokens of a text, groups only rise
    key, group = key[order], group[order]
    begins = np.diff(key, prepend=-1) != 0
    row, first = np.cumsum(begins) - 1, np.flatnonzero(begins | (np.diff(group, prepend=-1) != 0))
    times, distinct = np.diff(np.append(first, len(key))), key[begins]
    return distinct, Csr.of(row[first], group[first], times, len(distinct), width)


class Aligned:
    """Texts aligned together: their tokens follow each other, and no group has tokens of two texts."""

    def __init__(self, coded: list[tuple[np.ndarray, np.ndarray]], by: Tokenizers):
        self.n, self.by = len(coded), by
        sides = []
        for side, of in enumerate((by.a, by.b)):
            size = np.fromiter((len(c[side]) for c in coded), np.int64, self.n)
            ids = np.concatenate([c[side] for c in coded])
            sides.append((size, ids, np.repeat(np.arange(self.n), size), np.cumsum(of.lengths[ids])))
        (self.size_a, self.ids_a, self.doc_a, ends_a), (self.size_b, self.ids_b, self.doc_b, ends_b) = sides
        self.group_a, self.group_b = groups(ends_a, ends_b)
        self.n_all = int(self.group_a[-1]) + 1 if len(ends_a) else 0
        first = np.flatnonzero(np.diff(self.group_a, prepend=-1))
        self.n_groups = np.bincount(self.doc_a[first], minlength=self.n)
        a, b = (np.bincount(g, minlength=self.n_all) for g in (self.group_a, self.group_b))
        self.n_links = np.zeros(self.n, np.int64)
        np.add.at(self.n_links, self.doc_a[first], a * b)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(document, id of A, id of B, links between tokens of these ids), each
        once, in blocks: A's incidence with the groups times B's transposed. Tokens of one id in a group are one entry."""
        a, left = _by_id(self.doc_a, self.ids_a, self.group_a, self.n_all)
        b, right = _by_id(self.doc_b, self.ids_b, self.group_b, self.n_all)
        for x, y, times in product(left, right.transposed()):
            yield a[x] >> 32, a[x] & 0xFFFFFFFF, b[y] & 0xFFFFFFFF, times

    def written_out(self) -> list[str]:
        """Each text's groups: ids of A, a bar, ids of B; groups parted by semicolons."""
        side = np.repeat([0, 1], [len(self.ids_a), len(self.ids_b)])
        group, ids = np.concatenate((self.group_a, self.group_b)), np.concatenate((self.ids_a, self.ids_b))
        order = np.argsort(2 * group + side, kind="stable")
        side, group, ids = side[order], group[order], ids[order]
        mark = np.zeros(len(ids), np.int64)  # a comma, a bar or a semicolon follows
        mark[:-1][side[1:] > side[:-1]] = 1
        mark[:-1][group[1:] > group[:-1]] = 2
        mark[-1:] = 2
        words = list(map(self.by.names.__getitem__, (self.by.first_name[3 * side + mark] + ids).tolist()))
        upto = np.concatenate(([0], np.cumsum(self.size_a + self.size_b))).tolist()
        return ["".join(words[x:y])[:-1] for x, y in zip(upto[:-1], upto[1:], strict=True)]


def _postings(block: int, held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """A block's pairs: a row for each pair of ids and number of links, with the documents that have the pair so often."""
    doc, pair, times = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((doc, times, pair))
    doc, pair, times = doc[order].astype(np.uint16), pair[order], times[order]
    first = np.flatnonzero((np.diff(pair, prepend=-1) != 0) | (np.diff(times, prepend=-1) != 0))
    ends = np.append(first[1:], len(pair))
    docs = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(np.append(2 * first, 2 * len(doc)).astype(np.int32).tobytes()), pa.py_buffer(doc.tobytes())])
    return _rows(len(first), block=np.full(len(first), block), pair=pair[first], times=times[first], docs=docs, held=ends - first)


_KIND = "block long, doc int, pair long, times long, docs binary, held long, n_a long, n_b long, n_groups long, n_links long, groups string"
_TYPES = {"block": pa.int64(), "doc": pa.int32(), "pair": pa.int64(), "times": pa.int64(), "docs": pa.binary(), "held": pa.int64(), "n_a": pa.int64(),
          "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups": pa.string()}


def _rows(n: int, row: pa.Array | None = None, **columns) -> pa.RecordBatch:
    """A batch that has nulls in all columns not given."""
    found = {name: pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind) for name, kind in _TYPES.items()}
    return pa.RecordBatch.from_pydict({"row": row, **found}) if row is not None else pa.RecordBatch.from_pydict(found)


def _aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Two kinds of rows, in blocks of documents: one for each document (with
    its number in the block), one for each pair of ids linked in the block."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select("text", F.struct(*others).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, block, number, held, size = load(path_a, path_b), TaskContext.get().partitionId() << BLOCK_BITS, 0, [], 0
        empty = None

        def part(texts: list[str], payload: pa.Array) -> Iterator[pa.RecordBatch]:
            nonlocal block, number, held, size
            if number + len(texts) > 1 << DOC_BITS:
                if held:
                    yield pair_rows()
                block, number, held, size = block + 1, 0, [], 0
            all_ = Aligned(by.encode(texts), by)
            yield _rows(len(texts), payload, block=np.full(len(texts), block), doc=np.arange(number, number + len(texts)), n_a=all_.size_a, n_b=all_.size_b,
                        n_groups=all_.n_groups, n_links=all_.n_links, groups=all_.written_out())
            for doc, a, b, times in all_.pairs():
                held.append((doc + number, a << 32 | b, times))
                size += len(doc)
                if size >= POSTINGS:  # the block goes on: a pair may have a row in each part of it
                    yield pair_rows()
                    held, size = [], 0
            number += len(texts)

        def pair_rows() -> pa.RecordBatch:
            found = _postings(block, held)
            return pa.RecordBatch.from_arrays([pa.nulls(found.num_rows, empty), *found.columns], ["row", *found.schema.names])

        for batch in batches:
            empty = batch.schema.field(1).type
            texts, at, chars = batch.column(0).to_pylist(), 0, 0
            for i, text in enumerate(texts):
                chars += len(text or "")
                if chars >= TOGETHER or i == len(texts) - 1 or i + 1 - at >= 1 << DOC_BITS:
                    yield from part([t or "" for t in texts[at:i + 1]], batch.column(1).slice(at, i + 1 - at))
                    at, chars = i + 1, 0
        if held:
            yield pair_rows()

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {_KIND}")


def _summed(found: DataFrame) -> DataFrame:
    """``block``, ``doc``, ``n_best`` and ``count_sum`` from postings with their pair's corpus-wide figures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            block, times, held, count, best = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3, 4, 5))
            doc = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint16).astype(np.int64)
            key, at = np.unique(np.repeat(block, held) << DOC_BITS | doc, return_inverse=True)
            # Integer sums: as floating-point weights, large counts would lose digits.
            sums = [np.zeros(len(key), np.int64) for _ in range(2)]
            np.add.at(sums[0], at, np.repeat(times * best, held))
            np.add.at(sums[1], at, np.repeat(times * count, held))
            yield pa.record_batch([pa.array(key), *map(pa.array, sums)], ["key", "n_best", "count_sum"])

    return found.mapInArrow(run, "key long, n_best long, count_sum long").groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(spark: SparkSession, docs: DataFrame, path_a: str, path_b: str, spelled: bool = True) -> tuple[DataFrame, DataFrame]:
    """Two tables. Per row of ``docs``: ``row`` (its columns but the text),
    ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` (``a1,a2|b1;a3|b2``, ids in
    order), ``n_best`` and ``count_sum``. Per pair of ids linked anywhere:
    ``a``, ``b``, ``count`` (documents that have them linked) and ``best`` (no pair of the same ``a`` has more).

    Tokens of A and B overlap where their incidences with the bytes multiply; overlaps that
    share a token make a group; A's incidence with the groups times B's gives the links, counted by pair of ids.
    Null and empty texts, and texts that a side does not spell back, have no tokens and no links. Repeated rows are
    documents each; no rows give no rows; columns of any name stay in ``row``. Long texts are aligned
    whole: products go by blocks of rows, and tokens of one id in a group are one entry, so a long stretch without a
    common end costs its distinct ids, not its pairs of tokens.

    Postings travel by block: one row for a pair and a block of up to 65,536 documents, so a pair that every document has
    is a row a block and not a row a document, and blocks of ``PARTITIONS_A_KEY`` partitions share a key of the joins.
    With ``spelled`` false, ``groups`` is the SHA-256 of the spelling, empty without tokens, and the spelling itself is not stored."""
    both = _aligned(docs, path_a, path_b)
    if not spelled:
        both = both.withColumn("groups", F.when(F.col("n_a") > 0, F.sha2(F.encode("groups", "UTF-8"), 256)).otherwise(""))
    both = written(spark, both, "aligned")
    documents = both.where(F.col("pair").isNull()).select("row", "block", "doc", "n_a", "n_b", "n_groups", "n_links", "groups")
    share = F.floor(F.col("block") / (PARTITIONS_A_KEY << BLOCK_BITS))
    postings = both.where(F.col("pair").isNotNull()).select("block", "pair", "times", "docs", "held", share.alias("share"))
    partial = written(spark, postings.groupBy("pair", "share").agg(F.sum("held").alias("held")), "pair-shares")
    total = partial.groupBy("pair").agg(F.sum("held").alias("count"))
    a = F.shiftright("pair", 32)
    pairs = written(spark, total.select("pair", "count", a.alias("a")), "pairs")
    most = pairs.groupBy("a").agg(F.max("count").alias("most"))
    pairs = pairs.join(most, "a").select("pair", "a", F.col("pair").bitwiseAND((1 << 32) - 1).alias("b"), "count", (F.col("count") == F.col("most")).alias("best"))
    facts = partial.select("pair", "share").join(pairs.select("pair", "count", "best"), "pair")
    found = postings.join(facts, ["pair", "share"]).select("block", "times", "docs", "held", "count", F.col("best").cast("long").alias("best"))
    sums = _summed(found.repartition("block"))
    sums = sums.select(F.shiftright("key", DOC_BITS).alias("block"), F.col("key").bitwiseAND((1 << DOC_BITS) - 1).cast("int").alias("doc"), "n_best", "count_sum")
    documents = documents.join(sums, ["block", "doc"], "left").select(
        "row", "n_a", "n_b", "n_groups", "n_links", "groups", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")))
    return documents, pairs.select("a", "b", "count", "best")


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(TOKENIZER_A), public_tokenizers.path(TOKENIZER_B)
    aligned, _ = align(spark, table(spark, sf_dir, "documents", "doc_id", "text"), *paths, spelled=False)
    return aligned.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))

"""Token counts by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.llm.common import per_batch, table

TOKENIZER, LIMIT = "byte_bpe_50k.json", 512
#: Counts of pre-tokens that a worker remembers, the bytes merged in one go, the characters of texts counted in one go: they bound memory only.
REMEMBERED, REMEMBERED_LENGTH, TOGETHER = 1_000_000, 64, 1 << 20
#: What the byte-level pre-tokenizer's pattern matches in ASCII texts.
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\s\x1c-\x1fA-Za-z0-9]+|[\s\x1c-\x1f]+(?![^\s\x1c-\x1f])|[\s\x1c-\x1f]+", re.ASCII)
_NONE = np.iinfo(np.int32).max


def byte_characters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable
    ones stand for themselves, the others follow from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """Merge rules of a byte-level vocabulary as sorted arrays: a pair of ids
    has a rank, a rank the id that the pair becomes."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        pairs = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges]
        left, right, product = np.array(pairs, np.int64).reshape(-1, 3).T
        key = left << 32 | right
        # Of rules for the same pair the last counts, as in a map filled in order.
        keys, last = np.unique(key[::-1], return_index=True)
        self.keys, self.ranks = keys, (len(key) - 1 - last).astype(np.int32)
        self.product = product.astype(np.int32)
        self.of_byte = np.full(256, -1, np.int32)
        for character, byte in byte_characters().items():
            self.of_byte[byte] = vocabulary.get(character, -1)
        made = np.full(int(product.max(initial=0)) + 1, -1, np.int64)
        made[product[::-1]] = np.arange(len(product))[::-1]  # the first rule that makes an id
        once = len(np.unique(product)) == len(product)
        parts = np.concatenate((left, right))
        known = parts < len(made)
        rank_of_part = np.where(known, made[np.where(known, parts, 0)], -1)
        #: Every rule comes after those that make its parts: then no merge makes a pair of lower
        #: rank, and all of a sequence's pairs of its lowest rank merge at once as they would in turn.
        self.ordered = bool(once and (rank_of_part < np.tile(np.arange(len(product)), 2)).all())

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), _NONE, np.int32)
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], _NONE)


def surviving(data: np.ndarray, lengths: np.ndarray, merges: Merges) -> np.ndarray:
    """The symbols left of each sequence; ``data`` has the bytes of all, one
    after the other, ``lengths`` (none 0) says how many each has.

    In every round each sequence's lowest rank is looked up and all its pairs
    of that rank merge (of overlapping ones the 1st, 3rd, 5th, ...; if the rules are not
    ordered, the leftmost alone); ranks change only beside merged symbols.
    Sequences without a pair that merges are counted and leave."""
    out = np.zeros(len(lengths), np.int64)
    which, lengths, symbols = np.arange(len(lengths)), lengths.astype(np.int64), merges.of_byte[data]
    last = np.zeros(len(symbols), bool)
    last[np.cumsum(lengths) - 1] = True
    rank = np.full(len(symbols), _NONE, np.int32)
    inside = np.flatnonzero(~last)
    rank[inside] = merges(symbols[inside], symbols[inside + 1])
    while len(which):
        lowest = np.minimum.reduceat(rank, np.cumsum(lengths) - lengths)
        done = lowest == _NONE
        if done.any():
            out[which[done]] = lengths[done]
            stay = np.repeat(~done, lengths)
            symbols, rank, last = symbols[stay], rank[stay], last[stay]
            which, lengths, lowest = which[~done], lengths[~done], lowest[~done]
            if not len(which):
                break
        at = np.flatnonzero(rank == np.repeat(lowest, lengths))
        row = np.searchsorted(np.cumsum(lengths), at, "right")
        if merges.ordered:
            place = np.arange(len(at))
            begins = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, place, 0))
            chosen = (place - begins) % 2 == 0
        else:
            chosen = np.diff(row, prepend=-1) != 0
        at, row = at[chosen], row[chosen]
        symbols[at] = merges.product[rank[at]]
        last[at] = last[at + 1]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols, rank, last = symbols[stay], rank[stay], last[stay]
        lengths = lengths - np.bincount(row, minlength=len(lengths))
        at = at - np.arange(len(at))
        before = at[at > 0] - 1
        rank[at] = _NONE
        changed = np.concatenate((at, before))
        changed = changed[~last[changed]]
        rank[changed] = merges(symbols[changed], symbols[changed + 1])
    return out


class Counter:
    """Token counts of texts by a ``.json`` file of a byte-level BPE; pre-tokens
    not met before are merged many at a time."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or spec["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level BPE")
        added = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{path} has added tokens that take part of the text around them")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges, self.known = Merges(model["vocab"], pairs), {}
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, names))) if names else None
        self.general = regex.compile(public_tokenizers.PATTERN).findall

    def pieces(self, text: str) -> list[str]:
        return _ASCII.findall(text) if text.isascii() else self.general(text)

    def learn(self, new: list[str]) -> None:
        held, size = [], 0
        for i, piece in enumerate(new):
            raw = piece.encode()
            held.append(raw)
            size += len(raw)
            if size >= TOGETHER or i == len(new) - 1:
                lengths = np.fromiter(map(len, held), np.int64, len(held))
                counts = surviving(np.frombuffer(b"".join(held), np.uint8), lengths, self.merges)
                self.known.update(zip(new[i + 1 - len(held):i + 1], counts.tolist(), strict=True))
                held, size = [], 0

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each whole text; strings of added tokens count as one token each, as the library does by default."""
        split, specials = [], []
        for text in texts:
            found = len(self.added.findall(text)) if self.added else 0
            specials.append(found)
            split.append(list(chain.from_iterable(map(self.pieces, self.added.split(text)))) if found else self.pieces(text))
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = set().union(*split)
        self.learn(sorted(new))
        out = [n + sum(map(self.known.__getitem__, pieces)) for n, pieces in zip(specials, split, strict=True)]
        for piece in new:
            if len(piece) > REMEMBERED_LENGTH:
                del self.known[piece]
        return out


@lru_cache(4)
def counter(path: str) -> Counter:
    return Counter(path)


def count_texts(texts: list[str | None], path: str) -> list[int]:
    """:meth:`Counter.counts`, in rounds of about ``TOGETHER`` characters of texts."""
    out, held, size = [], [], 0
    for i, text in enumerate(texts):
        held.append(text or "")
        size += len(held[-1])
        if size >= TOGETHER or i == len(texts) - 1:
            out += counter(path).counts(held)
            held, size = [], 0
    return out


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """``row`` (the columns of ``docs`` but the text), ``n_bytes`` (of the text
    in UTF-8) and ``n_tokens`` by the tokenizer file at ``path``, no text cut.

    Null and empty texts have none; repeated rows are counted each, no rows give
    no rows; columns of any other name stay inside ``row``. A very long text is
    split and merged as a whole, its pre-tokens about 1 MB at a time (a longer
    one alone), with a round for each distinct rank it merges. One pass, no shuffle."""

    @per_batch
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = count_texts(batch.column(0).to_pylist(), path)
        return pa.record_batch([batch.column(1), batch.column(2), pa.array(counts, pa.int64())], ["row", "n_bytes", "n_tokens"])

    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select("text", F.struct(*others).alias("row"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, n_bytes long, n_tokens long")


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(TOKENIZER))
    return counted.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))

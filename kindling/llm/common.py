"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.session import scratch_path

#: Separators of words: space and the controls 0x09 to 0x0D.
SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of one given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def written(spark: SparkSession, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` as a table in the shared scratch folder: lineage ends there, and
    a lost executor costs no recomputation of what came before."""
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """A ``mapInArrow`` function out of one that maps single batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield fn(b)

    return run


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of a string column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    h = (h ^ (h >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U64(27))) * _U64(0x94D049BB133111EB)
    return h ^ (h >> _U64(31))


def _byte_table(separator) -> np.ndarray:
    return np.array([separator(b) for b in range(256)], bool)


#: Bytes between words: white space alone, or all that is no letter, digit or part of a longer character.
BY_SPACE = _byte_table(lambda b: b == 0x20 or 9 <= b <= 13)
BY_NON_LETTER = _byte_table(lambda b: b < 128 and not chr(b).isalnum())
_CODES = mix(np.arange(1, 257, dtype=_U64) * _U64(_BASE))
_POWERS = {"n": 0, "up": np.empty(0, _U64), "down": np.empty(0, _U64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2 to the 64th."""
    if _POWERS["n"] < n:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, _U64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=_U64)
        _POWERS["n"] = size
    return _POWERS["up"], _POWERS["down"]


def _blocks(text: bytes, separators: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """A whole text in blocks of about 1 MB that end at a separator, which
    bounds the memory of very long texts: the bytes, where words start and end,
    prefix sums of the bytes' polynomial and the powers to divide it by."""
    data, at = np.frombuffer(text, np.uint8), 0
    while at < len(data):
        end = at + _BLOCK
        if end < len(data):
            while end < len(data) and not separators[data[end:end + _BLOCK]].any():
                end += _BLOCK
            if end < len(data):
                end += int(np.argmax(separators[data[end:end + _BLOCK]]))
        part = data[at:end]
        at = min(end, len(data))
        gap = separators[part]
        edges = np.diff(np.concatenate(([True], gap, [True])).view(np.int8))
        starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        if not len(starts):
            continue
        up, down = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, _U64)
        np.cumsum(_CODES[part] * up[:len(part)], out=sums[1:])
        yield part, starts, ends, sums, down


def word_hashes(text: bytes, separators: np.ndarray = BY_SPACE) -> np.ndarray:
    """64-bit hashes of the words of a whole text, in order.

    A word's hash is a polynomial in its bytes, got from two prefix sums, so no
    word becomes a Python object."""
    out = [mix((sums[ends] - sums[starts]) * down[starts]) for _, starts, ends, sums, down in _blocks(text, separators)]
    return np.concatenate(out) if out else np.empty(0, _U64)


def beginnings(text: bytes, lengths: tuple[int, ...], separators: np.ndarray = BY_SPACE) -> list[np.ndarray]:
    """For each of ``lengths`` the 64-bit hashes of the first so many characters of all longer words, in order."""
    out: list[list[np.ndarray]] = [[] for _ in lengths]
    for part, starts, ends, sums, down in _blocks(text, separators):
        characters = np.append(np.flatnonzero((part & 0xC0) != 0x80), [len(part)] * max(lengths))
        first = np.searchsorted(characters, starts)
        for found, n in zip(out, lengths, strict=True):
            stop = characters[first + n]
            longer = stop < ends
            begin = starts[longer]
            found.append(mix((sums[stop[longer]] - sums[begin]) * down[begin]))
    return [np.concatenate(found) if found else np.empty(0, _U64) for found in out]


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all windows of ``n`` words; no window of fewer words."""
    if len(words) < n:
        return np.empty(0, _U64)
    h = words[:len(words) - n + 1]
    for i in range(1, n):
        h = mix(h * _U64(_BASE) + words[i:len(words) - n + 1 + i])
    return h


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """The sorted distinct hashes of a text's ``n``-word shingles, ASCII letters
    lower-cased; a text of fewer words is one shingle, one without words none."""
    words = word_hashes(text.lower()) if text else np.empty(0, _U64)
    if not len(words):
        return words
    return np.unique(windows(words, n if len(words) >= n else len(words)))


def binary_array(rows: list[bytes | None]) -> pa.Array:
    return pa.array(rows, pa.binary())


def ascii_lower(col):
    """Lower-cases A-Z and nothing else."""
    return F.translate(col, UPPER, LOWER)

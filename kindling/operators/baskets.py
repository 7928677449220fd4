"""Sums over all pairs of items of a user, without a row for every pair in a shuffle.

A user's items (the basket) are packed with those of other users into columns of
bytes, and dealt once to each group of items it touches; a group then makes the pairs of its own items and adds
them up where it stands. A pair belongs to the group of its item that comes first in the order of (group, item), so
it is made in one place and its sums need no second shuffle. The number of groups follows the number of pairs.

The tasks hold one user's basket, and of a group the sums of its pairs and ``at_once`` pairs more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ratings that are packed together, and dealt entries that are laid out at a time.
PACKED, LAID_OUT = 1 << 17, 1 << 22
#: Pairs that a group is meant to make, and the most groups.
PAIRS_PER_GROUP, MAX_GROUPS = 2_000_000, 4096

SUMS = "item_i bigint, item_j bigint, sxx double, syy double, sxy double, n bigint"


def _pack(lens: np.ndarray, own: np.ndarray, items: np.ndarray, ratings: np.ndarray, valid: np.ndarray) -> bytes:
    """Baskets as bytes: of 8-byte numbers the first bytes, then the second ones and so on, which compress well."""
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes() for x in (items, ratings)]
    raw = b"".join([np.array([len(lens), len(items)], np.int64).tobytes(), lens.astype(np.int64).tobytes(), own.astype(np.int64).tobytes(),
                    *planes, valid.astype(np.uint8).tobytes()])
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def _unpack(packed: bytes) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(pa.Codec("zstd").decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True), np.uint8)
    runs, n = raw[:16].view(np.int64).tolist()
    ends = np.cumsum([16, 8 * runs, 8 * runs, 8 * n, 8 * n, n])
    lens, own, items, ratings, valid = (raw[a:z] for a, z in zip(ends[:-1], ends[1:], strict=True))
    items, ratings = (np.ascontiguousarray(x.reshape(8, -1).T).reshape(-1) for x in (items, ratings))
    return lens.view(np.int64), own.view(np.int64), items.view(np.int64), ratings.view(np.float64), valid.astype(bool)


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _whole_baskets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (user, item, rating) in the order of users -> packed baskets of two items and more, and their pairs."""

    def packed(user, items, ratings, valid):
        starts = np.flatnonzero(np.append(True, user[1:] != user[:-1])) if len(user) else np.empty(0, np.int64)
        lens = np.diff(np.append(starts, len(user)))
        used = np.repeat(lens > 1, lens)
        lens = lens[lens > 1]
        if len(lens):
            blob = _pack(lens, lens, items[used], ratings[used], valid[used])
            yield pa.record_batch([pa.array([int((lens * (lens - 1) // 2).sum())], pa.int64()), pa.array([blob], pa.binary())], names=["pairs", "packed"])

    held, size, limit = [], 0, PACKED
    for b in batches:
        if b.num_rows:
            rating = b.column(2)
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy(), rating.fill_null(0.0).to_numpy(), rating.is_valid().to_numpy(zero_copy_only=False)))
            size += b.num_rows
        if size >= limit:
            whole = [np.concatenate(x) for x in zip(*held, strict=True)]
            last = int(np.searchsorted(whole[0], whole[0][-1]))  # the last user may go on in the next batch
            yield from packed(*(x[:last] for x in whole))
            held, size = [tuple(x[last:] for x in whole)], size - last
            limit = max(PACKED, 2 * size)
    if size:
        yield from packed(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _group_of(items: np.ndarray, groups: int) -> np.ndarray:
    h = items.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(groups)).astype(np.int64)


def _dealt(groups: int):
    """Packed baskets -> for each group those that have an item of it, from that item on in the order of (group, item)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packed in (p for b in batches for p in b.column(0).to_pylist()):
            lens, _, items, ratings, valid = _unpack(packed)
            basket, group = np.repeat(np.arange(len(lens)), lens), _group_of(items, groups)
            order = np.lexsort((items, group, basket))
            items, ratings, valid, group = items[order], ratings[order], valid[order], group[order]
            starts = np.flatnonzero(np.append(True, (basket[1:] != basket[:-1]) | (group[1:] != group[:-1])))
            own, rest = np.diff(np.append(starts, len(items))), np.cumsum(lens)[basket[starts]] - starts
            by = np.argsort(group[starts], kind="stable")
            by = by[rest[by] > 1]
            starts, own, rest = starts[by], own[by], rest[by]
            target, filled = group[starts], np.cumsum(rest)
            at = 0
            while at < len(starts):
                done = filled[at - 1] if at else 0
                z = max(at + 1, int(np.searchsorted(filled, done + LAID_OUT, "right")))
                laid = np.repeat(starts[at:z], rest[at:z]) + _ramp(rest[at:z])
                i, r, v = items[laid], ratings[laid], valid[laid]
                cuts = [*(at + np.flatnonzero(np.append(True, target[at + 1:z] != target[at:z - 1]))).tolist(), z]
                rows = []
                for a, e in zip(cuts[:-1], cuts[1:], strict=True):
                    s = slice((filled[a - 1] if a else 0) - done, filled[e - 1] - done)
                    rows.append((int(target[a]), _pack(rest[a:e], own[a:e], i[s], r[s], v[s])))
                ids, blobs = zip(*rows, strict=True)
                yield pa.record_batch([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], names=["group", "packed"])
                at = z

    return run


class _Sums:
    """Sums by pair of items of the rows added so far: ``keys`` and columns sxx, syy, sxy, n and the numbers of values that are not null in each sum."""

    def __init__(self):
        self.parts, self.size, self.merged = [], 0, 0

    def add(self, lo: np.ndarray, hi: np.ndarray, columns: list[np.ndarray]) -> None:
        if len(lo):
            self.parts.append(self._grouped(lo, hi, columns))
            self.size += len(self.parts[-1][0])
            if self.size > 2 * self.merged + PAIRS_PER_GROUP:
                self.merge()

    def merge(self) -> None:
        if len(self.parts) > 1:
            lo, hi, *columns = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            self.parts = [self._grouped(lo, hi, columns)]
        self.size = self.merged = sum(len(p[0]) for p in self.parts)

    @staticmethod
    def _grouped(lo, hi, columns):
        low, base = int(lo.min()), int(hi.min())
        width = int(hi.max()) - base + 1
        if (int(lo.max()) - low + 1) * width < 2**63:
            order = np.argsort((lo - low) * width + (hi - base))
        else:
            order = np.lexsort((hi, lo))
        lo, hi = lo[order], hi[order]
        starts = np.flatnonzero(np.append(True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])))
        return (lo[starts], hi[starts], *(np.add.reduceat(c[order], starts) for c in columns))

    def batches(self, min_n: int) -> Iterator[pa.RecordBatch]:
        self.merge()
        for lo, hi, *sums, n, a, b, both in self.parts:
            kept = n >= min_n
            values = [pa.array(x[kept], mask=(valid == 0)[kept]) for x, valid in zip(sums, (a, b, both), strict=True)]
            out = pa.record_batch([pa.array(lo[kept]), pa.array(hi[kept]), *values, pa.array(n[kept])], names=["item_i", "item_j", "sxx", "syy", "sxy", "n"])
            for at in range(0, out.num_rows, 1 << 16):
                yield out.slice(at, 1 << 16)


def _add_pairs(sums: _Sums, held: list[tuple[np.ndarray, ...]], at_once: int) -> None:
    lens, own, items, ratings, valid = (np.concatenate(x) for x in zip(*held, strict=True))
    starts = np.cumsum(lens) - lens
    first = np.repeat(starts, own) + _ramp(own)
    counts = np.repeat(starts + lens, own) - first - 1
    filled, at = np.cumsum(counts), 0
    while at < len(first):
        z = max(at + 1, int(np.searchsorted(filled, (filled[at - 1] if at else 0) + at_once, "right")))
        i = np.repeat(first[at:z], counts[at:z])
        j = i + 1 + _ramp(counts[at:z])
        x, y = items[i], items[j]
        i, j = np.where(x < y, i, j), np.where(x < y, j, i)
        if (x == y).any():
            i, j = i[x != y], j[x != y]
        p, q, a, b = ratings[i], ratings[j], valid[i], valid[j]
        one = np.ones(len(i), np.int64)
        seen = [c.astype(np.int64) for c in (a, b, a & b)]
        sums.add(items[i], items[j], [p * p, q * q, p * q if valid.all() else np.where(a & b, p * q, 0.0), one, *seen])
        at = z


def _summed(min_n: int, at_once: int):
    """Dealt baskets in the order of their groups -> the sums of each group's pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums, held, size = None, _Sums(), [], 0
        for b in batches:
            for group, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if group != now:
                    if held:
                        _add_pairs(sums, held, at_once)
                    yield from sums.batches(min_n)
                    now, sums, held, size = group, _Sums(), [], 0
                held.append(_unpack(packed))
                size += len(held[-1][2])
                if size >= at_once:
                    _add_pairs(sums, held, at_once)
                    held, size = [], 0
        if held:
            _add_pairs(sums, held, at_once)
        yield from sums.batches(min_n)

    return run


def pair_sums(r: DataFrame, min_n: int = 1, at_once: int = PAIRS_PER_GROUP) -> DataFrame:
    """(item_i, item_j, sxx, syy, sxy, n) with item_i < item_j and n >= min_n, out of rows (user, item, rating): two longs that
    are not null and a double. Null ratings count in n and add nothing."""
    by_user = r.repartition("user").sortWithinPartitions("user")
    packed = by_user.mapInArrow(_whole_baskets, "pairs bigint, packed binary").checkpoint()
    pairs = packed.agg(F.sum("pairs")).first()[0] or 0
    groups = int(min(max(-(-pairs // PAIRS_PER_GROUP), 1), MAX_GROUPS))
    dealt = packed.select("packed").mapInArrow(_dealt(groups), "group int, packed binary")
    return dealt.repartition("group").sortWithinPartitions("group").mapInArrow(_summed(min_n, at_once), SUMS)

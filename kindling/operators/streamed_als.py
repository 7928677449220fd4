"""ALS over blocks whose ratings are streamed, for ratings that Spark's ``ALS`` could not hold.

``ALS`` builds, sorts and keeps a block's ratings in one task's memory, and sends a factor to each block that rates it: few
blocks need memory that grows with the ratings, many send nearly a vector a rating. Here users and items are hashed to slices,
and slices dealt to blocks. A block's ratings are packed once, slice by slice, and every iteration reads them as a stream behind
the factors of the other side, which is what the task holds, along with a slice or a few; so a few blocks do at any number of
ratings. Only factors that a block's ratings refer to are sent to it, and the least squares are those of ``ALS`` (explicit
ratings, lambda times the number of ratings, sums in doubles).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of the other side's factors that a task is meant to hold at most.
FACTOR_BYTES = 256 << 20
#: Ratings that a slice is meant to hold, and the most slices of a side (numbered by two bytes).
SLICE_RATINGS, MAX_SLICES = 1 << 19, 4096
#: Ratings that are multiplied, and users or items that are solved at a time.
BATCH, SOLVED = 1 << 14, 1 << 13
#: Iterations after which factors are checkpointed, so that what was shuffled before can go.
KEEP_EVERY = 4

PIECE = "own int, slice int, ids binary, ranks binary, ratings binary"
SLICE = "own int, ids binary, counts binary, slices binary, ranks binary, ratings binary, asked binary"


def streamed_blocks(ratings: int, users: int, items: int, rank: int, blocks: int) -> int:
    """At least ``blocks``, and as many as keep a block's share of the other side's factors within ``FACTOR_BYTES``. Of ``n``
    factors with ``ratings / n`` ratings each a block asks for ``n * (1 - (1 - 1 / blocks) ** (ratings / n))``, or fewer if
    some have more ratings than others."""
    def asked(n: int) -> float:
        return n * (1 - (1 - 1 / blocks) ** (ratings / n)) if n else 0

    while 4 * rank * max(asked(users), asked(items)) > FACTOR_BYTES:
        blocks += max(blocks // 8, 1)
    return blocks


def _block(key: int) -> int:
    return key


def _slot(col: str, slices: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(slices)).cast("int")


def _checked(data: DataFrame) -> DataFrame:
    """The rows, or the errors that ``ALS`` raises for them."""
    def unless(bad: Column, says: str, col: str) -> Column:
        return F.when(bad, F.raise_error(F.lit(says))).otherwise(F.col(col)).alias(col)

    rating = F.col("rating")
    infinite = F.abs(rating) == F.lit(float("inf"))
    return data.select(*(unless(F.col(c).isNull(), f"{c} Ids MUST NOT be Null", c) for c in ("user", "item")),
                       unless(rating.isNull() | F.isnan(rating) | infinite, "Ratings MUST NOT be Null, NaN or Infinity", "rating"))


def _ranked(table: pa.Table) -> pa.Table:
    """The ratings of a block and a slice of the other side, by the block's slices: own id, the other id's rank among those
    of the other slice that the block refers to, rating."""
    own, col = table["own"].to_numpy(), table["col"].to_numpy()
    ranks = np.unique(col, return_inverse=True)[1].astype(np.int32)
    order = np.argsort(own, kind="stable")
    names, start = np.unique(own[order], return_index=True)
    parts = [np.split(x[order], start[1:]) for x in (table["id"].to_numpy(), ranks, table["rating"].to_numpy())]
    return pa.table([pa.array(names, pa.int32()), pa.array(np.full(len(names), table["slice"][0].as_py(), np.int32)),
                     *(pa.array([x.tobytes() for x in p], pa.binary()) for p in parts)], names=["own", "slice", "ids", "ranks", "ratings"])


def _packed(blocks: int, table: pa.Table) -> pa.Table:
    """A slice: its ids in order and their numbers of ratings; the ratings, by ids in the order of those numbers; and for each
    block of the other side whether it refers to an id."""
    def joined(name: str, kind: type) -> np.ndarray:
        return np.concatenate([np.frombuffer(x, kind) for x in table[name].to_pylist()])

    rows = joined("ids", np.int32)
    slices = np.repeat(table["slice"].to_numpy(), [len(x) // 4 for x in table["ids"].to_pylist()]).astype(np.uint16)
    ids, at, counts = np.unique(rows, return_inverse=True, return_counts=True)
    asked = np.zeros((blocks, len(ids)), bool)
    asked[slices % blocks, at] = True
    place = np.empty(len(ids), np.int32)
    place[np.argsort(counts, kind="stable")] = np.arange(len(ids))
    order = np.argsort(place[at], kind="stable")
    fields = (ids, counts.astype(np.int32), slices[order], joined("ranks", np.int32)[order], joined("ratings", np.float32)[order], np.packbits(asked))
    return pa.table([table["own"][:1], *(pa.array([x.tobytes()], pa.binary()) for x in fields)], names=["own", "ids", "counts", "slices", "ranks", "ratings", "asked"])


def _slices(data: DataFrame, row: str, col: str, blocks: int, slices: int) -> RDD:
    """``data`` by slices of ``row``, packed, in a partition a block."""
    own = _slot(row, slices)
    cells = data.select((own % blocks).alias("block"), _slot(col, slices).alias("slice"), own.alias("own"),
                        F.col(row).alias("id"), F.col(col).alias("col"), "rating")
    pieces = cells.groupBy("block", "slice").applyInArrow(_ranked, PIECE)
    packed = pieces.groupBy("own").applyInArrow(lambda table: _packed(blocks, table), SLICE)
    laid = packed.rdd.map(lambda r: (r[0] % blocks, (r[0], *map(bytes, r[1:])))).partitionBy(blocks, _block)
    laid.checkpoint()
    return laid


def _asked(blocks: int, asked: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(asked, np.uint8), count=blocks * n).reshape(blocks, n).astype(bool)


def _sizes(laid: RDD, blocks: int, slices: int) -> np.ndarray:
    """How many factors of each slice go to each block: a number a slice and block."""
    counted = laid.map(lambda x: (x[1][0], _asked(blocks, x[1][6], len(x[1][1]) // 4).sum(axis=1).tolist())).collect()
    sizes = np.zeros((slices, blocks), np.int64)
    for own, numbers in counted:
        sizes[own] = numbers
    return sizes


def _first(rank: int, seed: int, record: tuple) -> tuple:
    """A slice's first factors: random directions of length 1, as those of ``ALS``."""
    own, ids, *_, asked = record[1]
    x = np.random.default_rng([seed & (2**64 - 1), own]).standard_normal((len(ids) // 4, rank))
    return own, ids, (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).tobytes(), asked


def _to_blocks(blocks: int, rank: int, record: tuple) -> Iterator[tuple]:
    own, _, factors, asked = record
    x = np.frombuffer(factors, np.float32).reshape(-1, rank)
    for block, wanted in enumerate(_asked(blocks, asked, len(x))):
        if wanted.any():
            yield block, (own, x[wanted].tobytes())


def _least_squares(factors: np.ndarray, offsets: np.ndarray, record: tuple, reg: float) -> np.ndarray:
    """The factors of a slice's ids. Ids with equal numbers of ratings are multiplied together."""
    _, _, counts, slices, ranks, ratings, _ = record
    counts, slices, ranks, ratings = (np.frombuffer(x, t) for x, t in ((counts, np.int32), (slices, np.uint16), (ranks, np.int32), (ratings, np.float32)))
    by = np.argsort(counts, kind="stable")
    lens = counts[by].astype(np.int64)
    start, rank = np.cumsum(lens) - lens, factors.shape[1]
    out = np.empty((len(by), rank), np.float32)
    for low in range(0, len(by), SOLVED):
        n = lens[low:low + SOLVED]
        a, b = reg * n[:, None, None] * np.eye(rank), np.zeros((len(n), rank))
        runs = np.flatnonzero(np.append(True, n[1:] != n[:-1]))
        for i, z in zip(runs.tolist(), [*runs[1:].tolist(), len(n)], strict=True):
            c = int(n[i])
            step = max(BATCH // c, 1)
            for j in range(i, z, step):
                k = min(j + step, z)
                for part in range(0, c, BATCH):  # one, unless an id has more ratings than a batch
                    width = min(BATCH, c - part)
                    y = int(start[low + j]) + part
                    at = slice(y, y + (k - j) * width)
                    x = factors.take(offsets.take(slices[at]) + ranks[at], axis=0).astype(np.float64).reshape(k - j, width, rank)
                    turned = np.ascontiguousarray(x.transpose(0, 2, 1))
                    a[j:k] += turned @ x
                    b[j:k] += (turned @ ratings[at].astype(np.float64).reshape(k - j, width, 1))[:, :, 0]
        out[by[low:low + SOLVED]] = np.linalg.solve(a, b[:, :, None])[:, :, 0]
    return out


def _solved(sizes: np.ndarray, rank: int, reg: float, records: Iterator[tuple]) -> Iterator[tuple]:
    """A block's records, first the factors sent to it and then its slices -> its slices' new factors."""
    factors = offsets = None
    for block, record in records:
        if factors is None:
            ends = np.cumsum(sizes[:, block])
            factors, offsets = np.empty((int(ends[-1]), rank), np.float32), ends - sizes[:, block]
        if len(record) == 2:
            own, sent = record
            x = np.frombuffer(sent, np.float32).reshape(-1, rank)
            factors[offsets[own]:offsets[own] + len(x)] = x
        else:
            yield record[0], record[1], _least_squares(factors, offsets, record, reg).tobytes(), record[6]


def _expanded(rank: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for ids, factors in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(ids) // 4 * rank + 1, rank), pa.int32()), pa.array(np.frombuffer(factors, np.float32)))
            yield pa.record_batch([pa.array(np.frombuffer(ids, np.int32)), lists], names=["id", "features"])


def _kept(state: RDD) -> RDD:
    """``state``, checkpointed now; kept beside it meanwhile, as it would be made twice otherwise."""
    state.persist(StorageLevel.DISK_ONLY)
    state.checkpoint()
    state.count()
    return state.unpersist()


def fit_streamed(data: DataFrame, rank: int, max_iter: int, reg: float, seed: int, ratings: int, blocks: int) -> ALSModel:
    """The model that ``ALS`` fits to ``data`` (user int, item int, rating float), but for its random start, in ``blocks`` blocks."""
    spark = data.sparkSession
    slices = blocks * -(-min(ratings // SLICE_RATINGS + 1, MAX_SLICES) // blocks)
    data = _checked(data)
    sides = [_slices(data, *pair, blocks, slices) for pair in (("user", "item"), ("item", "user"))]
    sizes = [_sizes(laid, blocks, slices) for laid in sides]
    state = [laid.map(partial(_first, rank, seed + i)) for i, laid in enumerate(sides)]

    def fitted(to: int) -> RDD:
        sent = state[1 - to].flatMap(partial(_to_blocks, blocks, rank)).partitionBy(blocks, _block)
        both = sent.union(sides[to])
        if both.getNumPartitions() != blocks:
            raise RuntimeError("factors and ratings of a block must meet in its partition")
        return both.mapPartitions(partial(_solved, sizes[1 - to], rank, reg))

    for i in range(1, max_iter + 1):
        state[1] = fitted(1)
        if i == max_iter:
            state[1] = _kept(state[1])
        state[0] = fitted(0)
        if i == max_iter or i % KEEP_EVERY == 0:
            state[0] = _kept(state[0])
    users, items = (spark.createDataFrame(x.map(lambda r: (r[1], r[2])), "ids binary, factors binary")
                    .mapInArrow(partial(_expanded, rank), "id int, features array<float>").checkpoint() for x in state)
    model = spark._jvm.org.apache.spark.ml.recommendation.ALSModel("streamed_als", rank, users._jdf, items._jdf)
    return ALSModel(model.setUserCol("user").setItemCol("item").setColdStartStrategy("drop"))

"""Toxicity by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import contextlib
import ctypes
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.llm.common import BY_NON_LETTER, beginnings, binary_array, per_batch, word_hashes, written

#: At most about this many labelled documents are fitted.
FIT_ROWS = 20_000
#: Besides whole words, the beginnings of longer words with this many characters are features: they stay where endings vary.
BEGINNINGS = (3, 4, 5, 6)
#: A feature is found in this many fitted documents: a weight for what only one has would be that document's alone.
MIN_DOCS = 2
#: A feature's values are scaled by its z-score in units of this one, so the penalty costs uneven features less. None is left out.
#: A feature of this z-score or more that is found in toxic documents only, or nearly so, is telling.
UNIT_Z = 5.5
#: Toxic documents with this many occurrences of telling words or beginnings of one length are of the higher grade.
SEVERE_FROM = 5
#: Cells of the sparse matrix that are taken at a time.
CELLS = 1 << 18
_KIND_BITS = 3


def feature_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of a whole text (letters and digits, lower-cased) and their counts.

    A feature is 28 bits of a hash and the kind: 0 for whole words, then one for each length of ``BEGINNINGS``."""
    if not text:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    data = text.lower().encode("utf-8", "replace")
    kinds = [word_hashes(data, BY_NON_LETTER), *beginnings(data, BEGINNINGS, BY_NON_LETTER)]
    ids = [(h >> np.uint64(36) << np.uint64(_KIND_BITS) | np.uint64(kind)).astype(np.int32) for kind, h in enumerate(kinds)]
    return np.unique(np.concatenate(ids), return_counts=True)


@dataclass
class Ordinal:
    """P(grade > k) = 1 / (1 + exp(cut[k] - x @ weights)): one set of weights, ordered cuts."""

    features: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray

    def exceeds(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(self.cuts - score[:, None], -50, 50)))


def _value(n: np.ndarray) -> np.ndarray:
    return 1 + np.log(n)


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int,
                l2: float = 1.0, steps: int = 400, tolerance: float = 1e-2) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered cuts of most penalised likelihood for sparse rows.

    The cuts are the first and the logarithms of the gaps, so they stay in
    order. Limited-memory BFGS follows the gradient until its length is at most ``tolerance`` times that of the
    parameters (or 1), which some hundred steps reach; ``steps`` bounds them."""
    order = np.argsort(columns, kind="stable")
    return _optimum(_Loss(rows[order], np.bincount(columns, minlength=n_features), values[order], grades, l2), steps, tolerance)


def _optimum(loss: _Loss, steps: int = 400, tolerance: float = 1e-2) -> tuple[np.ndarray, np.ndarray]:
    theta = loss.start()
    value, gradient = loss(theta)
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        if np.linalg.norm(gradient) <= tolerance * max(1.0, np.linalg.norm(theta)):
            break
        way, taken = -gradient, []
        for s, y, r in reversed(moves):
            taken.append(r * (s @ way))
            way = way - taken[-1] * y
        if moves:
            s, y, r = moves[-1]
            way = way / (r * (y @ y))
        else:
            way = way / np.linalg.norm(gradient)
        for (s, y, r), a in zip(moves, reversed(taken), strict=True):
            way = way + (a - r * (y @ way)) * s
        slope, length = gradient @ way, 1.0
        if slope >= 0:  # rounding has spoilt the curvature: start again from the gradient
            moves, way, slope = [], -gradient, -(gradient @ gradient)
        while True:
            new = theta + length * way
            new_value, new_gradient = loss(new)
            if new_value <= value + 1e-4 * length * slope or length < 1e-10:
                break
            length /= 2
        if length < 1e-10:
            break
        s, y = (new - theta).astype(np.float32), (new_gradient - gradient).astype(np.float32)
        if s @ y > 1e-12 * (y @ y):
            moves = [*moves[-11:], (s, y, 1 / (s @ y))]
        theta, value, gradient = new, new_value, new_gradient
    return theta[:loss.n_features], loss.cuts(theta)


class _Loss:
    """Negative penalised log-likelihood of weights, first cut and logarithms of the gaps, with its gradient."""

    def __init__(self, rows: np.ndarray, found: np.ndarray, values: np.ndarray, grades: np.ndarray, l2: float = 1.0):
        """Cells by column: ``found`` says how many each column has. Rows are looked up all over then, but they are few."""
        self.rows, self.found, self.values, self.grades, self.l2 = rows, found, values, grades, l2
        self.n_features, self.top, self.n = len(found), int(grades.max()), len(grades)
        starts = np.concatenate(([0], np.cumsum(found)))
        cuts = np.unique(np.concatenate((np.searchsorted(starts, np.arange(0, starts[-1], CELLS)), [self.n_features])))
        #: Columns taken together, and their cells.
        self.parts = [(slice(a, z), slice(starts[a], starts[z])) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]

    def scores(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        for of, cells in self.parts:
            out += np.bincount(self.rows[cells], self.values[cells] * np.repeat(w[of], self.found[of]), self.n)
        return out

    def by_column(self, by_row: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n_features)
        for of, cells in self.parts:
            found = self.found[of]
            some = np.flatnonzero(found)
            if len(some):
                out[of][some] = np.add.reduceat(self.values[cells] * by_row[self.rows[cells]], (np.cumsum(found) - found)[some])
        return out

    def start(self) -> np.ndarray:
        above = np.array([(self.grades > k).mean() for k in range(self.top)])
        first = -np.log(above / (1 - above))
        return np.concatenate((np.zeros(self.n_features), first[:1], np.log(np.maximum(np.diff(first), 1e-2))))

    def cuts(self, theta: np.ndarray) -> np.ndarray:
        f = self.n_features
        return np.concatenate((theta[f:f + 1], theta[f] + np.cumsum(np.exp(theta[f + 1:]))))

    def __call__(self, theta: np.ndarray) -> tuple[float, np.ndarray]:
        w, n, grades, at = theta[:self.n_features], self.n, self.grades, np.arange(self.n)
        score = self.scores(w)
        over = 1 / (1 + np.exp(np.clip(self.cuts(theta) - score[:, None], -50, 50)))
        over = np.column_stack((np.ones(n), over, np.zeros(n)))  # P(grade > -1), ..., P(grade > top)
        slope = over * (1 - over)
        upper, lower = slope[at, grades], slope[at, grades + 1]
        chance = np.maximum(over[at, grades] - over[at, grades + 1], 1e-300)
        by_score = (upper - lower) / chance
        by_cut = np.zeros(self.top + 2)
        np.add.at(by_cut, grades, -upper / chance)
        np.add.at(by_cut, grades + 1, lower / chance)
        by_cut = by_cut[1:-1]
        gaps = np.exp(theta[self.n_features + 1:])
        by_gap = np.array([by_cut[k + 1:].sum() * gaps[k] for k in range(self.top - 1)])
        by_weight = self.by_column(by_score) - self.l2 * w
        return -np.log(chance).sum() + self.l2 / 2 * (w @ w), -np.concatenate((by_weight, [by_cut.sum()], by_gap))


@per_batch
def _features(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [feature_counts(t) for t in batch.column(0).to_pylist()]
    ids, counts = (binary_array([f[i].astype(np.int32).tobytes() for f in found]) for i in (0, 1))
    return pa.record_batch([batch.column(1), batch.column(2), ids, counts], ["doc_id", "toxic", "features", "counts"])


def _joined(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.int32)


@per_batch
def _documents_with(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Documents, and toxic ones, of the batch that have each feature."""
    rows = batch.column(2).to_pylist()
    toxic = np.repeat(batch.column(1).to_numpy(zero_copy_only=False).astype(bool), [len(r) // 4 for r in rows])
    features, at = np.unique(_joined(rows), return_inverse=True)
    n, in_toxic = np.bincount(at, minlength=len(features)), np.bincount(at[toxic], minlength=len(features))
    return pa.record_batch([pa.array(features), pa.array(n), pa.array(in_toxic)], ["feature", "n", "in_toxic"])


def _cells(sent):
    """Each document's features that were kept, as their places, and their counts."""

    @per_batch
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns, counts = [], []
        for ids, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            at, hit = _places(sent.value, np.frombuffer(ids, np.int32))
            columns.append(at[hit].tobytes())
            counts.append(np.frombuffer(n, np.int32)[hit].tobytes())
        return pa.record_batch([batch.column(0), batch.column(1), binary_array(columns), binary_array(counts)], ["doc_id", "toxic", "columns", "counts"])

    return run


def _let_go() -> None:
    """Gives the driver's freed memory back to the system: later stages of a pipeline need it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def one_row_an_id(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """Of the rows that share a ``key`` one: of the least text by hash. What is fitted is bounded in ids, and so in rows."""
    least = F.min_by(F.struct("text", *columns), F.xxhash64("text")).alias("least")
    return rows.groupBy(key).agg(least).select(key, "least.*")


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Ordinal | None:
    """An ordinal model out of about ``fit_rows`` labelled documents, chosen by a hash of their id.

    ``labels`` only says toxic or not, so the grades are 0 (not toxic), 1 and 2
    (toxic, with fewer than ``SEVERE_FROM`` occurrences of words, or beginnings
    of one length, that are telling for toxic documents, or more). All words
    and beginnings of words found in ``MIN_DOCS`` fitted documents are features;
    the penalty decides what they weigh. Labels that are null or contradict
    each other don't count; of rows that share an id one is fitted. None if either label is missing.

    Features are counted on the executors. The driver reads, a partition at a time, what the fitted documents have of
    those that were kept, and holds 6 bytes for each (8 with more than 65,536 documents)."""
    known = labels.groupBy("doc_id").agg(F.min("toxic").alias("low"), F.max("toxic").alias("high"))
    known = known.where((F.col("low") == F.col("high")) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("id"), (F.col("low") > 0).alias("toxic"))
    share = min(1.0, fit_rows / max(1, known.count()))
    sample = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else known
    # About fit_rows rows are broadcast, whatever the size of the table.
    sample = one_row_an_id(docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("id")), "doc_id", "toxic")
    found = written(spark, sample.select("text", "doc_id", "toxic").mapInArrow(_features, "doc_id long, toxic boolean, features binary, counts binary"), "toxicity-features")
    n, n_toxic = found.agg(F.count("*"), F.count_if("toxic")).first()
    if not 0 < n_toxic < n:
        return None
    stats = found.mapInArrow(_documents_with, "feature int, n long, in_toxic long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("in_toxic").alias("in_toxic"))
    stats = stats.where(F.col("n") >= MIN_DOCS).select("feature", F.col("n").cast("int"), F.col("in_toxic").cast("int")).toArrow()
    features, n_found, in_toxic = (c.to_numpy() for c in stats.columns)
    order = np.argsort(features)
    features, n_found, in_toxic = features[order], n_found[order], in_toxic[order]
    if not len(features):
        return None
    del stats, order
    sent = spark.sparkContext.broadcast(features)  # 4 bytes for each feature of the fitted documents
    cells = found.mapInArrow(_cells(sent), "doc_id long, toxic boolean, columns binary, counts binary").orderBy("doc_id")
    size = int(n_found.sum(dtype=np.int64))
    rows, values = np.empty(size, np.uint16 if n <= 1 << 16 else np.int32), np.empty(size, np.float32)
    toxic, filled = np.empty(n, bool), np.concatenate(([0], np.cumsum(n_found, dtype=np.int64)))[:-1]
    rate = n_toxic / n
    z = (in_toxic - n_found * rate) / np.sqrt(n_found * rate * (1 - rate))
    severe = (z >= UNIT_Z) & (in_toxic > 0.9 * n_found)
    kinds, signs, scale = features & (1 << _KIND_BITS) - 1, np.zeros(n), np.abs(z) / UNIT_Z
    for i, r in enumerate(cells.toLocalIterator()):
        own, counts = np.frombuffer(r["columns"], np.int32), np.frombuffer(r["counts"], np.int32)
        here = filled[own]  # each feature's next cell
        rows[here], values[here] = i, _value(counts) * scale[own]
        filled[own] += 1
        # A word has one beginning of each length at most.
        signs[i] = np.bincount(kinds[own], counts * severe[own], 1).max()
        toxic[i] = r["toxic"]
    sent.unpersist()
    grades = np.where(toxic, np.where(signs >= SEVERE_FROM, 2, 1), 0)
    grades = np.unique(grades, return_inverse=True)[1]  # a grade that none has gets no cut
    weights, cuts = _optimum(_Loss(rows, n_found, values, grades))
    del rows, values
    _let_go()
    return Ordinal(features, weights * scale, cuts)


def _places(features: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each id is in the sorted ``features``, and whether it is there."""
    at = np.minimum(np.searchsorted(features, ids), len(features) - 1).astype(np.int32)
    return at, features[at] == ids


def severity(spark: SparkSession, docs: DataFrame, model: Ordinal | None) -> DataFrame:
    """``row`` (all columns of ``docs``), ``severity`` (the expected grade: the sum of P(grade > k)) and ``toxic`` (P(grade > 0) >= 0.5).

    Null and empty texts have no words and the severity of a document without
    features. Without a model nothing is toxic. Repeated rows are graded
    alike; no rows give no rows."""
    sent = spark.sparkContext.broadcast(model)  # a weight for each feature of the fitted documents

    @per_batch
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m, score = sent.value, np.zeros(batch.num_rows)
        if m is None:
            return pa.record_batch([batch.column(1), pa.array(score), pa.array(score > 0)], ["row", "severity", "toxic"])
        for i, text in enumerate(batch.column(0).to_pylist()):
            ids, n = feature_counts(text)
            at, hit = _places(m.features, ids)
            score[i] = (_value(n[hit]) * m.weights[at[hit]]).sum()
        over = m.exceeds(score)
        return pa.record_batch([batch.column(1), pa.array(over.sum(1)), pa.array(over[:, 0] >= 0.5)], ["row", "severity", "toxic"])

    rows = docs.select("text", F.struct(*docs.columns).alias("row"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, severity double, toxic boolean")


def toxicity_filter(spark: SparkSession, docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that a model learned from ``labels`` doesn't hold to be toxic."""
    return severity(spark, docs, fit(spark, docs, labels, **how)).where(~F.col("toxic")).select("row.*")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return severity(spark, docs, fit(spark, docs, labels)).select("row.doc_id", "severity", "toxic")

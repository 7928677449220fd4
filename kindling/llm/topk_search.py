"""Exact top-k inner-product search by term-at-a-time accumulation."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindling.llm.common import table

#: Queries that one task holds, rows of a candidate slot, and the tile of dense scores (queries, candidates).
QUERY_BLOCK, SLOT_ROWS, MIN_SLOTS = 32768, 65536, 32
TILE = (128, 2048)
NONE, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def max_weight(dimensions: int) -> int:
    """The greatest weight, of 31 bits at most, with which every score of so many dimensions fits a long."""
    return min(2**31 - 1, math.isqrt((2**63 - 1) // max(1, dimensions)))


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """The vectors that take part, equal rows as one with their number ``copies``: ``id`` and floor(256 * x)
    of each component, as ``weights``, or as ``exact`` (doubles) where a weight passes :func:`max_weight`
    of the longest vector. ``variant`` tells the vectors of an id apart."""
    x = F.col(vector_col)
    fit = F.col(id_col).isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    most = max_weight(vectors.agg(F.max(F.size(x))).first()[0] or 1)
    largest = F.lit(float(np.finfo(np.float64).max))

    def weight(c):
        w = F.greatest(-largest, F.least(largest, c.cast("double") * 256))
        return F.when(F.abs(w) < 2.0**53, F.floor(w).cast("double")).otherwise(w)  # doubles beyond are whole

    rows = vectors.where(fit).select(F.col(id_col).cast("long").alias("id"), F.transform(x, weight).alias("w"))
    rows = rows.groupBy("id", "w").agg(F.count("*").alias("copies"))
    large = F.exists("w", lambda w: F.abs(w) > most)
    return rows.select(
        "id", F.xxhash64("w").alias("variant"), "copies", F.when(~large, F.transform("w", lambda w: w.cast("int"))).alias("weights"),
        F.when(large, F.col("w")).alias("exact"))


def _dense(weights: pa.Array) -> np.ndarray:
    """Rows of weights side by side; shorter vectors end in zeros."""
    values, ends = weights.flatten().to_numpy(zero_copy_only=False), np.cumsum(weights.value_lengths().to_numpy(zero_copy_only=False))
    lengths = np.diff(np.concatenate(([0], ends)))
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = values
    return out


class _Queries:
    """The queries of one block with their best candidates so far: ``best`` of those whose scores a long
    surely holds, ``exact_best`` of pairs with a vector of large weights, in whole Python numbers."""

    def __init__(self, k: int):
        self.k, self.ids, self.variants, self.weights = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 0), np.int64)
        self.best = tuple(np.empty((0, k), np.int64) for _ in range(3))
        self.large, self.exact_best = [], {}

    def add(self, ids: np.ndarray, variants: np.ndarray, weights: np.ndarray) -> None:
        width = max(self.weights.shape[1], weights.shape[1])
        widen = lambda w: np.pad(w, ((0, 0), (0, width - w.shape[1])))
        self.ids, self.variants = np.concatenate((self.ids, ids)), np.concatenate((self.variants, variants))
        self.weights = np.concatenate((widen(self.weights), widen(weights)))
        self.best = tuple(np.full((len(self.ids), self.k), x) for x in (NONE, MOST, 0))

    def search(self, ids: np.ndarray, copies: np.ndarray, weights: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, copies, weights = ids[order], copies[order], weights[order]
        for c in range(0, len(ids), TILE[1]):
            postings = [(d, rows, column[rows]) for d, column in enumerate(weights[c:c + TILE[1]].T) if len(rows := np.flatnonzero(column))]
            for q in range(0, len(self.ids), TILE[0]):
                self._tile(slice(q, q + TILE[0]), ids[c:c + TILE[1]], copies[c:c + TILE[1]], postings)
        if self.large:
            self.search_exact(self.large, zip(ids.tolist(), copies.tolist(), weights.tolist(), strict=True))

    def search_large(self, candidates: list) -> None:
        ordinary = zip(self.ids.tolist(), self.variants.tolist(), self.weights.tolist(), strict=True)
        for query in (*self.large, *ordinary):
            self.search_exact([query], candidates)

    def search_exact(self, queries: list, candidates) -> None:
        """``queries`` are (id, variant, weights), ``candidates`` (id, copies, weights); a shorter vector ends in zeros."""
        for id_, copies, weights in candidates:
            for query, variant, own in queries:
                if id_ != query:
                    found = self.exact_best.setdefault((query, variant), [])
                    (heapq.heappush if len(found) < self.k else heapq.heappushpop)(found, (sum(map(mul, own, weights)), -id_, copies))

    def _tile(self, at: slice, ids: np.ndarray, copies: np.ndarray, postings: list) -> None:
        query = self.weights[at]
        scores = np.zeros((len(query), len(ids)), np.int64)
        for d, rows, values in postings:  # a term at a time
            if d >= query.shape[1]:
                break
            terms = np.flatnonzero(query[:, d])
            if len(rows) == len(ids) and len(terms) == len(query):
                scores += query[:, d, None] * values
            else:
                scores[terms[:, None], rows] += query[terms, d, None] * values
        first, end = (np.searchsorted(ids, self.ids[at], side) for side in ("left", "right"))
        for i in np.flatnonzero(end > first):  # the query's own rows
            scores[i, first[i]:end[i]] = NONE
        if scores.shape[1] > self.k:
            # The k best of each row: all above the k-th score, and of those equal to it the first, which have the smaller ids.
            least = np.partition(scores, -self.k, axis=1)[:, -self.k, None]
            over = scores > least
            ties = scores == least
            take = over | ties & (np.cumsum(ties, axis=1, dtype=np.int32) <= self.k - over.sum(axis=1)[:, None])
            columns = np.nonzero(take)[1].reshape(len(scores), self.k)
            scores = np.take_along_axis(scores, columns, 1)
        else:
            columns = np.broadcast_to(np.arange(len(ids)), scores.shape)
        held = [np.concatenate((best[at], x), 1) for best, x in zip(self.best, (scores, ids[columns], copies[columns]), strict=True)]
        order = np.lexsort((held[1], -np.maximum(held[0], NONE + 1)), axis=1)[:, :self.k]
        for best, x in zip(self.best, held, strict=True):
            best[at] = np.take_along_axis(x, order, 1)

    def batch(self) -> pa.RecordBatch:
        rows, columns = np.nonzero(self.best[0] != NONE)
        scores, ids, copies = (x[rows, columns] for x in self.best)
        found = [(query, variant, -id_, *_in_long(score), n) for (query, variant), best in self.exact_best.items() for score, id_, n in best]
        ends = list(zip(*found, strict=True)) if found else [()] * 6
        ordinary = (self.ids[rows], self.variants[rows], ids, scores, ["m"] * len(rows), copies)
        types = (pa.int64(),) * 4 + (pa.string(), pa.int64())
        return pa.record_batch(
            [pa.array([*a, *b] if b else a, t) for a, b, t in zip(ordinary, ends, types, strict=True)],
            ["query_id", "variant", "id", "score", "beyond", "copies"])


def _in_long(score: int) -> tuple[int, str]:
    """The score as near as a long comes to it, and a text that orders the scores beyond a long."""
    digits = str(abs(score))
    if NONE < score <= MOST:
        return score, "m"
    if score > 0:
        return MOST, f"z{len(digits):04d}{digits}"
    return NONE, f"a{9999 - len(digits):04d}{''.join(str(9 - int(d)) for d in digits)}"


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, _Queries(k)
        for b in batches:
            blocks, slots, kinds = (b.column(i).to_numpy() for i in range(3))
            ids, tags, weights, exact = b.column(3).to_numpy(), b.column(4).to_numpy(), b.column(5), b.column(6)
            large = weights.is_null().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(slots) != 0) | (np.diff(kinds) != 0)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(ids)], strict=True):
                if end == start:
                    continue
                if now != (blocks[start], slots[start]):
                    yield held.batch()
                    now, held = (blocks[start], slots[start]), _Queries(k)
                at = np.arange(start, end)
                plain, wide = at[~large[start:end]], at[large[start:end]]
                if len(plain):
                    (held.search if kinds[start] else held.add)(ids[plain], tags[plain], _dense(weights.take(pa.array(plain))))
                if len(wide):
                    whole = [(int(ids[i]), int(tags[i]), [int(w) for w in exact[int(i)].as_py()]) for i in wide]
                    held.search_large(whole) if kinds[start] else held.large.extend(whole)
        yield held.batch()

    return run


def exact_top_k(spark: SparkSession, vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each query's ``k`` best candidates among all other rows by the integer
    inner product of quantised vectors: ``query_id``, ``rank``, ``id``, ``score``;
    ties go to the smaller id, with fewer candidates all are returned.

    Every task holds a block of queries and streams a slot of candidates past
    it: per dimension the candidates' non-zero weights are a posting list, and
    each non-zero query weight scatters its products into a dense array of
    scores. The best of each slot are selected there and merged afterwards, so
    a query brings ``k`` rows a slot to the merge. Both sides are dealt out in
    a grid of query blocks and candidate slots: nothing is broadcast, and no
    task holds more than one block and one batch.

    Vectors that are null or hold null or non-finite components, and rows with
    a null id, take no part. Every row is a candidate of its own, whatever id it
    shares; rows with the query's id are the query's own and are none. Each
    different vector of a query's id is a query, with a list of its own. An empty vector, and one with zeros only, scores 0. Vectors may
    differ in length; missing components are 0. Pairs with a weight beyond :func:`max_weight` of the longest vector are
    scored in whole Python numbers, which is slow: ranks are exact at any size, and a score that no long holds is given
    as the nearest long. Very long vectors cost their length in every task they go to; other columns are not read.
    """
    rows = quantised(vectors, id_col, vector_col)
    query = rows.where(is_query(F.col("id")))
    n, n_queries = rows.agg(F.count("*"), F.count_if(is_query(F.col("id")))).first()
    blocks, slots = max(1, -(-n_queries // QUERY_BLOCK)), max(MIN_SLOTS, -(-n // SLOT_ROWS))
    spread = lambda n, salt: F.pmod(F.xxhash64("id", "variant", F.lit(salt)), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    vector = ("weights", "exact")
    query = query.select(spread(blocks, 1).alias("block"), all_of(slots).alias("slot"), F.lit(0).alias("kind"), "id", F.col("variant").alias("tag"), *vector)
    candidate = rows.select(all_of(blocks).alias("block"), spread(slots, 2).alias("slot"), F.lit(1).alias("kind"), "id", F.col("copies").alias("tag"), *vector)
    grid = query.unionByName(candidate).repartition("block", "slot").sortWithinPartitions("block", "slot", "kind")
    best = grid.mapInArrow(_search(k), "query_id long, variant long, id long, score long, beyond string, copies long")
    best = best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))))
    order = Window.partitionBy("query_id", "variant").orderBy(F.desc("score"), F.desc("beyond"), "id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_top_k(spark, table(spark, sf_dir, "embeddings", "vec_id", "embedding"), lambda i: i % 50 == 0)
    return found.withColumnRenamed("id", "vec_id")


OP4_SQL = """
WITH fit AS (
  SELECT vec_id, embedding, row_number() OVER () AS r FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), weights AS (
  SELECT r, vec_id, generate_subscripts(embedding, 1) AS d, CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS w FROM fit
), queries AS (
  SELECT * FROM weights WHERE r IN (SELECT min(r) FROM fit WHERE vec_id % 50 = 0 GROUP BY vec_id, embedding)
), scores AS (
  SELECT q.r AS query_row, q.vec_id AS query_id, c.r, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
  FROM queries q JOIN weights c ON q.d = c.d AND q.vec_id <> c.vec_id
  GROUP BY ALL
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) <= 5
"""

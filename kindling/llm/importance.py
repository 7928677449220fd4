"""Importance resampling towards a target distribution, by bit-sliced aggregation."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.llm.common import LOWER, UPPER, table, utf8
from kindling.operators.splits import global_row_number

#: Buckets of features, words a feature has at most, per cent of documents drawn, words that a drawn document has at least, seed of the noise.
BUCKETS, MAX_WORDS, PERCENT, MIN_WORDS, SEED = 10_000, 1, 10, 20, 2024
#: Buckets of features that a worker remembers and their greatest length; documents whose planes are ANDed side by side. They bound memory only.
REMEMBERED, REMEMBERED_LENGTH, SIDE_BY_SIDE = 1 << 20, 64, 256
_U64 = np.uint64
#: Bytes of words stay, A-Z in lower case; all others become spaces.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Buckets:
    """The buckets of texts' features: all runs of 1 to ``max_words`` words,
    joined by one space; a feature's bucket is its bytes' CRC-32 modulo ``n``."""

    def __init__(self, n: int, max_words: int):
        self.n, self.max_words, self.known = n, max_words, {}

    def __call__(self, text: bytes | None) -> tuple[int, np.ndarray]:
        """The text's words, counted, and the bucket of each feature."""
        words = text.translate(_WORDS).split() if text else []
        features = list(words)
        for k in range(2, self.max_words + 1):
            features += [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]
        new = set(features).difference(self.known)
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = set(features)
            self.known.update((f, zlib.crc32(f) % self.n) for f in new)
        out = np.fromiter(map(self.known.__getitem__, features), np.int64, len(features))
        for f in new:
            if len(f) > REMEMBERED_LENGTH:
                del self.known[f]
        return len(words), out


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of non-negative integers: ``values`` (rows, buckets) become
    (rows, planes, words of 64 buckets); plane p has a bit for each bucket whose value has the bit p."""
    rows, buckets = values.shape
    depth = max(1, int(values.max(initial=0)).bit_length())
    wide = np.zeros((rows, depth, -(-buckets // 64) * 64), np.uint8)
    for p in range(depth):
        wide[:, p, :buckets] = values >> p & 1
    return np.packbits(wide, axis=2, bitorder="little").view(_U64)


class Gains:
    """Signed gains of the buckets as bit planes of the positive and the negative ones' sizes."""

    def __init__(self, gains: np.ndarray):
        self.n = len(gains)
        self.signed = [(sign, planes(np.maximum(sign * gains, 0)[None])[0]) for sign in (1, -1)]

    def weights(self, counts: np.ndarray) -> list[int]:
        """Exact sum of count x gain over the buckets for each row of counts:
        every plane of counts is ANDed with every gain plane, and the bits in
        common count 2 to the sum of the planes' places."""
        counted = planes(counts)
        totals = [0] * len(counts)
        for sign, gained in self.signed:
            common = np.stack([np.bitwise_count(counted & g).sum(2, dtype=np.int64) for g in gained], 2)
            for row, places in enumerate(common.tolist()):
                totals[row] += sign * sum(c << p + q for p, places_p in enumerate(places) for q, c in enumerate(places_p))
        return totals


def bucket_counts(docs: DataFrame, buckets: int, max_words: int) -> DataFrame:
    """``bucket`` and ``n``, the features of all texts in each bucket. A task
    adds its rows up in one array before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = Buckets(buckets, max_words), np.zeros(buckets, np.int64)
        for b in batches:
            for text in utf8(b.column(0)):
                total += np.bincount(of(text)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at])], ["bucket", "n"])

    return docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Each bucket's gain from the ``bucket``, ``n`` tables of the corpus and
    the target: 1000 times the log of the smoothed ratio of frequencies, floored.
    At most ``buckets`` rows of each come to the driver."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, into in ((corpus, s), (target, t)):
        for r in counts.collect():
            into[r["bucket"]] = r["n"]
    all_s, all_t = float(int(s.sum()) + buckets), float(int(t.sum()) + buckets)
    return np.array([math.floor(1000 * math.log((b + 1) * all_s / ((a + 1) * all_t))) for a, b in zip(s.astype(float).tolist(), t.astype(float).tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """A document's Gumbel noise in thousandths, floored, from the SHA-256 of ``seed:doc_id``."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(docs: DataFrame, gained: np.ndarray, max_words: int = MAX_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` (the exact sum of
    gains over the features) and ``score`` (with noise) of every row; a null id's noise is that of an empty one."""
    buckets = len(gained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, by = Buckets(buckets, max_words), Gains(gained)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), utf8(b.column(1))
            words, features, weights = [], [], []
            for at in range(0, len(texts), SIDE_BY_SIDE):
                found = [of(t) for t in texts[at:at + SIDE_BY_SIDE]]
                counts = np.stack([np.bincount(f, minlength=buckets) for _, f in found])
                # Rows of as many planes go together, so that one long text does not give all others its depth.
                depth = np.array([int(c).bit_length() for c in counts.max(1)])
                out = np.zeros(len(found), object)
                for d in np.unique(depth):
                    same = np.flatnonzero(depth == d)
                    out[same] = by.weights(counts[same])
                words += [n for n, _ in found]
                features += [len(f) for _, f in found]
                weights += out.tolist()
            scores = [w + noise(i, seed) for i, w in zip(ids, weights, strict=True)]
            columns = [b.column(0), *(pa.array(c, pa.int64()) for c in (words, features, weights, scores))]
            yield pa.record_batch(columns, ["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             buckets: int = BUCKETS, max_words: int = MAX_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and
    ``rank`` of every row of ``docs``: of the N rows of at least ``min_words``
    words, ``percent`` x N / 100 (floored) of the greatest score are drawn and ranked
    from 1, ties to the smaller ``doc_id`` (nulls last, then more features first); others have no rank.

    Null and empty texts have no features and weight 0. Repeated rows are documents each; an
    empty ``docs`` gives no rows, an empty ``target`` gains from smoothing alone. Only ``doc_id`` and ``text`` are
    read, so other columns cannot clash. Long texts count whole; weights are exact as long as they fit 64 bits.
    Words are lower-cased in A-Z only. Two passes over the texts; what is shuffled is at most ``buckets``
    counts a task and then the scores, ranked by range partitions."""
    gained = gains(bucket_counts(docs, buckets, max_words), bucket_counts(target, buckets, max_words), buckets)
    scored = score(docs, gained, max_words, seed).checkpoint()
    fit = scored.where(F.col("n_words") >= min_words)
    drawn = fit.count() * percent // 100
    order = scored.select("*", (F.col("n_words") < min_words).alias("short"), (-F.col("score")).alias("down"),
                          F.col("doc_id").isNull().alias("no_id"), (-F.col("n_features")).alias("fewer"),
                          F.monotonically_increasing_id().alias("tie"))
    # Rows that can be drawn come first, so one numbering of all rows ranks them and no join follows;
    # equal rows are told apart by their place in the checkpoint, so no range holds all copies of one.
    ranked = global_row_number(order, ["short", "down", "no_id", "doc_id", "fewer", "tie"], "place")
    rank = F.when(~F.col("short") & (F.col("place") <= drawn), F.col("place"))
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(spark, table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 is no DuckDB function, so a table of bytes' remainders and a fold over each distinct word's bytes give it.
OP11_SQL = f"""
WITH RECURSIVE bits(b, step, c) AS (
  SELECT b, 0, b FROM range(256) r(b)
  UNION ALL SELECT b, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE step = 8),
docs AS (SELECT doc_id, row_number() OVER () AS row, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM documents),
target AS (SELECT unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark),
words AS (SELECT w FROM docs UNION SELECT w FROM target),
folded AS (SELECT w, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(w) + 1), lambda i: ('0x' || substr(hex(encode(w)), 2 * i - 1, 2))::BIGINT)),
             lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])) AS c FROM words, crc_table),
bucket AS (SELECT w, xor(c, 4294967295) % {BUCKETS} AS b FROM folded),
s AS (SELECT b, count(*) AS n FROM docs JOIN bucket USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM target JOIN bucket USING (w) GROUP BY b),
gain AS (SELECT b, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + {BUCKETS})::DOUBLE
             / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + {BUCKETS})::DOUBLE)))::BIGINT AS g FROM s LEFT JOIN t USING (b)),
weighed AS (SELECT row, count(*) AS n, sum(g)::BIGINT AS weight FROM docs JOIN bucket USING (w) JOIN gain USING (b) GROUP BY row),
rows AS (SELECT doc_id, row_number() OVER () AS row FROM documents),
scored AS (SELECT row, doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
             (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
           FROM rows LEFT JOIN weighed USING (row)),
ranked AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM scored WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score,
       CASE WHEN r <= floor({PERCENT} * (SELECT count(*) FROM ranked) / 100) THEN r END::BIGINT AS rank
FROM scored LEFT JOIN ranked USING (row)
"""

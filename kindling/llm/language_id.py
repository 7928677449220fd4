"""Language identification by mixture inference over character n-grams."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.llm.common import mix, per_batch, table

#: Hashed n-grams of a language model. With MAX_LANGUAGES it bounds the model: what is collected and sent to tasks.
BUCKETS, MAX_LANGUAGES = 1 << 16, 256
SMOOTHING = 0.5
#: A further language must raise the log-likelihood by this many times half the log of the n-grams.
PENALTY = 4.0
UNKNOWN = "und"
_BLOCK = 1 << 20


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed letter trigrams of a whole text and their counts.

    Words are runs of letters, lower-cased, with a space before and after; no
    trigram spans two words, so long texts can be taken block by block."""
    found, at = [], 0
    while text and at < len(text):
        end = at + _BLOCK
        end = len(text) if end >= len(text) or (cut := text.find(" ", end)) < 0 else cut
        codes = np.frombuffer(text[at:end].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        at = end
        codes = np.concatenate(([32], np.where(_letters()[codes], codes, 32), [32])).astype(np.uint64)
        gap = codes == 32
        codes = codes[~(gap & np.concatenate(([False], gap[:-1])))]
        if len(codes) >= 3:
            three = codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:]
            found.append((mix(three[codes[1:-1] != 32]) & np.uint64(BUCKETS - 1)).astype(np.int64))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.unique(np.concatenate(found), return_counts=True)


def learn(training: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages of ``training`` (``text``, ``lang``) in alphabetical order,
    and the log-probability of each hashed trigram in each, from all its texts."""
    training = training.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    languages = sorted(r[0] for r in training.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    place = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(place), BUCKETS), np.int64)
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                bucket, n = grams(text)
                sums[place[lang], bucket] += n
        which, bucket = np.nonzero(sums)
        yield pa.record_batch([pa.array(x, pa.int64()) for x in (which, bucket, sums[which, bucket])], ["language", "bucket", "n"])

    sums = np.zeros((len(languages), BUCKETS))
    if languages:
        rows = training.select("text", "lang").mapInArrow(count, "language long, bucket long, n long")
        rows = rows.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
        sums[rows["language"], rows["bucket"]] = rows["n"]
    return languages, np.log((sums + SMOOTHING) / (sums.sum(1, keepdims=True) + SMOOTHING * BUCKETS)).T.astype(np.float32)


def em(p: np.ndarray, n: np.ndarray, steps: int = 60) -> tuple[np.ndarray, float]:
    """The mixture weights of most likelihood for trigrams of probability
    ``p`` (a row each, a column per language) found ``n`` times, and its log."""
    w, total = np.full(p.shape[1], 1 / p.shape[1]), n.sum()
    for _ in range(steps):
        mixed = p @ w
        new = w * ((n / mixed) @ p) / total
        done, w = np.abs(new - w).max() < 1e-4, new
        if done:
            break
    return w, float(n @ np.log(p @ w))


def infer(logs: np.ndarray, n: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray]:
    """The chosen languages of one document, greatest share first, and their shares.

    Languages join in the order of their share in the mixture of all, as long
    as each raises the log-likelihood by more than the penalty. The likelihood
    is concave in the shares: if its slope at the best single language shows
    that no mixture can gain the penalty, the mixtures need not be tried."""
    single = n @ logs
    best = int(np.argmax(single))
    total, cost = n.sum(), penalty * 0.5 * np.log(n.sum() + 1)
    p = np.exp((logs - logs.max(1, keepdims=True)).astype(np.float64))
    if p.shape[1] == 1 or (n @ (p / p[:, best, None])).max() - total <= cost:
        return np.array([best]), np.ones(1)
    order = [best, *(i for i in np.argsort(-em(p, n)[0], kind="stable") if i != best)]
    chosen, shares, reached = [best], np.ones(1), float(n @ np.log(p[:, best]))
    for k in range(2, len(order) + 1):
        w, gained = em(p[:, order[:k]], n)
        if gained - reached <= cost:
            break
        chosen, shares, reached = order[:k], w, gained
    by_share = np.lexsort((chosen, -shares))
    return np.array(chosen)[by_share], shares[by_share]


def identify(spark: SparkSession, docs: DataFrame, training: DataFrame, penalty: float = PENALTY) -> DataFrame:
    """``row`` (the columns of ``docs`` but the text), ``lang_pred``, ``score``
    (its share of the text) and ``mixture`` (all chosen languages and shares,
    ``en=0.812,fr=0.188``).

    Texts that are null or have no letter are ``und`` with score 0, as are all
    if ``training`` has no language. Equal shares go to the language first in
    the alphabet. Repeated rows are predicted alike; no rows give no rows."""
    languages, logs = learn(training)
    model = spark.sparkContext.broadcast(logs)  # at most BUCKETS x MAX_LANGUAGES

    @per_batch
    def predict(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in batch.column(0).to_pylist():
            bucket, n = grams(text) if languages else ((), ())
            if not len(bucket):
                out.append((UNKNOWN, 0.0, ""))
                continue
            chosen, shares = infer(model.value[bucket], n.astype(np.float64), penalty)
            out.append((languages[chosen[0]], min(1.0, float(shares[0])), ",".join(f"{languages[i]}={s:.3f}" for i, s in zip(chosen, shares, strict=True))))
        lang, score, mixture = zip(*out, strict=True)
        return pa.record_batch([batch.column(1), pa.array(lang), pa.array(score, pa.float64()), pa.array(mixture)], ["row", "lang_pred", "score", "mixture"])

    rows = docs.select("text", F.struct(*(c for c in docs.columns if c != "text")).alias("row"))
    return rows.mapInArrow(predict, f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, mixture string")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", held_out)
    training = docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()).select("text", "lang")
    found = identify(spark, docs.select("doc_id", "text", "held_out"), training)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score", "mixture")


def accuracy(predicted: list[tuple[str, str]]) -> float:
    return Counter(a == b for a, b in predicted)[True] / max(1, len(predicted))

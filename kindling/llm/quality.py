"""Quality rules: statistics of texts and a decision list learned from labelled ones."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.llm.common import BY_SPACE, per_batch, table, windows, word_hashes, written

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars", "n_upper", "n_digits", "n_ends")
#: What rules may test: a share or mean of the counts.
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"), "chars_per_word": ("word_chars", "n_words"), "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"), "upper_share": ("n_upper", "n_chars"), "digit_share": ("n_digits", "n_chars"),
    "ends_per_word": ("n_ends", "n_words"), "words": ("n_words", None),
}
#: At most about this many labelled rows are used to grow and prune the list.
FIT_ROWS = 20_000
_SYMBOLS = b"#*$%&|<>"
_KIND = np.zeros(256, np.uint8)
for _chars, _bit in ((_SYMBOLS, 1), (bytes(range(65, 91)), 2), (bytes(range(48, 58)), 4), (b".!?", 8)):
    _KIND[list(_chars)] += _bit
_HAS_WORD = re.compile(rb"[^\x20\t-\r]")


def text_counts(text: bytes | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one whole text."""
    if not text:
        return (0,) * len(COUNTS)
    data = np.frombuffer(text, np.uint8)
    words = word_hashes(text)
    word_bytes = ~BY_SPACE[data] & ((data & 0xC0) != 0x80)  # the first bytes of words' code points
    kinds = np.bincount(_KIND[data], minlength=16)
    of = lambda bit: int(kinds[[k for k in range(16) if k & bit]].sum())
    lines = [x for x in text.split(b"\n") if _HAS_WORD.search(x)]
    repeated = 0
    if len(words) >= 4:
        triples, places, found = np.unique(windows(words, 3), return_inverse=True, return_counts=True)
        if len(triples) < len(places):
            twice = found[places] > 1
            covered = np.zeros(len(words), bool)
            for i in range(3):
                covered[i:len(words) - 2 + i] |= twice
            repeated = int(covered.sum())
    chars = int(word_bytes.sum())
    return (len(words), chars, of(1), len(lines) - len(set(lines)), repeated, len(lines), chars, of(2), of(4), of(8))


@per_batch
def _count(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = np.array([text_counts(x) for x in batch.column(0).cast(pa.binary()).to_pylist()], np.int64)
    return pa.record_batch([batch.column(1), *(pa.array(c) for c in rows.T)], ["row", *COUNTS])


def with_counts(docs: DataFrame) -> DataFrame:
    """``row`` (a struct of all columns of ``docs`` but the text) and the counts of the text."""
    keep = [c for c in docs.columns if c != "text"]
    rows = docs.select("text", F.struct(*keep).alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_count, f"row {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def feature(name: str) -> Column:
    top, bottom = FEATURES[name]
    return F.col(top).cast("double") if bottom is None else F.col(top) / F.greatest(F.col(bottom), F.lit(1))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


Rule = tuple[tuple[str, str, float], ...]


def _covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    hit = np.ones(len(next(iter(x.values()))), bool)
    for name, op, cut in rule:
        hit &= x[name] > cut if op == ">" else x[name] <= cut
    return hit


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """A conjunction of thresholds, each the one of most information gain, until it covers bad rows alone."""
    rule: Rule = ()
    hit = np.ones(len(bad), bool)
    while len(rule) < 4:
        p, n = int(bad[hit].sum()), int((~bad[hit]).sum())
        if not p or not n:
            break
        best = (1e-9, None)
        for name, values in x.items():
            v, b = values[hit], bad[hit]
            order = np.argsort(v, kind="stable")
            v, b = v[order], b[order]
            ends = np.flatnonzero(np.diff(v) > 0)
            if not len(ends):
                continue
            low_p, low_n = np.cumsum(b)[ends], np.cumsum(~b)[ends]
            for op, tp, tn in (("<=", low_p, low_n), (">", p - low_p, n - low_n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(tp > 0, tp * (np.log2(tp / (tp + tn)) - np.log2(p / (p + n))), 0)
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (float(gain[at]), (name, op, float((v[ends[at]] + v[ends[at] + 1]) / 2)))
        if best[1] is None:
            break
        rule += (best[1],)
        hit &= _covers((best[1],), x)
    return rule


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The shortest beginning of the rule that does best on rows it wasn't grown on."""
    def worth(r: Rule) -> float:
        hit = _covers(r, x)
        p, n = int(bad[hit].sum()), int((~bad[hit]).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:i] for i in range(1, len(rule) + 1)), key=worth, default=())


def learn_list(x: dict[str, np.ndarray], bad: np.ndarray, min_precision: float = 0.9, max_rules: int = 16, seed: int = 7) -> list[Rule]:
    """Sequential covering: rules for bad rows, each learned on what those before it leave."""
    rules: list[Rule] = []
    rest = np.ones(len(bad), bool)
    rng = np.random.default_rng(seed)
    while len(rules) < max_rules and bad[rest].sum() >= 3:
        at = np.flatnonzero(rest)
        grown = rng.random(len(at)) < 2 / 3
        part = lambda rows: ({k: v[rows] for k, v in x.items()}, bad[rows])  # noqa: E731, B023
        rule = _prune(_grow(*part(at[grown])), *part(at[~grown]))
        hit = rest & _covers(rule, x) if rule else np.zeros(len(bad), bool)
        if not bad[hit].any() or bad[hit].mean() < min_precision:
            break
        rules.append(rule)
        rest &= ~hit
    return rules


def _condition(rule: Rule) -> Column:
    out = F.lit(True)
    for name, op, cut in rule:
        out = out & (feature(name) > cut if op == ">" else feature(name) <= cut)
    return out


def as_expression(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional: the number of the first rule that holds, else null."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules))):
        out = F.when(_condition(rule), i).otherwise(out)
    return out


def fit(counted: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, min_precision: float = 0.9) -> list[Rule]:
    """A decision list for ``quality`` = 0 out of counted documents.

    Rules are grown and pruned on about ``fit_rows`` labelled documents, chosen
    by a hash of their id; then the ordered list is measured on all labelled
    documents, and a rule whose precision there is under ``min_precision`` is left
    out, again and again until none is. Labels that are null or contradict each other don't
    count; of rows that share an id, the one of least counts is fitted; without bad labels the list is empty and rejects nothing."""
    labels = labels.groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    labels = labels.where((F.col("low") == F.col("high")) & F.col("doc_id").isNotNull()).select("doc_id", (F.col("low") == 0).alias("bad"))
    counted = counted.select(F.col("row.doc_id").alias("id"), *COUNTS).where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    labelled = counted.join(labels, F.col("id") == F.col("doc_id")).select("id", "bad", *COUNTS)
    n = labels.count()
    share = min(1.0, fit_rows / max(n, 1))
    sample = labelled.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else labelled
    # Of rows that share an id one is fitted, so the rows that come to the driver are bounded as their ids are.
    sample = sample.groupBy("id").agg(F.min(F.struct("bad", *COUNTS)).alias("least")).select("id", "least.*")
    sample = sample.select("id", "bad", *(feature(f).alias(f) for f in FEATURES)).toPandas().sort_values("id", kind="stable")
    x = {f: sample[f].to_numpy(float) for f in FEATURES}
    rules = learn_list(x, sample["bad"].to_numpy(bool), min_precision)
    while rules:
        seen = labelled.groupBy(as_expression(rules).alias("rule")).agg(F.avg(F.col("bad").cast("int")).alias("precision"))
        seen = {r["rule"]: r["precision"] for r in seen.collect()}
        sound = [r for i, r in enumerate(rules) if seen.get(i, 0.0) >= min_precision]
        if len(sound) == len(rules):
            break
        rules = sound
    return rules


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """``row`` (the columns of ``docs`` but the text), the counts, ``base_failed``,
    ``rule`` (number of the learned rule that rejects, else null) and ``kept``.

    A null text has no words. Repeated rows are judged alike, as are rows with a
    null ``doc_id`` (which never are labelled). Empty tables give no rows."""
    counted = written(spark, with_counts(docs), "quality-counts")
    rules = fit(counted, labels, **how)
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    out = counted.withColumn("base_failed", failed).withColumn("rule", as_expression(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality_filter(spark: SparkSession, docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that the base checks and the learned list keep."""
    judged = judge(spark, docs.select("text", F.struct(*docs.columns).alias("doc"), "doc_id"), labels, **how)
    return judged.where("kept").select("row.doc.*")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality")
    return judge(spark, docs, labels).select("row.doc_id", *COUNTS[:5], "base_failed", "kept", "rule")

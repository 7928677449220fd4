"""Sampling and train/test splits (SET5-SET8).

Reproducible variants hash the key (md5 of its text form), so a row's side
never depends on partitioning or on a random generator.

``global_row_number`` numbers rows in a total order without a single-task
window: rows are range-partitioned and sorted per partition, the per-partition
counts (one number per partition) give each partition its offset. The
partitioned rows are checkpointed first so their partition ids are stable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindling.operators.sizing import DEFAULT_BROADCAST_ROWS, broadcast_if_small, small_frame


def hash_bucket(key, buckets: int = 100) -> Column:
    """First 8 hex digits of md5(key as text), modulo ``buckets``."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def sample_by_hash(df: DataFrame, key: str, percent: int) -> DataFrame:
    """SET5: the rows whose key hashes below ``percent`` of 100 buckets."""
    return df.filter(hash_bucket(key, 100) < percent)


def sample(df: DataFrame, fraction: float, seed: int = 42, with_replacement: bool = False) -> DataFrame:
    """SET5 random form (``rdd.sample``)."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed)


def hash_split(df: DataFrame, key: str, train_percent: int = 50) -> tuple[DataFrame, DataFrame]:
    """SET6 reproducible form: (train, test) by hash of the key."""
    b = hash_bucket(key, 100)
    return df.filter(b < train_percent), df.filter(b >= train_percent)


def random_split(df: DataFrame, weights=(0.5, 0.5), seed: int = 42):
    """SET6 as in the reference (``randomSplit``), with a fixed seed."""
    return df.randomSplit(list(weights), seed)


def global_row_number(df: DataFrame, order: list[str], out: str = "row_number",
                      num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row in the total order ``order`` (ties: give a total order)."""
    return _numbered(df, order, out, num_partitions)[0]


def _numbered(df: DataFrame, order: list[str], out: str, num_partitions: int | None = None):
    """(numbered rows, total row count)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint()
    )
    stats = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m0"))
    # One row per partition: a bounded, tiny table of offsets.
    rows = sorted(stats.collect(), key=lambda r: r["_pid"])
    offs, acc = [], 0
    for r in rows:
        offs.append((int(r["_pid"]), acc, int(r["_m0"])))
        acc += int(r["_c"])
    off_df = small_frame(spark, offs or [(0, 0, 0)], "_pid INT, _off BIGINT, _m0 BIGINT")
    numbered = ranged.join(F.broadcast(off_df), "_pid").select(
        *df.columns, (F.col("_off") + F.col("_mid") - F.col("_m0") + 1).cast("bigint").alias(out)
    )
    return numbered, acc


def kfold(df: DataFrame, order: list[str], k: int = 5, out: str = "fold") -> DataFrame:
    """SET8: ``k`` consecutive blocks of the total order, sizes as SQL ``ntile(k)``
    (the first ``n mod k`` folds hold one row more)."""
    numbered, n = _numbered(df, order, "_g")
    q, r = divmod(n, k)
    g = F.col("_g")
    big = r * (q + 1)
    fold = F.when(g <= big, F.floor((g - 1) / (q + 1)) + 1).otherwise(
        F.floor((g - big - 1) / max(q, 1)) + r + 1)
    return numbered.select(*df.columns, fold.cast("int").alias(out))


def all_but_n(df: DataFrame, user: str, order: list[str], start: int, stop: int, max_test: int = 0,
              out: str = "split", broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """SET7: walk rows in the total order ``order``; a row whose running number
    within its user lies in ``[start, stop]`` goes to ``test`` while fewer than
    ``max_test`` test rows were taken (``max_test <= 0``: no limit); all other
    rows go to ``base``. ``order`` must be a total order.

    Rows are numbered once in the order ``(user, order)``: there a user's rows
    are contiguous, so the running number is the position minus the position
    of the user's first row (a per-user ``min``, partial before its shuffle; a
    hot user is spread over several range partitions). Only when the cap can
    bind are the candidates numbered again in ``order``.
    """
    h, total = _numbered(df, [user, *order], "_h")
    first = h.groupBy(user).agg(F.min("_h").alias("_h0"))
    ranked = h.join(broadcast_if_small(first, broadcast_rows), user).withColumn(
        "_rn", F.col("_h") - F.col("_h0") + 1)
    cand = ranked.filter((F.col("_rn") >= start) & (F.col("_rn") <= stop))
    if max_test and 0 < max_test < total:
        cg = global_row_number(cand.select(*df.columns, "_h"), order, "_cg")
        taken = cg.filter(F.col("_cg") <= max_test).select("_h")
        flag = ranked.join(taken.withColumn("_t", F.lit(True)), "_h", "left")
        is_test = F.col("_t").isNotNull()
    else:
        flag, is_test = ranked, (F.col("_rn") >= start) & (F.col("_rn") <= stop)
    return flag.select(*df.columns, F.when(is_test, F.lit("test")).otherwise(F.lit("base")).alias(out))

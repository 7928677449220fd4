"""Dimension lookups and key joins (JOIN2-JOIN5, JOIN9, JOIN10).

Only a top-k side is hinted for broadcast: it is bounded by ``k``. Any other
join is left to Spark, which broadcasts a side it measures as small while the
query runs, and to the small *fact* side, which prunes a large dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.operators.sizing import pin_small

#: A key with fewer rows than this is never taken out of an outer join.
HOT_ROWS = 1_000_000


def dedup_dimension(dim: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key (the reference's Map keeps one value per id).

    The greatest value wins, so the result does not depend on file order.
    """
    return dim.groupBy(key).agg(F.max(value).alias(value))


def lookup_names(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str | None = None,
    name: str = "name",
    on_missing: str = "null",
    df_max_rows: int | None = None,
) -> DataFrame:
    """JOIN2: add ``name`` from ``dim`` to every row of ``df`` by key.

    ``on_missing``: ``"null"`` keeps rows without a match (name null),
    ``"drop"`` removes them, ``"error"`` raises at run time as the reference's
    ``Map.apply`` does. ``dim`` must hold one row per key (with ``df_max_rows``
    the greatest name of a repeated key is taken).

    Plans: if ``df`` is known to be tiny (``df_max_rows``, e.g. a top-k), the
    dimension is streamed once against a broadcast copy of ``df``'s keys and
    never shuffled; else the join is left to AQE.
    """
    dim_key = dim_key or key
    d = dim.select(F.col(dim_key).alias(key), F.col(name))
    how = "inner" if on_missing == "drop" else "left"

    if df_max_rows is not None:
        df = pin_small(df)
        keys = df.select(key).distinct()
        # One row a key, so at most df_max_rows hits however often the dimension repeats an id.
        hits = dedup_dimension(d.join(F.broadcast(keys), key, "inner"), key, name)
        out = df.join(F.broadcast(hits), key, how)
    else:
        out = df.join(d, key, how)

    if on_missing == "error":
        out = out.withColumn(
            name,
            F.when(
                F.col(name).isNull(),
                F.raise_error(F.concat(F.lit("no dimension row for key "), F.col(key).cast("string"))),
            ).otherwise(F.col(name)),
        )
    return out


def anti_join(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """JOIN5 ``subtractByKey``: rows of ``df`` whose key is absent from ``other``."""
    other_key = other_key or key
    o = other.select(F.col(other_key).alias(key)).distinct()
    return df.join(o, key, "left_anti")


def hot_keys(side: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The keys of more rows than both ``hot_rows`` and an even share of a shuffle
    task, so fewer than shuffle partitions; None without any. Only the key is read,
    and counted in each task before the shuffle."""
    counts = side.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    counts = counts.checkpoint()
    if counts.isEmpty():
        return None
    share = side.count() // int(side.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = counts.where(F.col("_n") > share).select(key)
    return None if hot.isEmpty() else hot


def outer_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", hot_rows: int = HOT_ROWS) -> DataFrame:
    """JOIN9: ``leftOuterJoin`` / ``rightOuterJoin`` / full outer on one key.

    Columns as ``left.join(right, key, how)``: the key, then the other left
    columns, then the other right columns. A null key never matches.

    Skew: Spark splits a hot key's partition only on a side whose rows may be
    copied across tasks - either side of an inner join, but only the preserved
    side of an outer join, and neither of a full one. Where no key is measured
    as hot on such a side (:func:`hot_keys`), this is the plain join. Otherwise
    the hot keys' rows leave the outer join for an inner one, in which the hot
    side is dealt into parts and the other side's rows meet each part. The deal
    goes by row numbers, since rows may be equal, and is written before the
    shuffle, so a task that runs again finds the same deal.
    """
    if how not in ("left", "right", "full", "inner"):
        raise ValueError(how)
    hot_left = hot_keys(left, key, hot_rows) if how in ("right", "full") else None
    hot_right = hot_keys(right, key, hot_rows) if how in ("left", "full") else None
    if hot_left is not None and hot_right is not None:
        hot_right = hot_right.join(F.broadcast(hot_left), key, "left_anti")
    hots = [h for h in (hot_left, hot_right) if h is not None]
    if not hots:
        return left.join(right, key, how)
    lcols = [c for c in left.columns if c != key]
    rcols = [c for c in right.columns if c != key]
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rare_left, rare_right = left, right
    for h in hots:
        rare_left, rare_right = (r.join(F.broadcast(h), key, "left_anti") for r in (rare_left, rare_right))
    out = rare_left.join(rare_right, key, how).select(key, *lcols, *rcols)
    for hot, side, other, other_cols in ((hot_left, left, right, rcols), (hot_right, right, left, lcols)):
        if hot is None:
            continue
        mine, theirs = (d.join(F.broadcast(hot), key, "left_semi") for d in (side, other))
        mine = mine.withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int")).checkpoint()
        copies = theirs.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        out = out.unionByName(mine.join(copies, [key, "_part"]).select(key, *lcols, *rcols))
        if how == "full":
            alone = mine.join(F.broadcast(theirs.select(key).distinct()), key, "left_anti").drop("_part")
            out = out.unionByName(alone.withColumns({c: F.lit(None).cast(other.schema[c].dataType) for c in other_cols}))
    return out


def cogroup_sizes(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """JOIN10 ``cogroup``: per key, the number of left and right rows.

    The grouped lists are reduced to their sizes on each side *before* the
    join (partial aggregation), so no key's list is ever materialised.
    """
    l = left.groupBy(key).agg(F.count(F.lit(1)).alias("left_rows"))
    r = right.groupBy(key).agg(F.count(F.lit(1)).alias("right_rows"))
    return l.join(r, key, "full").select(
        key,
        F.coalesce("left_rows", F.lit(0)).cast("bigint").alias("left_rows"),
        F.coalesce("right_rows", F.lit(0)).cast("bigint").alias("right_rows"),
    )


def cogroup_rows(left: DataFrame, right: DataFrame, key: str, left_cols: list[str], right_cols: list[str]) -> DataFrame:
    """JOIN10 ``cogroup`` with its groups: every row of both sides as ``key``, ``side``
    (``left`` or ``right``) and a struct of its columns, ``left`` or ``right``.

    A key's groups follow each other in the order of the key, left rows first, as
    runs of rows instead of two lists, so a group may be longer than one task holds: ranges are
    cut by key, side and the rows' values, and a hot key's run goes on in the next partition.
    A null key is a group like any other.
    """
    fields = {n: F.struct(*c) for n, c in (("left", left_cols), ("right", right_cols))}

    def tagged(df: DataFrame, side: str) -> DataFrame:
        return df.select(key, F.lit(side).alias("side"), fields[side].alias(side))

    rows = tagged(left, "left").unionByName(tagged(right, "right"), allowMissingColumns=True)
    order = [key, "side", "left", "right"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def point_lookup(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """JOIN4 ``lookup``: rows of ``df`` for a key set, one join, one job. Whether
    the keys are broadcast is decided by their measured size, not by a hint."""
    return df.join(keys.select(key).distinct(), key, "left_semi")

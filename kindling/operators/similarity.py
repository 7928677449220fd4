"""Item-item collaborative filtering (REC4-REC6, JOIN1, FLT5, AGG9, FN9).

``pair_stats`` computes, for every item pair ``i < j`` rated by a common user,
``sxx = sum(r_i^2)``, ``syy = sum(r_j^2)``, ``sxy = sum(r_i r_j)`` and ``n``
over the common users. What is shuffled are the users' ratings, packed, not a row
for every pair (see :mod:`kindling.operators.baskets`); the pairs are made and
added up in the task that owns them.

Skew: the work for a user grows with the square of that user's item count. It is
dealt over the groups of items, and a group makes at most about ``heavy_rows^2 / 16``
pairs at a time. Every pair is still produced exactly once: results stay exact and whole.

``similar_items`` answers the one-item question without the all-pairs table:
it joins the item's raters with the other ratings of those users, which is
linear in the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.functions.scalar import safe_div
from kindling.operators.baskets import pair_sums
from kindling.operators.lookup import lookup_names
from kindling.operators.recommend import dense_ids
from kindling.operators.sizing import DEFAULT_BROADCAST_ROWS, broadcast_if_small

DEFAULT_HEAVY_ROWS = 5_000
WHOLE = ("byte", "short", "integer", "long")


def pair_stats(
    r: DataFrame,
    user: str = "user",
    item: str = "item",
    rating: str = "rating",
    heavy_rows: int = DEFAULT_HEAVY_ROWS,
    min_n: int = 1,
) -> DataFrame:
    """(item_i, item_j, sxx, syy, sxy, n) for all pairs with item_i < item_j that at least ``min_n`` users rated both.

    ``r`` must hold one row per (user, item). Ids that are no whole numbers get dense ones in their order.
    """
    base = r.select(F.col(user).alias("user"), F.col(item).alias("item"), F.col(rating).cast("double").alias("rating"))
    base, kinds, books = base.where("user IS NOT NULL AND item IS NOT NULL"), dict(base.dtypes), {}
    odd = [c for c in ("user", "item") if base.schema[c].dataType.typeName() not in WHOLE]
    base = base.checkpoint() if odd else base
    for c in odd:
        books[c] = dense_ids(base, c)
        base = base.join(books[c].withColumnRenamed("id", c), c).drop(c).withColumnRenamed("dense", c)
    base = base.select(F.col("user").cast("bigint"), F.col("item").cast("bigint"), "rating")
    st = pair_sums(base, min_n, max(heavy_rows**2 // 16, 1))
    for c in ("item_i", "item_j"):
        if "item" in books:
            st = st.join(books["item"].select(F.col("dense").cast("bigint").alias(c), "id"), c).drop(c).withColumnRenamed("id", c)
        else:
            st = st.withColumn(c, F.col(c).cast(kinds["item"]))
    return st.select("item_i", "item_j", "sxx", "syy", "sxy", "n")


def cosine(sxx="sxx", syy="syy", sxy="sxy"):
    """AGG9 score with the FN9 guard: 0 when a norm is 0."""
    den = F.sqrt(F.col(sxx)) * F.sqrt(F.col(syy))
    return safe_div(F.col(sxy), den, 0.0)


def item_similarity(r: DataFrame, user="user", item="item", rating="rating", min_n: int = 1,
                    heavy_rows: int = DEFAULT_HEAVY_ROWS) -> DataFrame:
    """REC4: (item_i, item_j, score, n) for co-rated pairs with ``n >= min_n``."""
    st = pair_stats(r, user, item, rating, heavy_rows, min_n)
    return st.select("item_i", "item_j", cosine().alias("score"), "n")


def prune_ratings(r: DataFrame, min_n: int, user: str = "user", item: str = "item", rounds: int = 2) -> DataFrame:
    """The rows of ``r`` that can be part of a pair with more than ``min_n`` common users.

    A pair's count cannot exceed either item's raters, so an item with
    ``min_n`` raters or fewer is in no such pair; a user who is left with one item makes none. Dropping users takes raters
    from items, so it is done ``rounds`` times, or until
    nothing goes. No kept pair loses a common user that counts for it: the result is exact."""

    def without(r: DataFrame, gone: DataFrame, key: str) -> DataFrame:
        return r.join(gone, key, "left_anti")

    r = r.where(F.col(user).isNotNull() & F.col(item).isNotNull())
    for _ in range(rounds):
        # What goes is looked for, not what stays: often little or nothing goes, and then the ratings need no join.
        rare = r.groupBy(item).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") <= min_n).select(item).checkpoint()
        some = not rare.isEmpty()
        if some:
            r = without(r, rare, item).checkpoint()
        alone = r.groupBy(user).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") < 2).select(user).checkpoint()
        if not alone.isEmpty():
            r, some = without(r, alone, user).checkpoint(), True
        if not some:
            break
    return r


def top_pairs(r: DataFrame, min_score: float, min_n: int, k: int = 50, names: DataFrame | None = None, name_key: str | None = None,
              name_col: str = "name", user="user", item="item", rating="rating", heavy_rows: int = DEFAULT_HEAVY_ROWS,
              digits: int = 4) -> DataFrame:
    """REC6: the ``k`` most similar pairs with a score above ``min_score`` and more than
    ``min_n`` common users, by score (rounded half up), count and ids, with both items' names.

    What cannot reach ``min_n`` is dropped before pairs are made."""
    from kindling.functions.rounding import round_half_up

    st = pair_stats(prune_ratings(r, min_n, user, item), user, item, rating, heavy_rows, min_n + 1)
    scored = st.select("item_i", "item_j", cosine().alias("_s"), "n").where(F.col("_s") > min_score)
    scored = scored.select("item_i", "item_j", round_half_up("_s", digits).alias("score"), "n")
    top = scored.orderBy(F.desc("score"), F.desc("n"), "item_i", "item_j").limit(k)
    for side in ("i", "j") if names is not None else ():
        found = names.select(F.col(name_key).alias("_k"), F.col(name_col).alias(f"name_{side}"))
        top = lookup_names(top.withColumn("_k", F.col(f"item_{side}")), found, "_k", "_k", f"name_{side}", df_max_rows=k).drop("_k")
    return top


def similar_items(
    r: DataFrame,
    target,
    min_score: float,
    min_n: int,
    k: int = 10,
    user="user",
    item="item",
    rating="rating",
    names: DataFrame | None = None,
    name_key: str | None = None,
    name_col: str = "name",
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """REC5: the ``k`` items most similar to ``target`` (score > min_score, n > min_n).

    Same rows as filtering the all-pairs table on ``item_i == target or
    item_j == target`` (the score is symmetric), at linear cost.
    """
    base = r.select(F.col(user).alias("_u"), F.col(item).alias("_i"), F.col(rating).cast("double").alias("_r"))
    raters = base.filter(F.col("_i") == F.lit(target)).select("_u", F.col("_r").alias("_rx"))
    others = base.filter(F.col("_i") != F.lit(target))
    joined = others.join(broadcast_if_small(raters, broadcast_rows), "_u")
    st = joined.groupBy(F.col("_i").alias("other")).agg(
        F.sum(F.col("_rx") * F.col("_rx")).alias("sxx"),
        F.sum(F.col("_r") * F.col("_r")).alias("syy"),
        F.sum(F.col("_rx") * F.col("_r")).alias("sxy"),
        F.count(F.lit(1)).alias("n"),
    )
    scored = st.select("other", cosine().alias("score"), "n").filter(
        (F.col("score") > F.lit(min_score)) & (F.col("n") > F.lit(min_n))
    )
    top = scored.orderBy(F.desc("score"), F.desc("n"), F.asc("other")).limit(k)
    if names is not None:
        top = lookup_names(top, names, "other", name_key, name_col, df_max_rows=k)
    return top


def hash_partition(df: DataFrame, num_partitions: int, *cols: str) -> DataFrame:
    """PT1: hash-partition ``df`` into ``num_partitions`` by ``cols``."""
    return df.repartition(num_partitions, *cols)

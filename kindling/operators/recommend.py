"""Matrix-factorisation recommendations (REC1-REC3)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.operators.lookup import lookup_names
from kindling.operators.splits import global_row_number
from kindling.operators.streamed_als import fit_streamed, streamed_blocks


INT_MAX = 2**31 - 1
#: Blocks that are used if there are cores for them, and ratings that a block is meant to hold at most.
MIN_BLOCKS, BLOCK_RATINGS = 4, 64_000_000
#: Ratings of a block that ``ALS`` may hold in a task's memory (some 70 bytes each while they are laid out); beyond, they are streamed.
HELD_RATINGS = 4_000_000


@dataclass
class Recommender:
    """A fitted ALS model and, where ids are no 32-bit integers, the dictionaries of dense ids it was fitted on (``id``, ``dense``)."""

    model: ALSModel
    users: DataFrame | None
    items: DataFrame | None


def _fits(r: DataFrame, *cols: str) -> list[bool]:
    """Which columns are integers that ALS can take as they are (one aggregate)."""
    whole = [r.schema[c].dataType.typeName() in ("byte", "short", "integer", "long") for c in cols]
    asked = [c for c, w in zip(cols, whole, strict=True) if w]
    ends = r.agg(*(f(c).alias(f"{n}_{c}") for c in asked for n, f in (("min", F.min), ("max", F.max)))).first() if asked else None
    return [w and (ends[f"min_{c}"] is None or (ends[f"min_{c}"] >= -INT_MAX and ends[f"max_{c}"] <= INT_MAX)) for c, w in zip(cols, whole, strict=True)]


def dense_ids(r: DataFrame, col: str) -> DataFrame:
    """(id, dense): the distinct non-null values of a column, numbered from 0 in their order; the numbering is range-partitioned."""
    ids = r.select(F.col(col).alias("id")).where(F.col("id").isNotNull()).distinct()
    numbered = global_row_number(ids, ["id"], "dense").withColumn("dense", F.col("dense") - 1).checkpoint()
    if (numbered.agg(F.max("dense")).first()[0] or 0) > INT_MAX:
        raise ValueError(f"more than 2^31 distinct values of {col}")
    return numbered.withColumn("dense", F.col("dense").cast("int"))


def als_blocks(ratings: int, users: int, items: int, cores: int) -> int:
    """How many blocks ALS gets. In every iteration each user's and item's factors are sent to all blocks that hold a
    rating of it, so more blocks keep more cores busy and send more; beyond ``MIN_BLOCKS`` there are only as many as send
    one vector for four ratings, or as hold the ratings."""
    wanted = max(MIN_BLOCKS, -(-ratings // BLOCK_RATINGS), ratings // (4 * max(users + items, 1)))
    return max(min(wanted, cores), 1)


def fit_als(r: DataFrame, user="user", item="item", rating="rating", rank: int = 8, max_iter: int = 20,
            reg: float = 0.01, seed: int = 42, num_blocks: int | None = None) -> Recommender:
    """REC1: explicit ALS (rank 8, 20 iterations, lambda 0.01).

    ALS takes 32-bit integer ids. Ids that are larger or no integers get dense ones, by a dictionary that is joined to
    the ratings here and to the recommendations in :func:`recommend`.
    Users and items are split into ``num_blocks`` blocks each (default: :func:`als_blocks`, at most the
    cluster's parallelism). Spark's ``ALS`` holds a block's ratings in memory; where a block would have more than
    ``HELD_RATINGS``, :func:`fit_streamed` fits the same model over blocks that stream them.
    """
    data, books = r.select(F.col(user).alias("user"), F.col(item).alias("item"), F.col(rating).cast("float").alias("rating")), {}
    whole = F.col("user").isNotNull() & F.col("item").isNotNull()
    sizes = data.agg(F.count_if(whole), F.approx_count_distinct("user"), F.approx_count_distinct("item")).first()
    blocks = num_blocks or als_blocks(*sizes, r.sparkSession.sparkContext.defaultParallelism)
    for col, fits in zip(("user", "item"), _fits(data, "user", "item"), strict=True):
        books[col] = None if fits else dense_ids(data, col)
        if not fits:
            data = data.join(books[col].withColumnRenamed("id", col), col).drop(col).withColumnRenamed("dense", col)
    data = data.select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"), "rating")
    if sizes[0] > HELD_RATINGS * blocks:
        data = data if all(b is None for b in books.values()) else data.checkpoint()  # laid out twice, joined once
        blocks = streamed_blocks(*sizes, rank, blocks)
        return Recommender(fit_streamed(data, rank, max_iter, reg, seed, sizes[0], blocks), books["user"], books["item"])
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, seed=seed, userCol="user", itemCol="item",
              ratingCol="rating", coldStartStrategy="drop", implicitPrefs=False,
              numUserBlocks=blocks, numItemBlocks=blocks)
    return Recommender(als.fit(data), books["user"], books["item"])


def recommend(fitted: Recommender, users: DataFrame, k: int = 10) -> DataFrame:
    """REC2: top-``k`` items for each user in ``users`` (its first column) as
    flat rows ``(user, item, score, rank)``; already-rated items are included,
    as in the reference.

    Scoring a user costs one pass over the item factors, so the work is
    (users asked for) x (items). The caller passes the users it wants
    (the reference asks for one); there is deliberately no all-users mode,
    which would score every user against every item.
    """
    asked = users.select(F.col(users.columns[0]).alias("user"))
    if fitted.users is not None:
        asked = asked.join(fitted.users.withColumnRenamed("id", "user"), "user").select(F.col("dense").alias("user"))
    recs = fitted.model.recommendForUserSubset(asked.select(F.col("user").cast("int").alias("user")), k)
    flat = recs.select("user", F.posexplode("recommendations").alias("pos", "rec")).select(
        "user", F.col("rec.item").alias("item"), F.col("rec.rating").cast("double").alias("score"),
        (F.col("pos") + 1).alias("rank"),
    )
    for col, book in (("user", fitted.users), ("item", fitted.items)):
        if book is not None:
            flat = flat.join(book.withColumnRenamed("dense", col), col).drop(col).withColumnRenamed("id", col)
    return flat.select("user", "item", "score", "rank")


def user_ratings(r: DataFrame, user_id, names: DataFrame, name_key: str, name_col: str,
                 user="user", item="item") -> DataFrame:
    """REC3 / FLT7: one user's ratings with item names."""
    mine = r.filter(F.col(user) == F.lit(user_id))
    return lookup_names(mine, names, item, name_key, name_col)

"""Removal of lines that an earlier document already holds, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindling.llm.common import SPACES, ascii_lower, table, written

#: A key in many documents is dealt out over this many range keys.
SALTS = 256


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_bitmaps(spark: SparkSession, docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """Which lines of each text to drop, as one compressed bitmap per document.

    A line's key is the line stripped of spaces and controls 0x09-0x0D at both
    ends, A-Z lower-cased. A key of at least ``min_chars`` code points that is
    found in two documents or more stays in the smallest ``doc_id`` holding it
    and goes from all others. Rows: ``doc_id``, ``text_hash``, ``runs``; the
    bitmap is run-length encoded: each run is the place of the first of
    ``length`` dropped lines in a row, all lines outside runs are kept.
    Documents that lose nothing have no row.

    Lines travel as (128-bit hash, document, position), never as text. They are
    range-partitioned by hash and a salt of the document, sorted by document
    and position, and read in that order: rows after the first document of
    their range key go. So a key held by a third of all documents is spread
    over ``SALTS`` range keys, and only the first document of each meets the
    others of its hash, in a second pass of at most ``SALTS`` documents a key.

    Null texts and empty texts are one empty line, which is too short to be a
    key. Rows with a null ``doc_id`` count as one document after all others.
    Rows that repeat a ``doc_id`` are that document: none drops the other's
    lines; their texts may differ, so a bitmap belongs to (doc_id, text_hash).
    Empty tables give no rows; other columns are not read.
    """
    lines = (
        docs.select("doc_id", _text_hash(F.col("text")).alias("text_hash"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
        .withColumn("key", ascii_lower(F.btrim("line", F.lit(SPACES))))
        .where(F.length("key") >= min_chars)
        .select(F.md5(F.encode("key", "UTF-8")).alias("hash"), "doc_id", "text_hash", "pos")
    )
    lines = written(spark, lines.withColumn("hash", F.unhex("hash")), "line-hashes")

    places = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    places = places.repartitionByRange("hash", "salt")
    stream = Window.partitionBy("hash", "salt").orderBy(F.col("doc_id").asc_nulls_last(), "text_hash", "pos")
    places = places.withColumn("first", F.first(F.struct("doc_id")).over(stream))
    later = places.where(~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))).select("doc_id", "text_hash", "pos")

    # The first documents of the range keys of one hash: at most SALTS, each with the lines of its own text.
    heads = places.where(F.col("doc_id").eqNullSafe(F.col("first.doc_id")))
    heads = heads.groupBy("hash", "doc_id", "text_hash").agg(F.collect_list("pos").alias("places"))
    whole = Window.partitionBy("hash").orderBy(F.col("doc_id").asc_nulls_last())
    heads = heads.withColumn("first", F.first(F.struct("doc_id")).over(whole))
    losers = heads.where(~F.col("doc_id").eqNullSafe(F.col("first.doc_id")))
    losers = losers.select("doc_id", "text_hash", F.explode("places").alias("pos"))

    # Repeated rows of a document repeat its drops: one row per line and text is left.
    dropped = later.unionByName(losers).distinct()
    in_text = Window.partitionBy("doc_id", "text_hash").orderBy("pos")
    runs = dropped.withColumn("run", F.col("pos") - F.row_number().over(in_text))
    runs = runs.groupBy("doc_id", "text_hash", "run").agg(F.min("pos").alias("start"), F.count("*").cast("int").alias("length"))
    return runs.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("runs"))


def _flags(runs: Column, n_lines: Column) -> Column:
    """The bitmap as an array of '1' (kept) and '0' (dropped), one a line."""
    end = lambda r: r["start"] + r["length"]
    parts = F.transform(runs, lambda r, i: F.concat(
        F.repeat(F.lit("1"), r["start"] - F.when(i > 0, end(F.get(runs, i - 1))).otherwise(0)),
        F.repeat(F.lit("0"), r["length"])))
    tail = F.repeat(F.lit("1"), n_lines - end(F.element_at(runs, -1)))
    return F.split(F.concat(F.array_join(parts, ""), tail), "")


def drop_lines(spark: SparkSession, docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``docs`` with ``text`` less the lines of :func:`keep_bitmaps`, and with
    ``n_lines`` (before) and ``n_dropped``, which replace columns of these
    names; a null text that loses nothing stays null."""
    bitmaps = keep_bitmaps(spark, docs, min_chars).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("held"), "runs")
    rows = docs.select(F.struct(*docs.columns).alias("row"), _text_hash(F.col("text")).alias("text_hash"))
    rows = rows.join(bitmaps, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("held")), "left")
    rows = rows.withColumn("lines", _lines(F.col("row.text"))).withColumn("n_lines", F.size("lines"))
    flagged = F.arrays_zip(F.col("lines").alias("line"), _flags(F.col("runs"), F.col("n_lines")).alias("flag"))
    kept = F.transform(F.filter(flagged, lambda x: x["flag"] == "1"), lambda x: x["line"])
    text = F.when(F.col("runs").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    lost = F.coalesce(F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["length"]), F.lit(0))
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return rows.select(
        *(text.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in own),
        F.col("n_lines").cast("long").alias("n_lines"), lost.cast("long").alias("n_dropped"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = drop_lines(spark, table(spark, sf_dir, "documents", "doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), held AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.*, h.key IS NOT NULL AND k.doc_id <> h.first_doc AS dropped
  FROM keyed k LEFT JOIN held h ON k.key = h.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

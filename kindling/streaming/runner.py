"""Run a streaming query to completion into a batch-id-partitioned Parquet table.

``foreachBatch`` writes every micro-batch to ``<out>/batch_id=<n>`` with
overwrite, so a batch replayed after a failure replaces its own output
(exactly-once at the table level). Stateful aggregates run in ``update``
mode; ``latest`` keeps, per key, the row of the highest batch id, which is
the final value. Checkpoints and outputs live under the shared checkpoint
folder (``spark.checkpoint.dir``), never on a machine-local path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.errors import AnalysisException

from kindling.session import scratch_path


def run_top_k(stream: DataFrame, name: str, key: str, count: str, k: int = 10) -> str:
    """The ``k`` greatest running counts (ties by key) after every batch, from a stream of running counts in update mode.

    Counts only grow, so a batch's first ``k`` are among the first ``k`` of the batch
    before and the keys that it changed: each batch ranks these alone, and the state is never written out whole."""

    def _rank(batch: DataFrame, batch_id: int, out: str) -> DataFrame:
        if batch_id:
            before = batch.sparkSession.read.schema(batch.schema).parquet(f"{out}/batch_id={batch_id - 1}")
            batch = batch.unionByName(before).groupBy(key).agg(F.max(count).alias(count))
        return batch.orderBy(F.desc(count), F.asc(key)).limit(k)

    return run_to_table(stream, name, per_batch=_rank)


def run_to_table(stream: DataFrame, name: str, output_mode: str = "update", timeout_s: float | None = None,
                 processing_time: str | None = None, per_batch=None, folder: str | None = None) -> str:
    """Run ``stream`` (``availableNow`` unless a processing-time trigger is given)
    and return the folder of its batch-partitioned output.

    ``per_batch`` maps each batch's frame, given its number and the output folder, before it is written. ``folder`` names the
    output; a run that finds an earlier one there goes on from its checkpoint.
    It runs to its end unless ``timeout_s`` is given. It fails if it dropped
    rows as later than the watermark: a result without them would be wrong."""
    spark = stream.sparkSession
    out = folder or scratch_path(spark, name)
    ckpt = f"{folder}-checkpoint" if folder else scratch_path(spark, name + "-checkpoint")

    def _write(batch: DataFrame, batch_id: int) -> None:
        (per_batch(batch, batch_id, out) if per_batch else batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", ckpt).foreachBatch(_write)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    else:
        writer = writer.trigger(availableNow=True)
    q = writer.queryName(f"{name}_{abs(hash(out)) % 10**8}").start()
    waited, late = 0.0, {}
    while True:
        ended = q.awaitTermination(5)
        waited += 5
        for p in q.recentProgress:
            late[p["batchId"]] = sum(s.get("numRowsDroppedByWatermark", 0) for s in p["stateOperators"])
        if ended:
            break
        if timeout_s is not None and waited >= timeout_s:
            q.stop()
            raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if sum(late.values()):
        raise RuntimeError(f"stream {name} dropped {sum(late.values())} rows that came later than the watermark")
    return out


def read_output(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """All batches of a ``run_to_table`` folder (empty frame if no batch ran)."""
    full = schema + ", batch_id INT"
    try:
        return spark.read.schema(full).parquet(out)
    except AnalysisException:  # no batch ran: the folder was never created
        return spark.createDataFrame(spark.sparkContext.emptyRDD(), full)  # no partitions, no tasks


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, the values of the row with the highest ``batch_id`` (update-mode merge)."""
    vals = [c for c in rows.columns if c not in keys and c != "batch_id"]
    packed = rows.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col("batch_id")).alias("_v"))
    return packed.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals])

"""Run a streaming aggregation to a table and read its final state back.

Update mode emits, per micro-batch, only the result rows that changed. Each
batch lands in its own folder (``_batch=<id>``, overwritten if the batch is
re-run after a failure, so the output is exactly-once together with the
checkpoint). The final table keeps, per key, the row of the highest batch.
This also shows the last window of a finite input, which append mode would
keep open until a later row moves the watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..storage import committed, remove  # noqa: F401 - also for callers


def _writer(path: str):
    def _batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")
    return _batch


def run_stream(stream: DataFrame, path: str, checkpoint: str, output_mode: str = "update",
               trigger: dict | None = None, name: str | None = None, wait: bool = True):
    w = (stream.writeStream.foreachBatch(_writer(path)).outputMode(output_mode)
         .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})))
    if name:
        w = w.queryName(name)
    q = w.start()
    if wait:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return q


def latest_rows(spark: SparkSession, path: str, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key, the row written by the highest batch id."""
    df = spark.read.parquet(path)
    vals = [c for c in columns if c not in keys]
    if not vals:
        return df.select(*keys).distinct()
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col("_batch")).alias("_v"))
    return g.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals]).select(*columns)


def all_rows(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Append-mode output: every row of every batch."""
    return spark.read.parquet(path).select(*columns)


def materialise_stream(spark: SparkSession, stream: DataFrame, keys: Sequence[str] | None,
                       name: str, output_mode: str = "update", trigger: dict | None = None) -> DataFrame:
    """Run ``stream`` to completion (availableNow) and return its result table."""
    base = scratch_path(spark, name)
    path, ckpt = f"{base}/out", f"{base}/checkpoint"
    columns = stream.columns
    run_stream(stream, path, ckpt, output_mode, trigger)
    if keys is None:
        return all_rows(spark, path, columns)
    return latest_rows(spark, path, keys, columns)

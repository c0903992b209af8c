"""Live statistics and live-vs-historic comparison on Structured Streaming.

The statistics are the same DataFrame functions as in batch
(``operators.stats``) on a streaming input with a watermark on ``t``. All
five per-tag statistics share one stateful aggregation (one exchange);
the word count has its own grain (window, tag, word).

Windows leave in append mode: once, when the watermark has passed their end. In
event time a post later than the watermark is in no window (it still is in the
archive and the post documents); the programs therefore use the ingest
time by default, as the original's processing-time windows do, where no post is
late. On a finite input the last windows close when something later
arrives, e.g. a marker row with a later time stamp.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numbers import java_int
from ..operators import compare, stats
from ..sinks.documents import STAT_INDEX, stat_documents, to_documents, write_batch
from .runner import committed, remove


def live_stats(posts: DataFrame, window: str | None = "30 seconds", session_gap: str | None = None,
               watermark: str = "1 minute", keys: Sequence[str] = ("tag",)) -> DataFrame:
    """W2-W11 on a stream of posts with event time ``t``."""
    return stats.windowed_stats(posts.withWatermark("t", watermark), "t", window=window,
                                session_gap=session_gap, keys=keys)


def live_word_count(posts: DataFrame, window: str = "60 seconds", watermark: str = "1 minute",
                    keys: Sequence[str] = ("tag",)) -> DataFrame:
    """W1 on a stream."""
    return stats.windowed_word_count(posts.withWatermark("t", watermark), "t", window=window, keys=keys)


def compare_batch(live_batch: DataFrame, historic: DataFrame, keys: Sequence[str] = ("tag",)) -> DataFrame:
    """J1-J3 for one micro-batch of live window statistics."""
    return compare.live_vs_historic(live_batch, historic, keys)


def write_history(history: DataFrame, root: str) -> str:
    """Write a new version of the historic table below ``root``; readers take
    the newest finished one, so none ever sees a half-written history."""
    found = committed(history.sparkSession, root, "version=")
    path = f"{root.rstrip('/')}/version={found[-1] + 1 if found else 0}"
    history.write.parquet(path)
    return path


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """The newest finished version below ``root``."""
    found = committed(spark, root, "version=")
    if not found:
        raise FileNotFoundError(f"no finished history below {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/version={found[-1]}")


def start_compare(live: DataFrame, history: str | Callable[[], DataFrame], path: str, checkpoint: str,
                  trigger: dict | None = None, shape=None, fmt: str = "parquet") -> StreamingQuery:
    """Every micro-batch of closed live windows (one row per window and tag) is
    joined with the history as it is then: ``history`` is the root of
    :func:`write_history`, or a callable, and is read in every batch. The
    differences land in ``path/_batch=<id>`` (``shape`` maps them first, e.g.
    to comparison documents; ``fmt`` is the writer, ``documents`` for the document sink)."""
    spark = live.sparkSession
    read = history if callable(history) else lambda: read_history(spark, history)

    def _batch(batch: DataFrame, batch_id: int) -> None:
        diff = compare_batch(batch, read())
        if shape is not None:
            diff = shape(diff)
        write_batch(diff, path, batch_id, fmt, folder="_batch")

    return (live.writeStream.foreachBatch(_batch).outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def start_compare_feed(live: DataFrame, history: DataFrame, path: str, state: str, checkpoint: str, keys: Sequence[str] = ("tag",),
                       measures: stats.Measures = stats.MEASURES, at: str = "at", trigger: dict | None = None) -> StreamingQuery:
    """J1-J3 with a historic side that is itself a stream: last-value state per key.

    ``history`` has ``keys``, the measures and its time ``at``; ``live`` are closed windows. Both are one
    stream; a window takes, for each key and statistic, the latest history not later than its end, and a key without any gives
    no row. Windows leave in the order of the watermark, so what is kept between batches
    (``state/batch=<id>``, two versions) is the history later than the last window that left and the one value before it.
    Differences land in ``path/_batch=<id>``.
    """
    spark, keys = live.sparkSession, list(keys)
    names = [*measures]
    values = F.struct(*[F.col(m).cast("double").alias(m) for m in names]).alias("values")
    none = F.lit(None).cast("timestamp")
    both = history.select(*keys, F.col(at).cast("timestamp").alias("at"), none.alias("window_start"), values).union(
        live.select(*keys, F.col("window_end").alias("at"), "window_start", values))

    def _batch(batch: DataFrame, batch_id: int) -> None:
        prev = [v for v in committed(spark, state, "batch=") if v < batch_id]
        rows = batch.persist()      # closed windows and history rows: a few per key
        try:
            known = rows.where("window_start IS NULL")
            if prev:
                known = known.unionByName(spark.read.parquet(f"{state}/batch={prev[-1]}"))
            ids = ["at", "window_start", *keys]
            long = stats.long_form(rows.where("window_start IS NOT NULL").select(*ids, "values.*"), ids, measures).withColumn("hist", F.lit(None).cast("double"))
            past = stats.long_form(known.select(*ids, "values.*"), ids, measures).select(*ids, "stat", F.lit(None).cast("double").alias("value"), F.col("value").alias("hist"))
            upto = W.partitionBy("stat", *keys).orderBy("at", F.col("window_start").isNotNull(), "hist").rowsBetween(W.unboundedPreceding, 0)
            found = long.unionByName(past).withColumn("hist", F.last("hist", ignorenulls=True).over(upto)).where("window_start IS NOT NULL AND hist IS NOT NULL")
            diff = F.col("hist") - F.col("value")
            (found.select(compare.stat_name_col().alias("name"), "window_start", F.col("at").alias("window_end"), *keys, diff.alias("diff"),
                          F.when(F.col("stat") == "max_word_length", java_int(diff)).alias("int_diff"))
             .write.mode("overwrite").parquet(f"{path}/_batch={batch_id}"))
            last = rows.where("window_start IS NOT NULL").agg(F.max(F.unix_micros("at")).alias("left"))
            before = spark.read.parquet(f"{state}/left/batch={prev[-1]}") if prev else last.limit(0)
            left = last.union(before).agg(F.max("left").alias("left")).first()["left"]
            newest = F.max(F.when(F.unix_micros("at") <= F.lit(left).cast("bigint"), F.col("at"))).over(W.partitionBy(*keys))
            spark.createDataFrame([(left,)], "left bigint").write.mode("overwrite").parquet(f"{state}/left/batch={batch_id}")
            (known.withColumn("newest", newest).where(F.col("newest").isNull() | (F.col("at") >= F.col("newest"))).drop("newest")
             .write.mode("overwrite").parquet(f"{state}/batch={batch_id}"))
        finally:
            rows.unpersist()
        for old in prev[:-1]:
            remove(spark, f"{state}/batch={old}")
            remove(spark, f"{state}/left/batch={old}")

    return (both.writeStream.foreachBatch(_batch).outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def start_stat_documents(spark: SparkSession, live: DataFrame, root: str, checkpoint: str,
                         trigger: dict | None = None) -> StreamingQuery:
    """K4: one streaming query writing every statistic to its document index,
    one document per closed window and tag."""
    def _batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()     # closed windows only: a few rows per tag
        try:
            for measure, index in STAT_INDEX.items():
                write_batch(stat_documents(batch, measure), f"{root}/{index}", batch_id)
        finally:
            batch.unpersist()

    return (live.writeStream.foreachBatch(_batch).outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def start_word_documents(words: DataFrame, root: str, checkpoint: str,
                         trigger: dict | None = None) -> StreamingQuery:
    """One document per closed window, tag and word."""
    def _batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(to_documents(batch, "tw_word_count"), f"{root}/tw_word_count", batch_id)

    return (words.writeStream.foreachBatch(_batch).outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())

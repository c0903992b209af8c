"""K1: time-bucketed JSON-lines archive of post records.

Directory per ``bucket`` = ``createdAt`` truncated to ``width_ms`` (10 min by
default). Inside each writer task rows are sorted by bucket, so a task keeps
one file open at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions.time import bucket_ms
from ..schema import POST_COLUMNS
from ..session import settings
from ..vocab import ARCHIVE_BUCKET_MS


def _with_bucket(posts: DataFrame, width_ms: int) -> DataFrame:
    return posts.select(*POST_COLUMNS, bucket_ms("createdAt", width_ms).alias("bucket"))


def write_archive(posts: DataFrame, path: str, width_ms: int = ARCHIVE_BUCKET_MS,
                  mode: str = "append", writers: int | None = 0) -> None:
    """Write posts under ``path/bucket=<ms>/``, reading them once.

    Rows are rebalanced by bucket over ``writers`` partitions (default:
    ``spark.sql.shuffle.partitions``), so a bucket is written by one task (one
    file); Spark splits a partition above the advisory size over several tasks while the
    query runs, which spreads a hot bucket. Small partitions are not put
    together: writing many small folders is bound by their number.
    ``writers=None`` skips the shuffle and only sorts inside each input task,
    which is cheaper when the input is already time-ordered.
    """
    df = _with_bucket(posts, width_ms)
    if writers is not None:
        df = df.hint("rebalance", *([writers] if writers else []), "bucket")
    with settings(df.sparkSession, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        df.sortWithinPartitions("bucket").write.mode(mode).partitionBy("bucket").json(path)


def stream_archive_sink(posts: DataFrame, path: str, checkpoint: str,
                        width_ms: int = ARCHIVE_BUCKET_MS, trigger: dict | None = None) -> StreamingQuery:
    """Streaming form: a new file per micro-batch and bucket, exactly once via the checkpoint."""
    w = (_with_bucket(posts, width_ms).writeStream.format("json").partitionBy("bucket")
         .option("path", path).option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(**(trigger or {"processingTime": "5 seconds"}))
    return w.start()

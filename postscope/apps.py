"""The four end-to-end programs, wired from the library's parts.

* :func:`live_statistics` - raw post feed -> archive (K1), post documents
  (K3), five windowed statistics (K4) and the windowed word count.
* :func:`historic_statistics` - archive -> six CSV result sets (K2).
* :func:`live_vs_historic` - archive averages vs live windows (J1-J3, K5).
* :func:`online_predictions` - three predict-then-learn models on the feed
  (P1-P3, P5, P6, K6).

Every streaming query gets its own checkpoint folder under ``checkpoint``;
restarting a program with the same folders resumes exactly where it stopped
(Spark's replacement for the fixed-delay restart loop of the original).
Returned are the started ``StreamingQuery`` objects.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .functions.text import utf16_length
from .operators import compare, predict, stats
from .sinks.archive import stream_archive_sink
from .sinks.datasource import FORMAT
from .sinks.documents import comparison_documents, stream_documents, to_documents
from .sinks.reports import write_reports
from .sources.posts import live_posts, live_raw, read_archive, read_archive_quarantine
from .streaming import predictors as sp
from .streaming.live import live_stats, live_word_count, start_compare, start_stat_documents, \
    start_word_documents, write_history
from .vocab import DEFAULT_TAGS, MODEL_NAMES


def _ck(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _wait_for_sink_log(spark: SparkSession, path: str, query: StreamingQuery) -> None:
    """Readers of a file-sink folder must start after the sink's commit log
    exists, so that they read committed files only. A quiet feed is waited for
    as long as the parse query lives."""
    jvm = spark.sparkContext._jvm
    log = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_spark_metadata")
    fs = log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    while not fs.exists(log):
        if not query.isActive:
            if query.exception() is not None:
                raise query.exception()
            raise RuntimeError(f"the parse query ended before it wrote {path}")
        time.sleep(0.2)


def _parse_once(spark: SparkSession, landing: str, tags: Sequence[str], checkpoint: str,
                parsed: str | None, quarantine: str | None, trigger: dict | None,
                time_mode: str = "ingest") -> tuple[list[StreamingQuery], DataFrame]:
    """Parse the raw feed once into a parquet file-sink table (exactly-once via
    the sink's commit log) that holds good and rejected rows. Returns the parse query
    and the query that writes rejected rows to ``quarantine`` (default
    ``<checkpoint>/quarantine``) as JSON, and a stream of the good ones."""
    parsed = parsed or _ck(checkpoint, "parsed_posts")
    posts = live_posts(live_raw(spark, landing), tags, track=tags, time_mode=time_mode, with_errors=True)
    posts = posts.withColumn("raw", F.when(F.col("error").isNotNull(), F.col("raw")))
    parse_q = (posts.writeStream.format("parquet").option("path", parsed)
               .option("checkpointLocation", _ck(checkpoint, "parse")).outputMode("append")
               .trigger(**(trigger or {"processingTime": "5 seconds"})).start())
    if trigger and trigger.get("availableNow"):
        parse_q.awaitTermination()          # finite run: the readers start after the parse
    else:
        _wait_for_sink_log(spark, parsed, parse_q)
    rows = spark.readStream.schema(posts.schema).parquet(parsed)
    rejected = stream_documents(rows.where(F.col("error").isNotNull()).select("raw", "error"),
                                quarantine or _ck(checkpoint, "quarantine"), _ck(checkpoint, "rejected"), trigger=trigger)
    return [parse_q, rejected], rows.where(F.col("error").isNull()).drop("error", "raw")


def live_statistics(spark: SparkSession, landing: str, archive: str, documents: str, checkpoint: str,
                    tags: Sequence[str] = DEFAULT_TAGS, window: str = "30 seconds",
                    word_window: str = "60 seconds", watermark: str = "1 minute",
                    time_mode: str = "ingest", trigger: dict | None = None,
                    parsed: str | None = None, quarantine: str | None = None) -> list[StreamingQuery]:
    """The feed is parsed once: a parquet file-sink query writes the post
    records to ``parsed`` (default ``<checkpoint>/parsed_posts``; exactly-once
    through the sink's metadata log), and the archive, post documents,
    statistics and word count stream from that columnar table instead of
    parsing the JSON again. Rejected posts go to ``quarantine``. ``time_mode``
    ``ingest`` (default) windows by arrival and loses no post; ``event``
    windows by ``createdAt``, and posts later than ``watermark`` are then in no window."""
    first, rows = _parse_once(spark, landing, tags, checkpoint, parsed, quarantine, trigger, time_mode)
    return [
        *first,
        stream_archive_sink(rows, archive, _ck(checkpoint, "archive"), trigger=trigger),
        stream_documents(to_documents(rows, "twitter"), f"{documents}/twitter",
                         _ck(checkpoint, "twitter"), trigger=trigger),
        start_stat_documents(spark, live_stats(rows, window=window, watermark=watermark), documents,
                             _ck(checkpoint, "stats"), trigger=trigger),
        start_word_documents(live_word_count(rows, window=word_window, watermark=watermark), documents,
                             _ck(checkpoint, "words"), trigger=trigger),
    ]


def historic_statistics(spark: SparkSession, archive: str, report_root: str,
                        recursive: bool = True, run_ms: int | None = None, quarantine: str | None = None) -> str:
    """Batch statistics of the whole archive; returns the run folder. Archive
    lines that are no records go to ``quarantine`` (default ``<run folder>/quarantine``)."""
    run = write_reports(read_archive(spark, archive, recursive=recursive), report_root, run_ms)
    read_archive_quarantine(spark, archive, recursive=recursive).write.json(quarantine or f"{run}/quarantine")
    return run


def refresh_history(spark: SparkSession, archive: str, out: str) -> str:
    """Aggregate the archive (one double average per tag and statistic) into a
    new version of ``out/historic``; running comparisons use it from their next batch on."""
    return write_history(compare.archive_averages(read_archive(spark, archive, recursive=True)), f"{out.rstrip('/')}/historic")


def live_vs_historic(spark: SparkSession, archive: str, landing: str, out: str, checkpoint: str,
                     tags: Sequence[str] = DEFAULT_TAGS, window: str = "30 seconds",
                     watermark: str = "1 minute", trigger: dict | None = None,
                     documents: str | None = None, time_mode: str = "ingest",
                     quarantine: str | None = None) -> list[StreamingQuery]:
    """Every closed live window is joined with the history of the archive
    (:func:`refresh_history`, called once here); differences land in ``out/diff``, or as
    comparison documents under ``documents/tw_comparedata`` when given."""
    refresh_history(spark, archive, out)
    first, posts = _parse_once(spark, landing, tags, checkpoint, None, quarantine, trigger, time_mode)
    live = live_stats(posts, window=window, watermark=watermark)
    history = f"{out.rstrip('/')}/historic"
    if documents:
        return [*first, start_compare(live, history, f"{documents.rstrip('/')}/tw_comparedata", _ck(checkpoint, "compare"),
                                      trigger, shape=comparison_documents, fmt=FORMAT)]
    return [*first, start_compare(live, history, f"{out.rstrip('/')}/diff", _ck(checkpoint, "compare"), trigger)]


def online_predictions(spark: SparkSession, landing: str, documents: str, checkpoint: str,
                       tags: Sequence[str] = DEFAULT_TAGS, trigger: dict | None = None,
                       slices: int | None = None, parsed: str | None = None,
                       quarantine: str | None = None) -> list[StreamingQuery]:
    """Length (exponential smoothing), re-share followers -> re-share count
    regression, statuses -> followers regression; each labelled and written
    as prediction documents under ``documents/tw_predictions/model=<name>``.

    Each micro-batch is cut into even slices and run through the batch
    predictors with a per-tag state table under ``checkpoint``, in the order of
    ``createdAt`` inside a batch. The feed is parsed once (see
    :func:`live_statistics`) and read by the three model queries.
    """
    first, posts = _parse_once(spark, landing, tags, checkpoint, parsed, quarantine, trigger, time_mode="event")
    lengths = posts.withColumn("length", utf16_length("text")).where(F.col("length").isNotNull())
    runs = {"ewma": (lengths, dict(kind="ewma", value="length")),
            "retweets": (stats.retweet_pairs(posts), dict(kind="regression", x="x", y="y")),
            "followers": (stats.status_pairs(posts), dict(kind="regression", x="x", y="y"))}
    return first + [sp.start_bucketed(
        df, out=f"{documents}/tw_predictions/model={MODEL_NAMES[model]}",
        state=_ck(checkpoint, f"pred_{model}_state"), checkpoint=_ck(checkpoint, f"pred_{model}"),
        slices=slices, trigger=trigger, fmt=FORMAT,
        shape=lambda p, m=model: to_documents(predict.label(p, m), "tw_predictions"), **kw)
        for model, (df, kw) in runs.items()]

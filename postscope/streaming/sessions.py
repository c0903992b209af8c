"""W7-W11 on a stream without a hot-tag task.

``session_window`` on a stream keeps all rows and state of a tag in one task. Here
open sessions are a small table (key, first and last time, partial sums)
carried from micro-batch to micro-batch and versioned by batch id, like the
predictors' state. The rows of a micro-batch are first folded by ``(key, cell of gap + 1
microseconds)``: two rows of a cell are at most the gap apart, so of one session whatever else
comes. That is an ordinary aggregation with partial sums in every task, so a hot tag or a hot
moment is one row per task, and the measures of a row are computed once. The cells are cut into even slices
of ``(key, time)`` together with the open sessions, as many as they need, islands are found slice
by slice, stitched over slice edges and to the open sessions in one two-level scan
(``operators.sessions.merged_intervals``), and sessions whose end the watermark has
passed leave. A session that an out-of-order row bridges becomes one.

Watermark: the latest time seen minus ``watermark``, never going back. A row whose own session
``[t, t + gap)`` had ended before the batch began is late: it is in no session and, if ``late`` is
given, is written there. A session leaves in the batch whose rows close it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.sessions import duration_us, merged_intervals
from ..operators.slices import SLICE, SPREAD, sliced
from ..operators.stats import MEASURES, Measures, measured
from .runner import committed, remove

SLICE_ROWS = 10_000   # cells and open sessions of a slice, unless the caller says how many slices


def partials(sources: dict[str, tuple[str, str]]) -> tuple[list, list, list]:
    """Per measure: what a row brings, how it adds up, and the finished value."""
    brings, adds, results = [], [], []
    for name, (col, a) in sources.items():
        c, v, n = F.col(col), f"_v_{name}", f"_n_{name}"
        if a in ("avg", "count"):
            brings.append(c.isNotNull().cast("bigint").alias(n))
            adds.append(F.sum(n).alias(n))
        if a != "count":
            wide = F.sum if a in ("avg", "sum") else getattr(F, a)
            brings.append(c.alias(v))
            adds.append(wide(v).alias(v))
        results.append((F.col(v).cast("double") / F.nullif(F.col(n), F.lit(0)) if a == "avg" else F.col(n if a == "count" else v)).alias(name))
    return brings, adds, results


def start_sessions(posts: DataFrame, out: str, state: str, checkpoint: str, gap: str = "1 second", watermark: str = "1 minute",
                   keys: Sequence[str] = ("tag",), time_col: str = "t", text: str = "text", measures: Measures = MEASURES,
                   slices: int | None = None, late: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Session statistics of a stream of posts: ``window_start, window_end, keys..., <measures>`` in ``out/_batch=<id>``.

    ``state`` holds the open sessions of the last two batches (a replayed batch reads the one
    before its own and overwrites its output).
    """
    spark = posts.sparkSession
    gap_us, delay_us = duration_us(gap), duration_us(watermark)
    keys = list(keys)

    def _batch(batch: DataFrame, batch_id: int) -> None:
        prev = [v for v in committed(spark, state, "batch=") if v < batch_id]
        mark = spark.read.parquet(f"{state}/marks/batch={prev[-1]}").first()["mark"] if prev else None
        m, sources = measured(batch.where(F.col(time_col).isNotNull()), measures, text)
        brings, adds, results = partials(sources)
        micros = F.unix_micros(F.col(time_col).cast("timestamp"))
        rows = m.select(*keys, micros.alias("_u"), micros.alias("_e"), *brings)
        if mark is not None:
            gone = F.col("_u") + gap_us <= mark
            if late:
                batch.where(micros + gap_us <= mark).write.mode("overwrite").parquet(f"{late}/_batch={batch_id}")
            rows = rows.where(~gone)
        folded, staged, grouped = (f"{state}/_{x}_{batch_id}" for x in ("cells", "rows", "groups"))
        cell = F.col("_u") - F.pmod(F.col("_u"), F.lit(gap_us + 1))     # down, before 1970 too
        (rows.groupBy(*keys, cell.alias("_cell")).agg(F.min("_u").alias("_u"), F.max("_e").alias("_e"), *adds).drop("_cell")
         .write.mode("overwrite").parquet(folded))
        rows = spark.read.parquet(folded)
        if prev:
            rows = rows.unionByName(spark.read.parquet(f"{state}/batch={prev[-1]}"))
        most = SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
        cut = sliced(rows, keys, ["_u"], slices or max(1, min(most, -(-rows.count() // SLICE_ROWS))), staged)
        merged_intervals(cut, keys, gap_us, adds, F.col(SLICE)).write.mode("overwrite").parquet(grouped)
        found = spark.read.parquet(grouped)
        latest = found.agg(F.max("_e")).first()[0]      # no open session is later than the latest row
        mark = max((x for x in (mark, None if latest is None else latest - delay_us) if x is not None), default=None)
        ended = F.col("_e") + gap_us <= F.lit(mark)
        (found.where(ended).select(F.timestamp_micros("_u").alias("window_start"), F.timestamp_micros(F.col("_e") + gap_us).alias("window_end"), *keys, *results)
         .write.mode("overwrite").parquet(f"{out}/_batch={batch_id}"))
        spark.range(1, numPartitions=1).select(F.lit(mark).cast("bigint").alias("mark")).write.mode("overwrite").parquet(f"{state}/marks/batch={batch_id}")
        found.where(~F.coalesce(ended, F.lit(False))).write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        for path in (folded, staged, grouped, *(f"{state}/{d}batch={old}" for old in prev[:-1] for d in ("", "marks/"))):
            remove(spark, path)

    w = posts.writeStream.foreachBatch(_batch).outputMode("append").option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()

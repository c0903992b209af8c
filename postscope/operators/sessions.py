"""Session windows for batch data without a hot-key task.

``session_window`` in batch shuffles by key and merges sessions after a sort
of the whole key: with five tags, five tasks, and a tag holding a third of
the data is a third of the data in one task. Here sessions are found as
*gaps and islands* inside ``(key, time bucket)`` partitions and stitched
across bucket edges through a per-bucket summary (first time, last time,
internal breaks; keys x buckets rows):

* a row opens a session when the previous row of its key is more than
  ``gap`` earlier (equal to ``gap`` still joins, as ``session_window`` does);
* the session number of a row = breaks in all earlier buckets + breaks up to
  the row in its own bucket, which is a prefix sum over the small summary
  plus a window inside the bucket.

Statistics are then an ordinary ``groupBy(key, session)`` with partial
aggregation. Window bounds: ``[first time, last time + gap)``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .slices import partition_columns

UNB = Window.unboundedPreceding

_UNITS_US = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
             "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def duration_us(text: str) -> int:
    """``'10 minutes'`` / ``'1 second'`` / ``'2 hours 30 minutes'`` -> microseconds."""
    total, found = 0, False
    for num, unit in re.findall(r"(\d+(?:\.\d+)?)\s*([a-z]+)", text.lower()):
        unit = unit.rstrip("s")
        if unit not in _UNITS_US:
            raise ValueError(f"unknown unit in duration {text!r}")
        total += int(float(num) * _UNITS_US[unit])
        found = True
    if not found:
        raise ValueError(f"cannot read duration {text!r}")
    return total


def session_ids(df: DataFrame, keys: Sequence[str], time_col: str, gap: str,
                bucket: str | Column = "1 day") -> DataFrame:
    """Add ``_sid`` (session number within the key, from 1) and ``_u``
    (event time in microseconds). ``bucket``: a column that grows with time
    inside a key (``operators.slices``), or a duration."""
    keys = list(keys)
    gap_us = duration_us(gap)
    d = df.withColumn("_u", F.unix_micros(F.col(time_col).cast("timestamp")))
    # non-nullable bucket key: both branches then share one row exchange
    cut = F.floor(F.col("_u") / F.lit(duration_us(bucket))) if isinstance(bucket, str) else bucket
    d = d.withColumn("_b", F.coalesce(cut.cast("bigint"), F.lit(0).cast("bigint")))
    parts = partition_columns(d, keys)
    wb = Window.partitionBy(*parts).orderBy("_u")
    prev = F.lag("_u").over(wb)
    d = d.withColumn("_brk", F.when(prev.isNotNull() & (F.col("_u") - prev > gap_us), 1).otherwise(0))
    d = d.withColumn("_c", F.sum("_brk").over(wb.rowsBetween(UNB, 0)))
    summ = d.groupBy(*dict.fromkeys([*keys, "_b", *parts])).agg(F.min("_u").alias("_first"), F.max("_u").alias("_last"),
                                                                F.sum("_brk").alias("_nb"))
    wk = Window.partitionBy(*keys).orderBy("_b")
    prev_last = F.lag("_last").over(wk)
    summ = summ.withColumn("_open", F.when(prev_last.isNull() | (F.col("_first") - prev_last > gap_us), 1)
                           .otherwise(0))
    carry = summ.select(*parts, (F.coalesce(F.sum(F.col("_open") + F.col("_nb")).over(
        wk.rowsBetween(UNB, -1)), F.lit(0)) + F.col("_open")).alias("_base"))
    d = d.join(carry, parts)
    return d.withColumn("_sid", F.col("_base") + F.col("_c")).drop("_b", "_brk", "_c", "_base")


def session_groups(df: DataFrame, keys: Sequence[str], time_col: str, gap: str,
                   aggs: Sequence[Column], bucket: str | Column = "1 day") -> DataFrame:
    """``groupBy(keys, session)`` with ``aggs``; adds ``window_start``/``window_end``."""
    keys = list(keys)
    gap_us = duration_us(gap)
    d = session_ids(df, keys, time_col, gap, bucket)
    g = d.groupBy(*keys, "_sid").agg(F.min("_u").alias("_s"), F.max("_u").alias("_e"), *aggs)
    names = [c for c in g.columns if c not in (*keys, "_sid", "_s", "_e")]
    return g.select(F.timestamp_micros("_s").alias("window_start"),
                    F.timestamp_micros(F.col("_e") + F.lit(gap_us)).alias("window_end"),
                    *keys, *names)


def merged_intervals(df: DataFrame, keys: Sequence[str], gap_us: int, aggs: Sequence[Column], bucket: str | Column) -> DataFrame:
    """Intervals ``[_u, _e]`` (microseconds) of a key that overlap, touch or lie at most ``gap_us`` apart,
    as one row ``keys..., _u, _e`` with ``aggs``.

    The same two-level scan as :func:`session_ids`, for rows that have a length (open sessions met again):
    the latest end so far is a running maximum in the slice and a prefix maximum over earlier slices.
    ``bucket`` grows with ``_u`` inside a key.
    """
    keys = list(keys)
    d = df.withColumn("_b", F.col(bucket) if isinstance(bucket, str) else bucket)
    parts = partition_columns(d, keys)
    cols = list(dict.fromkeys([*keys, "_b", *parts]))
    own = Window.partitionBy(*parts).orderBy("_u", "_e")
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(UNB, -1)
    ends = d.groupBy(*cols).agg(F.max("_e").alias("_me"))
    ends = ends.select(*parts, F.max("_me").over(earlier).alias("_before"))
    d = d.withColumn("_reach", F.max("_e").over(own.rowsBetween(UNB, -1))).join(ends, parts)
    reach = F.greatest("_reach", "_before")
    d = d.withColumn("_new", F.when(reach.isNotNull() & (F.col("_u") - reach <= gap_us), 0).otherwise(1))
    d = d.withColumn("_c", F.sum("_new").over(own.rowsBetween(UNB, 0)))
    count = d.groupBy(*cols).agg(F.sum("_new").alias("_nb"))
    count = count.select(*parts, F.coalesce(F.sum("_nb").over(earlier), F.lit(0)).alias("_base"))
    d = d.join(count, parts).withColumn("_sid", F.col("_base") + F.col("_c"))
    g = d.groupBy(*keys, "_sid").agg(F.min("_u").alias("_u"), F.max("_e").alias("_e"), *aggs)
    return g.drop("_sid")

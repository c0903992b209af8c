"""Even slices of keyed rows in arrival order.

The prefix scans (``operators.predict``, ``operators.sessions``) run per
``(key, slice)`` and join small slice summaries. Slices cut by volume: the rows
are range-partitioned by ``(key, order)``, so a hot key spans as many slices
as its share of the rows and a quiet one shares a partition with others,
whatever times the rows carry. The sliced rows are written once to the shared folder: the
slice of a row then never changes, however often the rows are read.

They are written bucketed by ``_part``, the key and slice as one string, so a
scan is already dealt out as the windows over a slice and the join with
the slice summaries need it: the rows are not shuffled again. A task reads one
bucket, so ``SPREAD`` slices on average.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..storage import remove

SLICE, PART = "_slice", "_part"
SPREAD = 4   # slices that share a bucket on average: buckets take them by hash, so several even out


def with_slices(df: DataFrame, key: str | Sequence[str], order: Sequence[str], slices: int | None = None) -> DataFrame:
    """``df`` with ``_slice``, which grows with ``order`` inside a key (default: ``spark.sql.shuffle.partitions`` slices)."""
    keys = [key] if isinstance(key, str) else list(key)
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *keys, *order).withColumn(SLICE, F.spark_partition_id().cast("bigint"))


def sliced(df: DataFrame, key: str | Sequence[str], order: Sequence[str], slices: int | None = None,
           path: str | None = None) -> DataFrame:
    """:func:`with_slices` and ``_part``, written to ``path`` (default: a fresh folder below the shared root) and read back.

    Only a table of the catalog can say how files are bucketed; the entry is dropped again at
    once, as the frame that is returned keeps what it says. The files stay.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "slices")
    keys = [key] if isinstance(key, str) else list(key)
    n = slices or SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = with_slices(df, keys, order, n).withColumn(PART, F.to_json(F.struct(SLICE, *keys)))
    remove(spark, path)
    name = f"postscope_slices_{uuid.uuid4().hex}"
    cut.write.format("parquet").bucketBy(-(-n // SPREAD), PART).option("path", path).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def partition_columns(df: DataFrame, keys: Sequence[str], bucket: str = "_b") -> list[str]:
    """What windows and joins over a slice are keyed by."""
    return [PART] if PART in df.columns else [*keys, bucket]

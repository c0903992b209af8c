"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read back.

    Cuts lineage, fixes generated row numbers and survives lost executors;
    the folder comes from ``spark.checkpoint.dir``.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``; Arrow's unused memory goes back when a task ends, as workers are reused and would keep it."""
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return tidied


def row_blocks(sizes: Sequence[int | None], most: int) -> Iterator[tuple[int, int]]:
    """Slices of neighbouring rows of at most ``most`` bytes together, or of one row."""
    start = total = 0
    for k, n in enumerate(sizes):
        if k > start and total + (n or 0) > most:
            yield start, k
            start, total = k, 0
        total += n or 0
    if start < len(sizes):
        yield start, len(sizes)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(taken: Sequence[str], *names: str) -> list[str]:
    """Each of ``names`` with underscores in front, as many as keep it apart from the columns ``taken``."""
    have, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out


def lower_az(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha_hex(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def held_out(id_col: str, mod: int) -> Column:
    """crc32 of the id as text modulo ``mod`` is 2; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod == 2

"""Folders on the shared storage, through the file systems that Spark knows."""

from __future__ import annotations

from pyspark.sql import SparkSession


def committed(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the finished ``<prefix><n>`` folders below ``path``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith(prefix) and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(name[len(prefix):]))
    return sorted(out)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote below the shared root or a checkpoint."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

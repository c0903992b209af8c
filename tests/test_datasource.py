"""The document sink as a data source: nothing is seen before its commit, nothing twice."""

import os

import pytest
from pyspark.sql import functions as F

from postscope.sinks import datasource as D
from postscope.sinks.documents import stream_documents, write_batch, write_documents


def lines(path):
    return sorted(line for d, _, names in os.walk(path) if "_staging" not in d for n in names if n.endswith(".json") for line in open(os.path.join(d, n)).read().splitlines())


def test_batch_append_and_overwrite(spark, tmp_path):
    D.register(spark)
    docs = spark.range(4).select("id", F.when(F.col("id") > 1, F.lit("é")).alias("name"))
    docs.repartition(3).write.format("documents").mode("append").save(str(tmp_path / "a"))
    assert lines(tmp_path / "a") == ['{"id": 0}', '{"id": 1}', '{"id": 2, "name": "é"}', '{"id": 3, "name": "é"}']
    write_documents(docs, str(tmp_path / "a"))
    assert len(lines(tmp_path / "a")) == 8 and spark.read.json(str(tmp_path / "a")).count() == 8
    write_documents(docs.limit(1), str(tmp_path / "a"), mode="overwrite")
    assert lines(tmp_path / "a") == ['{"id":0}']
    write_documents(docs.limit(0), str(tmp_path / "empty"))
    assert lines(tmp_path / "empty") == [] and not os.listdir(tmp_path / "a" / "_staging")


def test_a_failed_or_killed_write_leaves_no_document(spark, tmp_path):
    @F.udf("string")
    def breaks(k):
        if k == 7:
            raise ValueError("broken row")
        return str(k)

    with pytest.raises(Exception):
        write_documents(spark.range(8).repartition(4).select(breaks("id").alias("value")), str(tmp_path / "f"))
    assert lines(tmp_path / "f") == []
    # a job that is killed after its tasks wrote and before the commit
    staged = tmp_path / "f" / "_staging" / "dead"
    staged.mkdir(parents=True)
    (staged / "part-00000-1.json").write_text('{"id":1}')
    write_documents(spark.range(1).select(F.lit('{"id":2}').alias("value")), str(tmp_path / "f"))
    assert spark.read.json(str(tmp_path / "f")).select("id").collect()[0].id == 2 and lines(tmp_path / "f") == ['{"id":2}']


def test_a_batch_is_written_once(spark, tmp_path):
    for k in (1, 2):
        write_batch(spark.range(k).select("id"), str(tmp_path), 5)
    assert lines(tmp_path) == ['{"id":0}'] and os.listdir(tmp_path / "batch=5")


def test_stream_over_a_restart(spark, tmp_path):
    for k in range(2):
        spark.range(3).select((F.col("id") + 3 * k).alias("id")).write.parquet(f"{tmp_path}/feed/turn={k}")
        stream = spark.readStream.schema("id bigint").option("recursiveFileLookup", "true").parquet(f"{tmp_path}/feed")
        stream_documents(stream, f"{tmp_path}/out", f"{tmp_path}/ck", trigger={"availableNow": True}).awaitTermination()
    assert lines(tmp_path / "out") == [f'{{"id":{k}}}' for k in range(6)]
    assert sorted(d for d in os.listdir(tmp_path / "out") if d.startswith("batch=")) == ["batch=0", "batch=1"]

"""Cleaning a corpus for training: good, distinct, uncontaminated, secret-free documents as token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet under the shared folder and
reads again as the next one's ``docs``. All but the last return the columns of
``documents``.

1. quality: documents that the line CRF scores under its threshold go.
2. near_duplicates: of each SimHash component the smallest id stays.
3. decontaminate: documents whose words benchmark windows cover to a twentieth or more go.
4. secrets: credentials that are no widely copied examples are masked in the text; ``n_chars`` follows.
5. tokens: token ids of each text, and whether they decode to it again.

Nulls, empty texts, ties, repeated rows and empty tables are as each operator
defines them: empty texts have no good text and go in stage 1.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postscope.llm.bpe import encode
from postscope.llm.common import read_table, stored
from postscope.llm.crf import good_documents
from postscope.llm.decontaminate import drop_contaminated
from postscope.llm.secret_scan import redact
from postscope.llm.simhash import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = redact(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    both = encode(docs, keep=("doc_id", "lang", "source", "text"), decoded=True)
    return both.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: Stage 1 is a trained model and stage 5 a tokenizer, neither of which SQL can state.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

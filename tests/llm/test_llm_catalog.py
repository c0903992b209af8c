import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from postscope.llm import catalog
from postscope.llm.bpe import Vocabulary, decode_ids, default_path
from postscope.llm.crf import THRESHOLD, quality
from postscope.llm.decontaminate import contamination
from postscope.llm.secret_scan import scan_secrets
from postscope.llm.simhash import components

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(sum(q.startswith(f"op{n}_") for q in names) == 1 for n in range(1, 14)) and "pipeline" in names
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_sql_of_the_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(catalog.ORACLE[name])
    columns = [d[0] for d in want.description]
    got = catalog.QUERIES[name](spark, SF).select(*columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_stages_do_what_their_operators_decide(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels, items = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    ids = lambda df, c="doc_id": sorted(r[0] for r in df.select(c).collect())
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, before, SF).write.parquet(f"{tmp_path}/{name}")
        docs = kept[name] = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "tokens":
            assert docs.columns == columns
        if name == "quality":
            assert ids(docs) == ids(quality(before, labels).where(F.col("score") >= THRESHOLD), "id")
        if name == "near_duplicates":
            assert ids(docs) == ids(components(before).where("id = component_id"), "id")
        if name == "decontaminate":
            assert ids(docs) == ids(contamination(before, items).where("NOT contaminated"), "id")
        if name == "secrets":
            assert ids(docs) == ids(before)
            after = scan_secrets(docs)
            assert after.where(F.exists("spans", lambda s: s["held"] != "example")).count() == 0
            assert docs.where(F.col("n_chars") != F.char_length("text")).count() == 0
    v = Vocabulary(default_path())
    texts = {r.doc_id: r.text for r in kept["secrets"].collect()}
    rows = kept["tokens"].collect()
    assert all(r.round_trip and decode_ids(r.ids, v) == texts[r.doc_id] and r.n_tokens == len(r.ids) for r in rows) and len(rows) == len(texts)


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls, empties, repeats, a text of a megabyte and columns with the stages' own names, among the given documents."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    text = "The river ran by the old mill and the children walked home along it every evening."
    long = "\n".join(r.text for r in given.where("lang = 'en'").limit(40).collect()) * 8
    rows = [(900, long[:1_000_000], "en", "a", 9), (901, text, "en", "a", len(text)), (901, text, "en", "a", len(text)), (902, None, "en", None, None), (903, "", None, "b", 0),
            (None, text + " It was a long way and nobody ever minded the rain at all.", "en", "c", 9)]
    frame = given.union(spark.createDataFrame(rows, given.schema))
    for c in ("_hide", "ids", "root", "score", "uid", "bad_id", "_text"):
        frame = frame.withColumn(c, F.lit("own"))
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    whole = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} <= {r.doc_id for r in whole} | {900, 901, None} and len(out) >= len(whole) - 40
    assert all(r.round_trip for r in out) and sum(r.doc_id == 901 for r in out) <= 1


def test_pipeline_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []

import hashlib
import math
import random
from collections import Counter
from statistics import mean

import pytest
from pyspark.sql import functions as F

from postscope.llm import weighted_sampling as S


def jaccard(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    return sum((a & b).values()) / sum((a | b).values())


def query(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("bucket", F.lit("x")).withColumn("place", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    return S.op4_fingerprints(spark, str(tmp_path)).collect()


def test_collision_rate_is_generalised_jaccard(spark, tmp_path):
    rng = random.Random(1)
    rows = []  # each pair has words of its own, so that pairs are independent
    for k in range(400):
        words = [f"w{k // 2}x{m}" for m in range(40)]
        rows.append((k, " ".join(rng.choices(words, weights=range(1, 41), k=rng.randrange(20, 80)))))
    got = {r.doc_id: r for r in query(spark, tmp_path, rows)}
    off = [got[k].near_next - jaccard(rows[k][1], rows[k + 1][1]) for k in range(0, 400, 2)]
    assert abs(mean(off)) < 4 * math.sqrt(0.25 / S.SAMPLES / 200)
    assert all(len(r.fingerprint) == 8 * S.SAMPLES for r in got.values())


def test_edited_texts_order_and_ties(spark, tmp_path):
    rows = [(5, "é😀abc def ghi"), (-2, "first text of all here"), (9, "last one"), (7, ""), (8, None), (9, "last one"), (None, "null id goes first"), (6, "x"), (10, "word " * 40000)]
    got = query(spark, tmp_path, rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = Counter()
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        h = len(t) // 2
        want[i, len(t), hashlib.sha256((t[:len(t) - h] + n[:h]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    by = {(r.doc_id, r.n_chars): r for r in got}
    assert by[7, 0].fingerprint == by[8, 0].fingerprint == "0" * (8 * S.SAMPLES)
    assert by[7, 0].near_next == 1.0 and by[7, 0].near_edited == 1.0
    assert len({r.fingerprint for r in got if r.doc_id == 9}) == 1


@pytest.mark.parametrize("rows", [[], [(4, "only one row of text")]])
def test_empty_table_and_single_row(spark, tmp_path, rows):
    got = query(spark, tmp_path, rows)
    assert len(got) == len(rows)
    if got:
        t = rows[0][1]
        assert got[0].near_next == 1.0
        assert got[0].edited_sha256 == hashlib.sha256((t[:10] + t[:10]).encode()).hexdigest()


def test_term_runs(spark):
    got = S.terms(spark.createDataFrame([(1, "a b a  c\ta"), (2, ""), (3, "A a")], "k int, t string"), ["k"], "t").collect()
    assert Counter((r.k, r.tf) for r in got) == Counter([(1, 3), (1, 1), (1, 1), (3, 1), (3, 1)])


def test_bucket_of_counts_bounds(spark):
    bounds = [3, 5, 9, 20]
    df = spark.range(25).select("id", S.bucket_of(F.col("id"), bounds).alias("b"))
    assert all(r.b == sum(x <= r.id for x in bounds) for r in df.collect())

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from postscope.llm import crf as S

DOCS = "doc_id bigint, text string, score string, lines string, label string, body string"


def brute_marginals(evidence, step, start):
    n = len(evidence)
    weights = {}
    for path in itertools.product((0, 1), repeat=n):
        s = start[path[0]] + sum(e * y for e, y in zip(evidence, path)) + sum(step[a][b] for a, b in zip(path, path[1:]))
        weights[path] = math.exp(s)
    z = sum(weights.values())
    good = [sum(w for p, w in weights.items() if p[k]) / z for k in range(n)]
    moved = np.zeros((2, 2))
    for p, w in weights.items():
        for a, b in zip(p, p[1:]):
            moved[a, b] += w / z
    return good, moved, math.log(z)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    counts = np.array([3, 0, 1, 6, 2])
    evidence, step, start = rng.normal(size=12), rng.normal(size=(2, 2)), rng.normal(size=2)
    good, moved, z = S.forward_backward(evidence, counts, step, start)
    at, want, total, norm = 0, [], np.zeros((2, 2)), 0.0
    for c in counts:
        if c:
            g, m, n = brute_marginals(evidence[at:at + c], step, start)
            want, total, norm = want + g, total + m, norm + n
        at += c
    assert np.allclose(good, want) and np.allclose(moved, total) and math.isclose(z, norm)


def test_features_of_lines():
    x, length, counts = S.line_features([b"", "Ab é.\n\n \nAb é.".encode(), b"\n", b"NO!! 12"])
    assert counts.tolist() == [0, 2, 0, 1]
    assert length.tolist() == [5, 5, 7]
    f = dict(zip(S.FEATURES, x.T))
    assert f["seen_before"].tolist() == [0, 1, 0]
    assert f["ends_sentence"].tolist() == [1, 1, 0]
    assert np.allclose(f["upper"], [1 / 3, 1 / 3, 1])
    assert np.allclose(f["digits"], [0, 0, 2 / 6])
    both = S.with_neighbours(x, counts)
    assert (both[0, len(S.FEATURES):2 * len(S.FEATURES)] == 0).all() and (both[1, len(S.FEATURES):2 * len(S.FEATURES)] == x[0]).all()


def corpus(n):
    rng = np.random.default_rng(0)
    docs, labels = [], []
    for k in range(n):
        good = k % 4 != 0
        lines = [" ".join(rng.choice(["the", "river", "of", "stones", "walked"], 12)).capitalize() + "." for _ in range(5)]
        if not good:
            lines[1:] = ["BUY!! NOW!! $$$ ### WIN!! " * 3] * 4
        docs.append((k, "\n".join(lines)))
        labels.append((k, int(good), 0))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in docs], DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_lines_of_bad_documents_are_told_apart(spark):
    docs, labels = corpus(200)
    d, lab = frames(spark, docs, labels)
    got = {r.id: r for r in S.quality(d, lab).collect()}
    assert all((got[k].score >= S.THRESHOLD) == bool(q) for k, q, _ in labels)
    bad = np.array([got[k].lines for k, q, _ in labels if not q])
    assert (bad[:, 0] > 0.5).mean() > 0.9 and (bad[:, 1:] < 0.5).all()


def test_nulls_empties_repeats_and_missing_labels(spark):
    docs, labels = corpus(60)
    odd = [(900, None), (901, ""), (902, " \n\t\n"), (None, docs[1][1]), (903, docs[0][1]), (903, docs[0][1]), (904, "w " * 200000), (905, "\n".join(["One more line."] * 3000))]
    d, lab = frames(spark, docs + odd, labels + [(1, 0, 0), (None, 1, 0), (5, None, 0), (7777, 1, 1)])
    rows = S.quality(d, lab).collect()
    assert len(rows) == len(docs) + len(odd)
    by = {r.id: r for r in rows}
    assert by[900].score == by[901].score == by[902].score < S.THRESHOLD
    assert by[900].lines == [] and len(by[905].lines) == 3000
    assert all(0 <= r.score <= 1 for r in rows)
    kept = S.good_documents(d, lab)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {r.id for r in rows if r.score >= S.THRESHOLD}


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)]])
def test_without_both_labels_or_documents(spark, labels):
    docs, _ = corpus(6)
    d, lab = frames(spark, docs, labels)
    assert S.quality(d, lab).count() == 6
    d, lab = frames(spark, [], labels)
    assert S.quality(d, lab).count() == 0
    assert S.good_documents(d, lab).count() == 0


def test_held_out_accuracy_on_the_given_labels(spark):
    sf = "/root/testdata/sf0.01"
    found = S.op7_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    r = found.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("right"), F.sum(F.when((F.col("quality") == 1) & (F.col("predicted") == 0), 1).otherwise(0)).alias("lost")).first()
    assert r["right"] > 0.95 and r["lost"] <= 3


def test_good_documents_pass_clashing_columns_on(spark):
    docs = spark.createDataFrame([(k, f"The river ran by the old mill and the children walked home {k}.", "s", "i", "h") for k in range(4)], "doc_id bigint, text string, score string, id string, text_hash string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = S.good_documents(docs, labels)
    assert out.columns == docs.columns and all((r.score, r.id, r.text_hash) == ("s", "i", "h") for r in out.collect())

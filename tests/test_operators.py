"""Statistics, comparison and predictors on literal data, and the bucketed
prefix scan against a plain Python recursion."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from postscope.operators import compare, predict, stats
from postscope.schema import POST


def posts(spark, rows):
    """rows: (tag, text, followers, reretweets, seconds)"""
    base = datetime(2024, 1, 1)
    data = []
    for i, (tag, text, fol, rr, sec) in enumerate(rows):
        data.append((tag, i + 1, text, "", fol, 0, 0, 0, 0, True, "",
                     (i + 100 if rr else 0, "", "", 0, 0, 0, rr, 0)))
    df = spark.createDataFrame(data, POST)
    times = {i + 1: base + timedelta(seconds=r[4]) for i, r in enumerate(rows)}
    tdf = spark.createDataFrame(list(times.items()), "id bigint, t timestamp")
    return df.join(tdf, "id")


def test_batch_average_truncates_window_average_does_not(spark):
    p = posts(spark, [("A", "x", 1, 0, 0), ("A", "y", 2, 0, 1)])
    h = stats.historic_stats(p).first()
    assert h.avg_followers == 1
    w = stats.windowed_stats(p, "t", window="30 seconds").first()
    assert w.avg_followers == 1.5


def test_reretweets_keep_zero_rows(spark):
    p = posts(spark, [("A", "x", 1, 0, 0), ("A", "y", 1, 4, 1)])
    assert stats.historic_stats(p).first().avg_reretweets == 2


def test_pairs_rules(spark):
    p = posts(spark, [("A", "x", 10, 0, 0), ("A", "y", 20, 7, 1)])   # first row is not a re-share
    rt = stats.retweet_pairs(p).collect()
    assert [(r.x, r.y) for r in rt] == [(7, 0)]
    zero = p.withColumn("id", F.when(F.col("id") == 1, F.lit(0)).otherwise(F.col("id")))
    assert sorted(r.y for r in stats.status_pairs(zero).collect()) == [20]


def test_sessions_touching_gap(spark):
    p = posts(spark, [("A", "a", 1, 0, 100), ("A", "a", 1, 0, 101), ("A", "a", 1, 0, 102),
                      ("A", "a", 1, 0, 103.5)])
    w = stats.windowed_stats(p, "t", session_gap="1 second").orderBy("window_start").collect()
    base = datetime(2024, 1, 1)
    assert [(r.window_start, r.window_end) for r in w] == [
        (base + timedelta(seconds=100), base + timedelta(seconds=103)),
        (base + timedelta(seconds=103.5), base + timedelta(seconds=104.5))]


@pytest.mark.parametrize("bucket", ["1 second", "2 seconds", "1 day"])
def test_bucketed_sessions_equal_session_window(spark, bucket):
    rnd = random.Random(7)
    rows, sec = [], 0.0
    for i in range(400):
        sec += rnd.choice([0.2, 0.5, 1.0, 1.0, 1.3, 3.0])
        rows.append((rnd.choice("AB"), "w" * rnd.randint(1, 5), rnd.randint(0, 9), 0, sec))
    p = posts(spark, rows)
    a = stats.windowed_stats(p, "t", session_gap="1 second")
    b = stats.windowed_stats(p, "t", session_gap="1 second", session_bucket=bucket)
    cols = ["window_start", "window_end", "tag", "max_word_length", "avg_followers", "avg_length"]
    key = lambda r: tuple(round(v, 9) if isinstance(v, float) else v for v in r)
    assert sorted(map(key, a.select(cols).collect())) == sorted(map(key, b.select(cols).collect()))


def test_comparison_inner_join(spark):
    live = spark.createDataFrame(
        [(datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 30), "A", 3, 1.0, 7.0, 1.0, 1.0),
         (datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 30), "Z", 3, 1.0, 7.0, 1.0, 1.0)],
        "window_start timestamp, window_end timestamp, tag string, max_word_length int, "
        "avg_words double, avg_length double, avg_followers double, avg_reretweets double")
    hist = spark.createDataFrame([("A", 5, 1.0, 5.0, 1.0, 1.0)],
                                 "tag string, max_word_length int, avg_words double, avg_length double, "
                                 "avg_followers double, avg_reretweets double")
    out = {r.name: r.diff for r in compare.live_vs_historic(live, hist).collect()}
    assert out["avgTweetLength"] == -2.0
    assert out["maxWordLength"] == 2.0
    assert len(out) == 5                                   # tag Z has no history: no rows


def seq(spark, xs, ys=None, key="k", start=0, per_bucket=None):
    rows = []
    for i, x in enumerate(xs):
        b = (i // per_bucket) if per_bucket else 0
        rows.append((key, i + start, float(x), float(ys[i]) if ys else 0.0, b))
    return spark.createDataFrame(rows, "tag string, id bigint, x double, y double, b bigint")


def test_ewma_literal(spark):
    p = predict.ewma_predict(seq(spark, [10, 20, 5]), "tag", ["id"], "x").orderBy("predicted_value").collect()
    assert [round(r.predicted_value, 9) for r in p] == [0.0, 1.0, 2.9]
    assert [r.predicted for r in p] == [0, 1, 2]


def test_regression_literal(spark):
    df = seq(spark, [1] * 20 + [2], [3] * 20 + [9])
    p = predict.regression_predict(df, "tag", ["id"], "x", "y").collect()
    assert [(r.predicted, r.real) for r in p] == [(6, 9)]
    assert predict.regression_predict(seq(spark, [1] * 20, [3] * 20), "tag", ["id"], "x", "y").count() == 0
    z = predict.regression_predict(seq(spark, [0] * 20 + [5], [3] * 21), "tag", ["id"], "x", "y").first()
    assert z.predicted == -1


def test_sma_literal(spark):
    p = predict.sma_predict(seq(spark, [100, 7]), "tag", ["id"], "x").orderBy(F.col("real").desc()).collect()
    assert [r.predicted for r in p] == [0, 1]


def py_ewma(xs, rate):
    v, out = 0.0, []
    for x in xs:
        out.append(v)
        v = v + rate * (x - v)
    return out


def py_reg(xs, ys, warmup=20):
    sxy = sxx = 0.0
    out = []
    for i, (x, y) in enumerate(zip(xs, ys)):
        if i + 1 > warmup:
            if sxx == 0:
                out.append(-1)
            else:
                out.append(int(max(min(sxy / sxx * x, 2**31 - 1), -2**31)))
        sxy += x * y
        sxx += x * x
    return out


def py_sma(xs, ring=100):
    buf, out = [0.0] * ring, []
    for i, x in enumerate(xs):
        out.append(int(sum(buf) / ring))
        buf[i % ring] = x
    return out


@pytest.mark.parametrize("per_bucket", [None, 7, 130])
def test_predictors_match_recursion(spark, per_bucket):
    rnd = random.Random(per_bucket or 1)
    xs = [rnd.randint(-50, 500) for _ in range(700)]
    ys = [rnd.randint(0, 900) for _ in range(700)]
    df = seq(spark, xs, ys, per_bucket=per_bucket)
    bucket = "b" if per_bucket else None
    e = predict.ewma_predict(df, "tag", ["id"], "x", rate=0.5, bucket=bucket, keep=["id"]).orderBy("id")
    got = [r.predicted_value for r in e.collect()]
    assert got == pytest.approx(py_ewma(xs, 0.5), abs=1e-9)
    e1 = predict.ewma_predict(df, "tag", ["id"], "x", rate=0.1, bucket=bucket, keep=["id"]).orderBy("id")
    assert [r.predicted_value for r in e1.collect()] == pytest.approx(py_ewma(xs, 0.1), abs=1e-9)
    r = predict.regression_predict(df, "tag", ["id"], "x", "y", bucket=bucket, keep=["id"]).orderBy("id")
    assert [x.predicted for x in r.collect()] == py_reg(xs, ys)
    s = predict.sma_predict(df, "tag", ["id"], "x", bucket=bucket, keep=["id"]).orderBy("id")
    assert [x.predicted for x in s.collect()] == py_sma(xs)


@pytest.mark.parametrize("bucket", ["b", None])
def test_state_carries_across_chunks(spark, tmp_path, bucket):
    """Predicting chunk by chunk from the previous chunk's state equals one pass."""
    rnd = random.Random(11)
    xs = [rnd.randint(0, 300) for _ in range(900)]
    ys = [rnd.randint(0, 900) for _ in range(900)]
    df = seq(spark, xs, ys, per_bucket=40)
    cuts = [0, 130, 131, 500, 900]
    parts = [df.where((F.col("id") >= a) & (F.col("id") < b)) for a, b in zip(cuts, cuts[1:])]
    models = {
        "ewma": (lambda d, i: predict.ewma_predict(d, "tag", ["id"], "x", bucket=bucket, keep=["id"], init=i),
                 lambda d, i: predict.ewma_state(d, "tag", ["id"], "x", bucket=bucket, init=i), "predicted_value"),
        "sma": (lambda d, i: predict.sma_predict(d, "tag", ["id"], "x", bucket=bucket, keep=["id"], init=i),
                lambda d, i: predict.sma_state(d, "tag", ["id"], "x", bucket=bucket, init=i), "predicted"),
        "reg": (lambda d, i: predict.regression_predict(d, "tag", ["id"], "x", "y", bucket=bucket, keep=["id"],
                                                        init=i),
                lambda d, i: predict.regression_state(d, "tag", "x", "y", init=i), "predicted"),
    }
    for name, (pred, state, col) in models.items():
        whole = {r.id: r[col] for r in pred(df, None).collect()}
        got, init = {}, None
        for i, p in enumerate(parts):
            got.update({r.id: r[col] for r in pred(p, init).collect()})
            path = str(tmp_path / f"{name}-{bucket}-state-{i}")
            state(p, init).write.parquet(path)
            init = spark.read.parquet(path)
        assert got.keys() == whole.keys(), name
        assert [got[k] for k in sorted(got)] == pytest.approx([whole[k] for k in sorted(whole)], abs=1e-9), name


@pytest.mark.parametrize("rate,per_bucket,n", [(1e-4, 1, 1500), (0.1, 1, 700), (0.9, 1, 300), (0.1, 3400, 11000), (0.999, 5, 60)])
def test_ewma_forgets_nothing(spark, rate, per_bucket, n):
    """All history counts, however the rows are cut: slices of one row, and several blocks in one slice."""
    rnd = random.Random(n)
    xs = [10 ** 9] * 40 + [rnd.randint(-50, 500) for _ in range(n - 40)]
    df = seq(spark, xs, per_bucket=per_bucket)
    e = predict.ewma_predict(df, "tag", ["id"], "x", rate=rate, bucket="b", keep=["id"]).orderBy("id")
    assert [r.predicted_value for r in e.collect()] == pytest.approx(py_ewma(xs, rate), rel=1e-9, abs=1e-7)


def test_affine_maps_compose_over_all_levels(spark, monkeypatch):
    monkeypatch.setattr(predict, "SPAN", 4)
    rnd = random.Random(3)
    maps = [(k, b, rnd.randint(0, 3), rnd.random()) for k in "ab" for b in range(150)]
    df = spark.createDataFrame(maps, "k string, _b bigint, _m bigint, _e double")
    got = {(r.k, r._b): (r._c, r._ci) for r in predict.affine_prefix(df, ["k"], 0.9).collect()}
    for key in "ab":
        v = 0.0
        for k, b, m, e in maps:
            if k == key:
                before, v = v, v * 0.9 ** m + e
                assert got[k, b] == pytest.approx((before, v), rel=1e-12)


def test_sliced_rows_are_shuffled_once(spark, tmp_path):
    """Between the scan of a slice table and the windows over it nothing is shuffled; only slice summaries are."""
    from postscope.operators.slices import SLICE, sliced
    from postscope.session import settings
    df = seq(spark, list(range(400)), list(range(400)))
    rows = sliced(df, "tag", ["id"], 6, str(tmp_path / "cut"))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("postscope_slices")]
    for out in (predict.ewma_predict(rows, "tag", ["id"], "x", bucket=SLICE, keep=["id"]), predict.sma_predict(rows, "tag", ["id"], "x", bucket=SLICE, keep=["id"]),
                predict.regression_predict(rows, "tag", ["id"], "x", "y", bucket=SLICE, keep=["id"])):
        assert out.count() >= 380
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for out in (predict.ewma_predict(rows, "tag", ["id"], "x", bucket=SLICE, keep=["id"]), predict.sma_predict(rows, "tag", ["id"], "x", bucket=SLICE, keep=["id"]),
                    predict.regression_predict(rows, "tag", ["id"], "x", "y", bucket=SLICE, keep=["id"])):
            lines = out._jdf.queryExecution().executedPlan().toString().split("\n")
            branch = [line for line in lines if line.lstrip().startswith(":")]     # the left side of the join: the rows
            assert any("FileScan" in line and "Bucketed: true" in line for line in branch) and not any("Exchange" in line for line in branch)


def test_stop_lists_inline_and_joined_give_the_same_words(spark, tmp_path, monkeypatch):
    """The packaged list as a filter, as a user's file, and past the counted size as a join; then a list of 100,000 words."""
    from postscope.functions import text as T
    from postscope.vocab import STOP_WORDS
    texts = [("a", "The river ran and the mill stood by it, word5 word6"), ("b", "an ounce of word7 is THE best of word99999 and word100000"), ("b", "")]
    docs = spark.createDataFrame(texts, "tag string, text string")
    assert len(STOP_WORDS) == 141 and STOP_WORDS[0] == "i" and STOP_WORDS[-1] == "9"
    (tmp_path / "stop.txt").write_text("# own list\n" + "\n".join(STOP_WORDS) + "\n\nthe\n")
    listed = T.stop_list(spark, str(tmp_path / "stop.txt"))
    want = sorted(map(tuple, stats.word_count(docs).collect()))
    assert sorted(map(tuple, stats.word_count(docs, stop_words=listed).collect())) == want
    assert ("b", "best", 1) in want and not any(w == "the" for _, w, _ in want)
    many = [*STOP_WORDS, *(f"word{k}" for k in range(100_000))]
    left = [r for r in want if r[1] in ("word100000",) or not r[1].startswith("word")]
    assert sorted(map(tuple, stats.word_count(docs, stop_words=many).collect())) == left
    rows_ = T.word_rows(docs, stop_words=many)
    assert sorted((r.tag, r.word) for r in rows_.collect()) == sorted((t, w) for t, w, n in left for _ in range(n))
    monkeypatch.setattr(T, "INLINE_STOP_WORDS", 3)
    assert sorted(map(tuple, stats.word_count(docs, stop_words=listed).collect())) == want
    assert "LeftAnti" in T.word_rows(docs, stop_words=listed)._jdf.queryExecution().optimizedPlan().toString()

"""Layer 3: streaming forms equal the batch forms, with state crossing
micro-batches (input split into several files, one file per trigger)."""

import os

import pytest
from pyspark.sql import functions as F

from postscope.operators import predict, stats
from postscope.sources.tables import event_posts
from postscope.streaming.live import live_stats
from postscope.streaming.runner import materialise_stream


def split_events(spark, sf001, tmp_path, parts=3):
    ev = spark.read.parquet(f"{sf001}/events.parquet")
    n = ev.count()
    cuts = [n * i // parts for i in range(parts + 1)]
    d = tmp_path / "events_split"
    for i in range(parts):
        (ev.where((F.col("event_id") >= cuts[i]) & (F.col("event_id") < cuts[i + 1]))
         .coalesce(1).write.parquet(str(d / f"part{i}")))
    schema = ev.schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", "1")
              .option("recursiveFileLookup", "true").parquet(str(d)))
    return ev, stream


def rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_stream_tumbling_equals_batch(spark, sf001, tmp_path):
    ev, stream = split_events(spark, sf001, tmp_path)
    b = stats.windowed_stats(event_posts(ev), "t", window="1 hour")
    s = materialise_stream(spark, live_stats(event_posts(stream), window="1 hour", watermark="1 hour"),
                           ["window_start", "tag"], "t_tumble")
    cols = ["window_start", "tag", "max_word_length", "avg_followers", "avg_reretweets"]
    rb = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(b, cols)]
    rs = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(s, cols)]
    assert rb == rs


@pytest.mark.parametrize("parts,slices", [(2, 1), (5, 7)])
def test_stream_predictors_equal_batch(spark, sf001, tmp_path, parts, slices):
    """Micro-batches with a state table between them equal one batch pass, however the rows are sliced."""
    from postscope.streaming.predictors import start_bucketed
    ev, stream = split_events(spark, sf001, tmp_path, parts)
    bp, spo = event_posts(ev), event_posts(stream)
    runs = {
        "ewma": dict(value="followersCount"),
        "sma": dict(value="followersCount"),
        "regression": dict(x="statusesCount", y="followersCount"),
    }
    for kind, kw in runs.items():
        base = tmp_path / f"bk-{kind}"
        q = start_bucketed(spo, kind, str(base / "out"), str(base / "state"), str(base / "ck"),
                           slices=slices, trigger={"availableNow": True}, **kw)
        q.awaitTermination()
        got = spark.read.parquet(str(base / "out"))
        assert got.select("batch").distinct().count() == parts      # one output per micro-batch
        assert len([d for d in os.listdir(base / "state") if not d.startswith(".")]) == 2     # older states are pruned
        if kind == "ewma":
            b = predict.ewma_predict(bp, "tag", ["t", "id"], "followersCount", keep=["id"])
            rb = {r.id: r.predicted_value for r in b.collect()}
            rs = {r.id: r.predicted_value for r in got.collect()}
            assert rb.keys() == rs.keys() and max(abs(rb[k] - rs[k]) for k in rb) < 1e-9
        elif kind == "sma":
            b = predict.sma_predict(bp, "tag", ["t", "id"], "followersCount", keep=["id"])
            assert rows(b, ["id", "predicted", "real"]) == rows(got, ["id", "predicted", "real"])
        else:
            b = predict.regression_predict(bp, "tag", ["t", "id"], "statusesCount", "followersCount", keep=["id"])
            assert rows(b, ["id", "predicted", "real"]) == rows(got, ["id", "predicted", "real"])


def test_a_hot_tag_in_one_instant_is_sliced_evenly(spark):
    """One tag holds 60% of the rows, all within five seconds: no slice holds more than twice the mean."""
    from postscope.operators.slices import SLICE, with_slices
    rows_ = spark.range(20_000).select(F.when(F.col("id") % 10 < 6, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 4)).alias("tag"),
                                       F.timestamp_millis(F.floor(F.col("id") / 4)).alias("t"), "id")
    sizes = [r["count"] for r in with_slices(rows_, "tag", ["t", "id"], 16).groupBy(SLICE).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 2 * 20_000 / 16


def test_a_refreshed_history_is_used_from_the_next_batch(spark, tmp_path):
    from postscope.streaming.live import start_compare, write_history
    feed = str(tmp_path / "feed")
    schema = "window_start timestamp, window_end timestamp, tag string, max_word_length int, avg_words double, avg_length double, avg_followers double, avg_reretweets double"
    live = "SELECT timestamp'2020-01-01' + make_interval(0, 0, 0, {0}) AS window_start, timestamp'2020-01-02' AS window_end, 'a' AS tag, 5 AS max_word_length, 1D AS avg_words, 1D AS avg_length, 1D AS avg_followers, 1D AS avg_reretweets"
    for k in range(2):
        spark.sql(f"SELECT 'a' AS tag, {10 + k} AS max_word_length, 1D AS avg_words, 1D AS avg_length, {k}D AS avg_followers, 1D AS avg_reretweets").transform(
            lambda h: write_history(h, str(tmp_path / "historic")) and h)
        spark.sql(live.format(k)).write.parquet(f"{feed}/part={k}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(feed)
        start_compare(stream, str(tmp_path / "historic"), str(tmp_path / "out"), str(tmp_path / "ck"), {"availableNow": True}).awaitTermination()
    got = {(r.window_start.day, r.name): (r.diff, r.int_diff) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[1, "maxWordLength"] == (5.0, 5) and got[2, "maxWordLength"] == (6.0, 6)
    assert got[1, "avgFollowerCount"] == (-1.0, None) and got[2, "avgFollowerCount"] == (0.0, None)


def session_batches(spark, root, batches, **how):
    """Runs ``start_sessions`` over lists of (tag, seconds, id), one restart per batch; the sessions found."""
    from postscope.streaming.sessions import start_sessions
    schema = "tag string, t timestamp, id bigint"
    for k, rows_ in enumerate(batches):
        frame = spark.createDataFrame([(tag, round(s * 1_000_000), i) for tag, s, i in rows_], "tag string, us bigint, id bigint")
        frame.select("tag", F.timestamp_micros("us").alias("t"), "id").write.parquet(f"{root}/feed/turn={k}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/feed")
        measures = {"n": (F.lit(1), "count"), "total": (F.col("id"), "sum"), "mean": (F.col("id"), "avg"), "least": (F.col("id"), "min")}
        start_sessions(stream, f"{root}/out", f"{root}/state", f"{root}/ck", measures=measures, late=f"{root}/late", trigger={"availableNow": True}, **how).awaitTermination()
    out = spark.read.parquet(f"{root}/out").select("tag", F.unix_micros("window_start").alias("a"), F.unix_micros("window_end").alias("z"), "n", "total", "mean", "least")
    return sorted(tuple(r) for r in out.collect())


def plain_sessions(rows_, gap):
    out = []
    for tag in {r[0] for r in rows_}:
        times = sorted((round(s * 1_000_000), i) for t, s, i in rows_ if t == tag)
        while times:
            part = [times.pop(0)]
            while times and times[0][0] - part[-1][0] <= gap * 1_000_000:
                part.append(times.pop(0))
            ids = [i for _, i in part]
            out.append((tag, part[0][0], part[-1][0] + gap * 1_000_000, len(ids), sum(ids), sum(ids) / len(ids), min(ids)))
    return sorted(out)


def test_open_sessions_cross_micro_batches(spark, tmp_path, slices=7):
    """Rows out of order by up to 20 s over three batches, with a bridge between two open sessions: equal to one pass over all rows."""
    import random
    rnd = random.Random(slices)
    rows_, now = [], 0.0
    for i in range(450):
        now += rnd.choice([0.2, 0.7, 1.0, 1.4, 4.0])
        rows_.append(("hot" if rnd.random() < 0.6 else rnd.choice("ab"), round(now, 1), i))
    near = sorted(rows_, key=lambda r: r[1] + rnd.random() * 20)
    batches = [near[k * 150:(k + 1) * 150] for k in range(3)]
    batches += [[("end", now + 1000, 0)]]
    got = session_batches(spark, str(tmp_path), batches, gap="1 second", watermark="30 seconds", slices=slices)
    assert got == [s for s in plain_sessions(rows_, 1) if s[0] != "end"]
    assert len([d for d in os.listdir(tmp_path / "state") if d.startswith("batch=")]) == 2 and spark.read.parquet(str(tmp_path / "late")).count() == 0


def test_a_bridge_joins_open_sessions_and_late_rows_are_kept_apart(spark, tmp_path):
    batches = [[("a", 10, 1), ("a", 12, 2)], [("a", 11, 3), ("a", 100, 4)], [("a", 10.5, 5), ("a", 99, 6), ("b", 300, 7)], []]
    got = session_batches(spark, str(tmp_path), batches, gap="1 second", watermark="30 seconds")
    assert [(s[0], s[1] // 10**6, s[2] // 10**6, s[3], s[4]) for s in got] == [("a", 10, 13, 3, 6), ("a", 99, 101, 2, 10)]
    assert [r.id for r in spark.read.parquet(str(tmp_path / "late")).collect()] == [5]


def test_dense_rows_are_folded_before_they_are_cut(spark, tmp_path, monkeypatch):
    """Rows at most a gap apart inside a cell are one row before slices are made, and few rows are few slices; exact before 1970, at a cell's edges, with repeated rows."""
    from postscope.streaming import sessions
    seen = []

    def spy(rows, key, order, slices=None, path=None):
        seen.append((rows.count(), slices))
        return plain(rows, key, order, slices, path)

    plain = sessions.sliced
    monkeypatch.setattr(sessions, "sliced", spy)
    dense = [(tag, s, i) for tag, start in (("a", -40.0), ("b", 7.0)) for i, s in enumerate([start + k / 100 for k in range(1500)] * 2)]
    edges = [("c", s, 9000 + i) for i, s in enumerate([-6.0, -5.0, -3.999999, -2.999999, -1.0, 0.0, 1.0, 2.000001, 3.000001, 3.000001, 6.0])]
    rows_ = dense + edges
    got = session_batches(spark, str(tmp_path), [rows_[::2], rows_[1::2], [("end", 9000, 0)]], gap="1 second", watermark="2 minutes")
    want = [s for s in plain_sessions(rows_, 1) if s[0] != "end"]
    assert got == want and sum(s[0] == "c" for s in want) == 5
    assert len(seen) == 3 and max(n for n, _ in seen) < 100 and {k for _, k in seen} == {1}


def test_a_feed_of_one_task_is_several_files(spark, tmp_path, monkeypatch):
    """Events in one file of one row group: a turn is written by one task, and its stream is read by more."""
    from postscope.plans import catalog
    monkeypatch.setattr(catalog, "FEED_ROWS", 100)
    spark.range(1200).coalesce(1).select(F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), F.col("id").alias("user_id"), F.lit("a").alias("event_type"),
                                         F.lit(1.0).alias("value"), F.lit("{}").alias("props")).write.parquet(str(tmp_path / "sf/events.parquet"))
    seen = []

    def start(stream):
        w = stream.writeStream.foreachBatch(lambda batch, _: seen.append(batch.count()))
        return w.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()

    catalog.in_turns(spark, str(tmp_path / "sf"), str(tmp_path / "base"), start)
    assert sum(seen) == 1201 and len(seen) == 4
    files = [len([x for x in os.listdir(tmp_path / f"base/feed/turn={k}") if x.endswith(".parquet")]) for k in range(4)]
    assert min(files[:3]) >= 4 and files[3] == 1


def test_sessions_of_no_gap(spark, tmp_path):
    """A gap of nothing joins equal times only."""
    got = session_batches(spark, str(tmp_path), [[("a", 1, 1), ("a", 1, 2), ("a", 1.000001, 3)], [("end", 900, 0)]], gap="0 seconds", watermark="1 second")
    assert [(s[0], s[3], s[4]) for s in got if s[0] == "a"] == [("a", 2, 3), ("a", 1, 3)]


def test_session_slices_of_a_hot_tag_are_even(spark, tmp_path):
    """60% of the rows are one tag: no task of the session scan reads over twice the mean."""
    from postscope.operators.sessions import merged_intervals
    from postscope.operators.slices import SLICE, sliced
    rows_ = spark.range(30_000).select(F.when(F.col("id") % 10 < 6, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 4)).alias("tag"),
                                       (F.col("id") * 400_000).alias("_u"), (F.col("id") * 400_000).alias("_e"), F.lit(1).alias("n"))
    cut = sliced(rows_, "tag", ["_u"], 16, str(tmp_path / "cut"))
    sizes = [r["count"] for r in cut.groupBy(SLICE).count().collect()]
    assert max(sizes) <= 2 * 30_000 / 16
    got = merged_intervals(cut, ["tag"], 1_000_000, [F.sum("n").alias("n")], F.col(SLICE))
    assert got.agg(F.sum("n")).first()[0] == 30_000
    plain = rows_.select("tag", F.timestamp_micros("_u").alias("t")).groupBy(F.session_window("t", "1 second").alias("w"), "tag").count()
    assert sorted((r.tag, r._u, r.n) for r in got.collect()) == sorted((r[0], r[1], r[2]) for r in plain.select("tag", F.unix_micros("w.start"), "count").collect())


def test_history_that_streams_in(spark, tmp_path):
    """A history row between two windows changes only the later one, before and after a restart; a tag without history gives no row."""
    from postscope.streaming.live import start_compare_feed
    at = lambda col, m: f"timestamp'2020-01-01' + make_interval(0, 0, 0, 0, 0, {m}) AS {col}"
    live = lambda tag, m, v: f"SELECT {at('window_start', m - 1)}, {at('window_end', m)}, '{tag}' AS tag, {v}D AS avg_length"
    hist = lambda tag, m, v: f"SELECT '{tag}' AS tag, {v}D AS avg_length, {at('at', m)}"
    turns = [([("a", 5, 1), ("a", 10, 1), ("b", 6, 1)], [("a", 2, 10), ("a", 7, 20)]),
             ([("a", 15, 1), ("a", 25, 1), ("b", 16, 1)], [("a", 20, 30), ("b", 17, 5)]),
             ([("a", 30, 1), ("b", 31, 1)], [("a", 4, 99)])]
    for k, (windows, past) in enumerate(turns):
        spark.sql(" UNION ALL ".join(live(*w) for w in windows)).write.parquet(f"{tmp_path}/live/turn={k}")
        spark.sql(" UNION ALL ".join(hist(*h) for h in past)).write.parquet(f"{tmp_path}/hist/turn={k}")
        read = lambda name: spark.readStream.schema(spark.read.parquet(f"{tmp_path}/{name}/turn=0").schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/{name}")
        start_compare_feed(read("live"), read("hist"), f"{tmp_path}/out", f"{tmp_path}/state", f"{tmp_path}/ck", measures=("avg_length",), trigger={"availableNow": True}).awaitTermination()
    got = {(r.tag, r.window_end.minute): r["diff"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {("a", 5): 9.0, ("a", 10): 19.0, ("a", 15): 19.0, ("a", 25): 29.0, ("a", 30): 29.0, ("b", 31): 4.0}
    assert spark.read.parquet(f"{tmp_path}/state/batch=2").groupBy("tag").count().count() == 2


def test_word_state_is_kept_in_rocksdb_over_a_restart(spark, sf001, tmp_path):
    from postscope.session import STATE_CONF
    from postscope.streaming.live import live_word_count
    from postscope.streaming.runner import latest_rows, run_stream
    ev = spark.read.parquet(f"{sf001}/events.parquet")
    cut = ev.agg(F.expr("percentile(event_id, 0.5)")).first()[0]
    for k, part in enumerate((ev.where(F.col("event_id") <= cut), ev.where(F.col("event_id") > cut))):
        part.write.parquet(f"{tmp_path}/feed/turn={k}")
        stream = spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/feed")
        run_stream(live_word_count(event_posts(stream), window="1 hour", watermark="30 days"), f"{tmp_path}/out", f"{tmp_path}/ck")
    files = [f for _, _, names in os.walk(tmp_path / "ck" / "state") for f in names]
    assert any(f.endswith(".changelog") for f in files) and all(v in open(tmp_path / "ck" / "offsets" / "1").read() for v in STATE_CONF.values())
    got = latest_rows(spark, f"{tmp_path}/out", ["window_start", "tag", "word"], ["window_start", "tag", "word", "n"])
    want = stats.windowed_word_count(event_posts(ev), "t", window="1 hour").select("window_start", "tag", "word", "n")
    assert rows(got, got.columns) == rows(want, want.columns)

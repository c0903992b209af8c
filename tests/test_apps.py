"""The four programs end to end on a small feed of literal posts; covers the
archive (K1 stream), document sinks (K3-K6), CSV reports (K2), archive
readers (S2, S3) and the comparison."""

import json
import os
import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from postscope import apps
from postscope.operators import stats
from postscope.sources.posts import read_archive, stream_archive
from postscope.streaming.runner import materialise_stream

TAGS = ["Google", "Apple", "Intel"]


def make_posts(n=120, seed=3):
    rnd = random.Random(seed)
    base = datetime(2019, 10, 22, 20, 0, 0, tzinfo=timezone.utc)
    out = []
    for i in range(n):
        ts = base + timedelta(seconds=7 * i)
        tag = rnd.choice(TAGS)
        post = {
            "created_at": ts.strftime("%a %b %d %H:%M:%S +0000 %Y"), "id": 1000 + i,
            "text": f"{tag} news number {i}! " + "word " * rnd.randint(0, 6), "lang": "en",
            "user": {"name": f"u{i}", "followers_count": rnd.randint(0, 5000),
                     "statuses_count": rnd.randint(0, 900), "favourites_count": 1},
            "retweet_count": rnd.randint(0, 3),
        }
        if i % 3 != 0:          # 80 re-shares: enough rows per tag to pass the 20-row warm-up
            post["retweeted_status"] = {
                "created_at": ts.strftime("%a %b %d %H:%M:%S +0000 %Y"), "id": 5000 + i,
                "text": "orig", "retweet_count": rnd.randint(0, 400),
                "user": {"name": "o", "followers_count": rnd.randint(0, 90000),
                         "statuses_count": 3, "favourites_count": 4}}
        out.append(json.dumps(post))
    out.append(json.dumps({"lang": "fr", "text": "Google bonjour"}))
    out.append("{broken Google")
    # a post of the next day closes all windows before it
    last = dict(post, id=9999, created_at=(base + timedelta(days=1)).strftime("%a %b %d %H:%M:%S +0000 %Y"), text="Intel closing")
    last.pop("retweeted_status", None)
    out.append(json.dumps(last))
    return out


def landing(tmp_path, lines, files=3):
    d = tmp_path / "landing"
    d.mkdir()
    step = (len(lines) + files - 1) // files
    for i in range(files):
        (d / f"part{i}.json").write_text("\n".join(lines[i * step:(i + 1) * step]) + "\n")
    return str(d)


def wait(qs):
    for q in qs:
        q.awaitTermination()
        assert q.exception() is None


def test_programs_end_to_end(spark, tmp_path):
    land = landing(tmp_path, make_posts())
    arch, docs, ck = str(tmp_path / "archive"), str(tmp_path / "docs"), str(tmp_path / "ck")
    once = {"availableNow": True}
    wait(apps.live_statistics(spark, land, arch, docs, ck, tags=TAGS, window="1 minute",
                              word_window="1 minute", time_mode="event", trigger=once))
    # archive: 10-minute directories, every good English post once
    a = read_archive(spark, arch)
    assert a.count() == 121
    assert a.select("bucket").distinct().count() == 3       # 20:00:00-20:13:53: two 10-min buckets, and the closing post's
    assert sorted(r.tag for r in a.select("tag").distinct().collect()) == sorted(TAGS)
    assert read_archive(spark, arch, recursive=True).count() == 121
    # archive read as a stream equals the batch read
    s = materialise_stream(spark, stream_archive(spark, arch).select("id", "tag"), None, "t_arch",
                           output_mode="append")
    assert s.count() == 121
    # documents
    assert spark.read.json(f"{docs}/twitter").count() == 121
    assert [r.raw for r in spark.read.json(f"{ck}/quarantine").collect()] == ["{broken Google"]
    wl = spark.read.json(f"{docs}/tw_avg_tweetlength")
    windows = stats.windowed_stats(a.where("id <> 9999").withColumn("t", F.timestamp_millis("createdAt")), "t", window="1 minute")
    assert wl.count() == windows.count()      # one document per closed window and tag
    assert set(wl.columns) - {"batch"} == {"avg_tweetlength", "avg_tweetlength_tag", "avg_tweetlength_timestamp"}
    wc = spark.read.json(f"{docs}/tw_word_count")
    assert set(wc.columns) - {"batch"} == {"word", "count", "word_count_tag", "word_count_timestamp"}
    assert wc.where(F.col("word") == "news").count() > 0
    assert wc.where(F.col("word").isin("rt", "the")).count() == 0

    # historic CSV reports equal the batch statistics of the archive
    run = apps.historic_statistics(spark, arch, str(tmp_path / "reports"), run_ms=1)
    assert spark.read.schema("raw string").json(f"{run}/quarantine").count() == 0
    assert sorted(os.listdir(run)) == sorted(["quarantine", "wordcount", "avgWordbyTweet", "avgTweetlength", "avgRetweets",
                                              "avgFollower", "maxWordLength"])
    csv = spark.read.csv(f"{run}/avgFollower", schema="value int, tag string")
    exp = stats.single_stat(a, "avg_followers")
    assert sorted(map(tuple, csv.collect())) == sorted((r.value, r.tag) for r in exp.collect())

    # live vs historic: one row per live window, tag and statistic with history
    out = str(tmp_path / "cmp")
    wait(apps.live_vs_historic(spark, arch, land, out, str(tmp_path / "ck1"), tags=TAGS, window="1 minute", time_mode="event", trigger=once))
    diff = spark.read.parquet(f"{out}/diff")
    assert diff.count() > 0
    assert set(r.name for r in diff.select("name").distinct().collect()) <= {
        "maxWordLength", "avgTweetLength", "avgRetweets", "avgFollowerCount", "avgWordInTweet"}

    # the same comparison as documents (K5)
    wait(apps.live_vs_historic(spark, arch, land, out, str(tmp_path / "ck2"), tags=TAGS, window="1 minute",
                               time_mode="event", trigger=once, documents=docs))
    lines = [r.value for r in spark.read.text(f"{docs}/tw_comparedata").collect()]
    assert all("." not in str(json.loads(x)["comparedata"]) for x in lines if json.loads(x)["comparedata_name"] == "maxWordLength")
    cd = spark.read.json(f"{docs}/tw_comparedata")
    assert set(cd.columns) - {"_batch"} == {"comparedata", "comparedata_tag", "comparedata_name",
                                             "comparedata_timestamp"}
    assert cd.count() == diff.count()

    # predictions: three labelled document sets
    wait(apps.online_predictions(spark, land, docs, str(tmp_path / "ck3"), tags=TAGS, trigger=once))
    p = spark.read.json(f"{docs}/tw_predictions")
    names = {r.predictions_name for r in p.select("predictions_name").distinct().collect()}
    assert names == {"LengthPredictions", "RetweetPredictions", "FollowerPredictions"}
    assert p.where(F.col("predictions_name") == "LengthPredictions").count() == 121


def test_one_document_per_window_over_many_micro_batches(spark, tmp_path):
    from postscope.sources.posts import live_posts, live_raw
    from postscope.streaming.live import live_stats, start_compare, start_stat_documents, write_history
    posts = make_posts(6)[:6]
    at = lambda k, s: json.dumps(dict(json.loads(posts[k]), text="Google word", created_at=f"Tue Oct 22 20:00:{s:02d} +0000 2019"))
    land = tmp_path / "landing"
    land.mkdir()
    for k in range(6):
        (land / f"p{k}.json").write_text(at(k, 2 * k) + "\n")
        os.utime(land / f"p{k}.json", (1000 + k, 1000 + k))
    (land / "z.json").write_text(make_posts(1)[-1] + "\n")
    live = lambda: live_stats(live_posts(live_raw(spark, str(land), 1), ["Google", "Intel"]), window="30 seconds")
    wait([start_stat_documents(spark, live(), str(tmp_path / "docs"), str(tmp_path / "ck"), {"availableNow": True})])
    d = spark.read.json(f"{tmp_path}/docs/tw_max_wordlength")
    assert [(r.max_wordlength, r.max_wordlength_tag) for r in d.select("max_wordlength", "max_wordlength_tag").where("max_wordlength_tag = 'Google'").collect()] == [(6, "Google")]
    write_history(spark.sql("SELECT 'Google' AS tag, 9 AS max_word_length, 1D AS avg_words, 1D AS avg_length, 1D AS avg_followers, 1D AS avg_reretweets"), f"{tmp_path}/h")
    wait([start_compare(live(), f"{tmp_path}/h", f"{tmp_path}/cmp", f"{tmp_path}/ck2", {"availableNow": True})])
    assert spark.read.parquet(f"{tmp_path}/cmp").count() == 5


def test_no_archive_line_is_dropped_silently(spark, tmp_path):
    """The same lines are good for every column selection, in batch and as a stream."""
    from postscope.sources.posts import read_archive_quarantine
    good = [json.dumps({"tag": "a", "id": k, "text": "x y", "followersCount": 5, "createdAt": 0}) for k in (1, 2)]
    (tmp_path / "arch").mkdir()
    (tmp_path / "arch" / "f.json").write_text("\n".join([good[0], "{broken", good[1], good[0].replace("5", '"many"'), "", " "]) + "\n")
    path = str(tmp_path / "arch")
    a = read_archive(spark, path)
    assert a.count() == len(a.collect()) == a.select("tag", "text").count() == len(a.select("tag", "text").collect()) == 2
    assert sorted(r.raw[:7] for r in read_archive_quarantine(spark, path).collect()) == ['{"tag":', "{broken"] or read_archive_quarantine(spark, path).count() == 2
    for rejected in (False, True):
        s = materialise_stream(spark, stream_archive(spark, path, rejected=rejected), None, f"t_lines{rejected}", output_mode="append")
        assert s.count() == 2


def test_late_posts_are_counted_by_arrival(spark, tmp_path):
    from postscope.sources.posts import live_posts, live_raw
    from postscope.streaming.live import live_stats
    posts = [json.loads(x) for x in make_posts(4)[:4]]
    land = tmp_path / "landing"
    land.mkdir()
    for k, minute in enumerate((10, 11, 12, 0)):
        (land / f"p{k}.json").write_text(json.dumps(dict(posts[k], created_at=f"Tue Oct 22 20:{minute:02d}:00 +0000 2019")) + "\n")
        os.utime(land / f"p{k}.json", (1000 + k, 1000 + k))
    out = materialise_stream(spark, live_stats(live_posts(live_raw(spark, str(land), 1), TAGS, time_mode="ingest").withColumn("one", F.lit(1)), window="1 day")
                             .select("window_start", "tag", "avg_followers"), ["window_start", "tag"], "t_late")
    assert sorted(r.tag for r in out.collect()) == sorted({x for x in TAGS for p in posts if x in p["text"]})


def test_ingest_time_windows(spark, tmp_path):
    """With time_mode='ingest' rows are stamped with the processing time,
    so every post of one micro-batch falls into the current window."""
    from postscope.sources.posts import live_posts, live_raw
    from postscope.streaming.live import live_stats
    land = landing(tmp_path, make_posts(30), files=1)
    posts = live_posts(live_raw(spark, land), TAGS, time_mode="ingest")
    out = materialise_stream(spark, live_stats(posts, window="1 hour", watermark="1 minute"),
                             ["window_start", "tag"], "t_ingest")
    rows = out.collect()
    assert rows and len({r.window_start for r in rows}) == 1
    assert sorted(r.tag for r in rows) == sorted({r.tag for r in rows})
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    assert abs((rows[0].window_start - now).total_seconds()) < 2 * 3600


def test_archive_without_shuffle(spark, tmp_path):
    """K1 with writers=None: no repartition, same archive content."""
    from postscope.sinks.archive import write_archive
    from postscope.sources.tables import event_posts, table
    ev = event_posts(table(spark, "/root/testdata/sf0.001", "events"))
    path = str(tmp_path / "arch")
    write_archive(ev, path, width_ms=86_400_000, writers=None)
    a = read_archive(spark, path)
    assert a.count() == ev.count()
    assert a.select("bucket").distinct().count() == ev.select(
        (F.col("createdAt") - F.col("createdAt") % 86_400_000).alias("b")).distinct().count()

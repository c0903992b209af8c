"""Named queries over the driver tables, each with its DuckDB oracle.

Every query reads whole tables (no id subsets, no row caps). Output columns
are aliased identically on both sides; window bounds are epoch
milliseconds, doubles are rounded to 6 places where a closed form and a
recursion may differ in the last bits.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.tagging import track_filter, with_dominant_tag
from ..functions.text import utf16_length, words_per_post
from ..functions.json import normalise, quarantined, valid_posts
from ..functions.time import bucket_ms
from ..functions.numbers import java_int
from ..operators import compare, predict, stats
from ..operators.slices import SLICE, sliced
from ..session import scratch_path, utc
from ..sinks.archive import stream_archive_sink, write_archive
from ..sinks.documents import LAYOUTS, STAT_INDEX, comparison_documents, stream_documents, to_documents
from ..sinks.reports import REPORTS, write_reports
from ..sources.posts import archive_lines, archive_posts, live_posts, live_raw, read_archive, stream_archive
from ..sources.tables import document_posts, event_posts, event_raw_posts, table
from ..streaming.live import live_stats, live_word_count, start_compare, start_compare_feed, start_stat_documents, write_history
from ..streaming.predictors import start_bucketed
from ..streaming.sessions import start_sessions
from ..streaming.runner import materialise_stream, run_stream
from ..vocab import (ARCHIVE_BUCKET_MS, DOCUMENT_TAGS, EVENT_TAGS, EWMA_RATE, MODEL_NAMES, REGRESSION_WARMUP,
                     SMA_RING, STAT_NAMES)
from .sqlparts import (sql_dominant_tag, sql_int, sql_k, sql_max_word_length, sql_stop_list,
                       sql_str, sql_tokens, sql_utf16_length, sql_words_per_post)

# Parameters of the registered queries. The reference's live windows are
# 30 s / 60 s over a dense feed; the driver's events are minutes apart, so the
# windows are scaled up to keep several rows per window.
STAT_WINDOW = "1 hour"
STAT_WINDOW_MS = 3_600_000
SESSION_GAP = "10 minutes"
SESSION_GAP_US = 600_000_000
TRACK_TERMS = ("which", "there")
ORDER = ("t", "id")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            with utc(spark):
                return fn(spark, sf)
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _docs(spark, sf):
    return document_posts(table(spark, sf, "documents"))


def _events(spark, sf):
    return event_posts(table(spark, sf, "events"))


def _ms(col: str):
    return F.unix_millis(F.col(col)).alias(col)


# --------------------------------------------------------------- SQL bases
DOC_TEXTS = "doc_texts AS (SELECT doc_id AS id, text FROM documents)"
DOC_POSTS = (f"doc_posts AS (SELECT doc_id AS id, text, {sql_dominant_tag('text', DOCUMENT_TAGS)} AS tag "
             f"FROM documents WHERE lang = 'en')")
EV_POSTS = (f"ev AS (SELECT event_type AS tag, event_id AS id, props AS text, ts, "
            f"epoch_us(ts) AS us, epoch_us(ts) // 1000 AS ms, {sql_int('value')} AS followers, "
            f"{sql_k()} AS k, CAST(user_id AS INTEGER) AS statuses FROM events)")
EV_MEASURES = (f"evm AS (SELECT *, {sql_max_word_length('text')} AS mwl, {sql_words_per_post('text')} AS words, "
               f"{sql_utf16_length('text')} AS len FROM ev)")


# --------------------------------------------------------------- T2 / T4
@register("dominant_tag", f"SELECT doc_id, {sql_dominant_tag('text', DOCUMENT_TAGS)} AS tag FROM documents")
def q_dominant_tag(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return with_dominant_tag(d, "text", DOCUMENT_TAGS).select("doc_id", "tag")


@register("track_filter", "SELECT doc_id FROM documents WHERE "
          + " OR ".join(f"contains(lower(text), {sql_str(t)})" for t in TRACK_TERMS))
def q_track_filter(spark, sf):
    d = table(spark, sf, "documents")
    return d.where(track_filter("text", TRACK_TERMS)).select("doc_id")


# --------------------------------------------------------------- M1 / A1
@register("word_count", f"""WITH {DOC_POSTS}
SELECT tag, word, count(*) AS n FROM (SELECT tag, unnest({sql_tokens('text')}) AS word FROM doc_posts)
WHERE word <> '' AND word NOT IN ({sql_stop_list()}) GROUP BY tag, word""")
def q_word_count(spark, sf):
    return stats.word_count(_docs(spark, sf))


# --------------------------------------------------------------- M3 / M4
# Row measures run over the documents of all languages: accents and umlauts are where word splitting differs.
@register("words_per_post", f"""WITH {DOC_TEXTS}
SELECT id, {sql_words_per_post('text')} AS value FROM doc_texts WHERE {sql_words_per_post('text')} IS NOT NULL""")
def q_words_per_post(spark, sf):
    p = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), words_per_post("text").alias("value"))
    return p.where(F.col("value").isNotNull())


@register("text_length", f"""WITH {DOC_TEXTS}
SELECT id, {sql_utf16_length('text')} AS value FROM doc_texts WHERE {sql_utf16_length('text')} IS NOT NULL""")
def q_text_length(spark, sf):
    p = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), utf16_length("text").alias("value"))
    return p.where(F.col("value").isNotNull())


# --------------------------------------------------------------- A2-A6
@register("max_word_length", f"""WITH {DOC_POSTS}
SELECT tag, CAST(max(length(w)) AS INTEGER) AS value
FROM (SELECT tag, unnest({sql_tokens('text')}) AS w FROM doc_posts) WHERE w <> '' GROUP BY tag""")
def q_max_word_length(spark, sf):
    return stats.single_stat(_docs(spark, sf), "max_word_length")


@register("int_avg_words", f"""WITH {DOC_POSTS}
SELECT tag, CAST(sum(v) // count(v) AS INTEGER) AS value
FROM (SELECT tag, {sql_words_per_post('text')} AS v FROM doc_posts) WHERE v IS NOT NULL GROUP BY tag""")
def q_int_avg_words(spark, sf):
    return stats.single_stat(_docs(spark, sf), "avg_words")


@register("int_avg_length", f"""WITH {DOC_POSTS}
SELECT tag, CAST(sum(v) // count(v) AS INTEGER) AS value
FROM (SELECT tag, {sql_utf16_length('text')} AS v FROM doc_posts) WHERE v IS NOT NULL GROUP BY tag""")
def q_int_avg_length(spark, sf):
    return stats.single_stat(_docs(spark, sf), "avg_length")


@register("int_avg_followers", f"""WITH {EV_POSTS}
SELECT tag, CAST(sum(followers) // count(*) AS INTEGER) AS value FROM ev GROUP BY tag""")
def q_int_avg_followers(spark, sf):
    return stats.single_stat(_events(spark, sf), "avg_followers")


@register("int_avg_reretweets", f"""WITH {EV_POSTS}
SELECT tag, CAST(sum(k) // count(*) AS INTEGER) AS value FROM ev GROUP BY tag""")
def q_int_avg_reretweets(spark, sf):
    return stats.single_stat(_events(spark, sf), "avg_reretweets")


@register("historic_stats", f"""WITH {EV_POSTS}, {EV_MEASURES}
SELECT tag, max(mwl) AS max_word_length,
  CAST(sum(words) // count(words) AS INTEGER) AS avg_words,
  CAST(sum(len) // count(len) AS INTEGER) AS avg_length,
  CAST(sum(followers) // count(*) AS INTEGER) AS avg_followers,
  CAST(sum(k) // count(*) AS INTEGER) AS avg_reretweets
FROM evm GROUP BY tag""")
def q_historic_stats(spark, sf):
    return stats.historic_stats(_events(spark, sf))


@register("historic_stats_documents", f"""WITH {DOC_POSTS}, m AS (SELECT tag, {sql_max_word_length('text')} AS mwl,
  {sql_words_per_post('text')} AS words, {sql_utf16_length('text')} AS len FROM doc_posts)
SELECT tag, max(mwl) AS max_word_length, CAST(sum(words) // count(words) AS INTEGER) AS avg_words,
  CAST(sum(len) // count(len) AS INTEGER) AS avg_length, 0 AS avg_followers, 0 AS avg_reretweets
FROM m GROUP BY tag""")
def q_historic_stats_documents(spark, sf):
    return stats.historic_stats(_docs(spark, sf))


# --------------------------------------------------------------- T1, T5-T8, K1 key
PARSE_SQL = f"""WITH {EV_POSTS}, s AS (SELECT *, date_trunc('second', ts) AS ts_s FROM ev)
SELECT id, tag, event_type || ' ' || props AS text, 'user' || CAST(e.user_id AS VARCHAR) AS username,
  followers AS followersCount, statuses AS statusesCount, 0 AS favouritesCount, k AS retweetCount,
  epoch_ms(ts_s) AS createdAt, strftime(ts_s, '%B %d %Y, %H:%M:%S.%g') AS timestamp,
  CASE WHEN k % 2 = 1 THEN id + 1 ELSE 0 END AS retweet_id,
  CASE WHEN k % 2 = 1 THEN k ELSE 0 END AS retweet_retweetCount,
  CASE WHEN k % 2 = 1 THEN followers ELSE 0 END AS retweet_followersCount,
  CASE WHEN k % 2 = 1 THEN statuses ELSE 0 END AS retweet_statusesCount,
  CASE WHEN k % 2 = 1 THEN epoch_ms(ts_s) ELSE 0 END AS retweet_createdAt
FROM s JOIN events e ON e.event_id = s.id"""


@register("parse_post", PARSE_SQL)
def q_parse_post(spark, sf):
    raw = event_raw_posts(table(spark, sf, "events"))
    p = valid_posts(normalise(raw, tags=EVENT_TAGS))
    return p.select("id", "tag", "text", "username", "followersCount", "statusesCount",
                    "favouritesCount", "retweetCount", "createdAt", "timestamp",
                    F.col("retweet.id").alias("retweet_id"),
                    F.col("retweet.retweetCount").alias("retweet_retweetCount"),
                    F.col("retweet.followersCount").alias("retweet_followersCount"),
                    F.col("retweet.statusesCount").alias("retweet_statusesCount"),
                    F.col("retweet.createdAt").alias("retweet_createdAt"))


# Every document text fed through the post parser as a raw feed line: texts
# that are not JSON objects are quarantined as malformed (none of the driver's
# texts is JSON), with the document id carried through.
@register("quarantine_documents", """SELECT doc_id, 'malformed json' AS error FROM documents
WHERE NOT coalesce(json_type(TRY_CAST(text AS JSON)) = 'OBJECT', false)""")
def q_quarantine_documents(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("text").alias("value"))
    return quarantined(normalise(d, keep=["doc_id"], tags=DOCUMENT_TAGS)).select("doc_id", "error")


@register("time_bucket", f"""WITH {EV_POSTS}
SELECT id, ms - ms % {ARCHIVE_BUCKET_MS} AS bucket, strftime(ts, '%B %d %Y, %H:%M:%S.%g') AS timestamp FROM ev""")
def q_time_bucket(spark, sf):
    e = _events(spark, sf)
    return e.select("id", bucket_ms("createdAt").alias("bucket"), "timestamp")


# --------------------------------------------------------------- W1-W12
def _round6(cols):
    return [F.round(c, 6).alias(c) for c in cols]


@register("tumbling_stats", f"""WITH {EV_POSTS}, {EV_MEASURES}
SELECT ms - ms % {STAT_WINDOW_MS} AS window_start, tag, max(mwl) AS max_word_length,
  round(avg(words), 6) AS avg_words, round(avg(len), 6) AS avg_length,
  round(avg(followers), 6) AS avg_followers, round(avg(k), 6) AS avg_reretweets
FROM evm GROUP BY 1, 2""")
def q_tumbling_stats(spark, sf):
    w = stats.windowed_stats(_events(spark, sf), "t", window=STAT_WINDOW)
    return w.select(_ms("window_start"), "tag", "max_word_length",
                    *_round6(["avg_words", "avg_length", "avg_followers", "avg_reretweets"]))


@register("tumbling_word_count", f"""WITH {EV_POSTS}
SELECT ms - ms % {STAT_WINDOW_MS} AS window_start, tag, word, count(*) AS n
FROM (SELECT ms, tag, unnest({sql_tokens('text')}) AS word FROM ev)
WHERE word <> '' AND word NOT IN ({sql_stop_list()}) GROUP BY 1, 2, 3""")
def q_tumbling_word_count(spark, sf):
    w = stats.windowed_word_count(_events(spark, sf), "t", window=STAT_WINDOW)
    return w.select(_ms("window_start"), "tag", "word", "n")


SESSION_SQL = f"""WITH {EV_POSTS}, {EV_MEASURES},
g AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY tag ORDER BY us) <= {SESSION_GAP_US} THEN 0 ELSE 1 END AS brk FROM evm),
s AS (SELECT *, sum(brk) OVER (PARTITION BY tag ORDER BY us ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT min(us) // 1000 AS window_start, (max(us) + {SESSION_GAP_US}) // 1000 AS window_end, tag,
  max(mwl) AS max_word_length, round(avg(words), 6) AS avg_words, round(avg(len), 6) AS avg_length,
  round(avg(followers), 6) AS avg_followers, round(avg(k), 6) AS avg_reretweets
FROM s GROUP BY tag, sid"""


def _session_columns(w):
    return w.select(_ms("window_start"), _ms("window_end"), "tag", "max_word_length",
                    *_round6(["avg_words", "avg_length", "avg_followers", "avg_reretweets"]))


@register("session_stats", SESSION_SQL)
def q_session_stats(spark, sf):
    rows = sliced(_events(spark, sf), "tag", ["t"])
    return _session_columns(stats.windowed_stats(rows, "t", session_gap=SESSION_GAP, session_bucket=F.col(SLICE)))


# A caller's own measures: name -> (column, aggregate), in the same windows.
@register("own_measures", f"""WITH {EV_POSTS}
SELECT ms - ms % {STAT_WINDOW_MS} AS window_start, tag, max(length(text)) AS longest, min(followers) AS fewest,
  round(avg(CASE WHEN k > 0 THEN statuses END), 6) AS sharing_statuses FROM ev GROUP BY 1, 2""")
def q_own_measures(spark, sf):
    own = {"longest": (F.length("text").cast("bigint"), "max"), "fewest": (F.col("followersCount"), "min"),
           "sharing_statuses": (F.when(F.col("retweetCount") > 0, F.col("statusesCount")), "avg")}
    w = stats.windowed_stats(_events(spark, sf), "t", window=STAT_WINDOW, measures=own)
    return w.select(_ms("window_start"), "tag", "longest", "fewest", F.round("sharing_statuses", 6).alias("sharing_statuses"))


# --------------------------------------------------------------- J1-J3
_J_PARTS = {
    "max_word_length": "mwl", "avg_words": "words", "avg_length": "len",
    "avg_followers": "followers", "avg_reretweets": "k",
}


def _compare_sql() -> str:
    live = ", ".join(
        (f"CAST(max({c}) AS DOUBLE) AS {m}" if m == "max_word_length" else f"avg({c}) AS {m}")
        for m, c in _J_PARTS.items())
    parts = []
    for m in _J_PARTS:
        parts.append(f"SELECT {sql_str(STAT_NAMES[m])} AS name, l.window_start, l.tag, "
                     f"round(h.{m} - l.{m}, 6) AS diff FROM live l JOIN hist h ON h.tag = l.tag "
                     f"WHERE l.{m} IS NOT NULL AND h.{m} IS NOT NULL")
    return (f"WITH {EV_POSTS}, {EV_MEASURES},\n"
            f"live AS (SELECT ms - ms % {STAT_WINDOW_MS} AS window_start, tag, {live} FROM evm GROUP BY 1, 2),\n"
            f"hist AS (SELECT tag, {live} FROM evm GROUP BY tag)\n" + "\nUNION ALL\n".join(parts))


@register("live_vs_historic", _compare_sql())
def q_live_vs_historic(spark, sf):
    posts = _events(spark, sf)
    live = stats.windowed_stats(posts, "t", window=STAT_WINDOW)
    hist = compare.archive_averages(posts)
    j = compare.live_vs_historic(live, hist)
    return j.select("name", _ms("window_start"), "tag", F.round("diff", 6).alias("diff"))


# --------------------------------------------------------------- P1-P6
def _ewma_sql() -> str:
    return f"""WITH RECURSIVE p AS (
  SELECT event_type AS tag, event_id, CAST({sql_int('value')} AS DOUBLE) AS x,
         row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events),
r(tag, rn, event_id, x, v) AS (
  SELECT tag, rn, event_id, x, CAST(0 AS DOUBLE) FROM p WHERE rn = 1
  UNION ALL
  SELECT p.tag, p.rn, p.event_id, p.x, r.v + CAST({EWMA_RATE} AS DOUBLE) * (r.x - r.v)
  FROM r JOIN p ON p.tag = r.tag AND p.rn = r.rn + 1)
SELECT event_id, tag, round(v, 6) AS predicted_value, CAST(trunc(round(v, 6)) AS INTEGER) AS predicted, CAST(x AS INTEGER) AS real FROM r"""


def _ewma_columns(p):
    # the emitted integer is read off the rounded value, as a closed form and a recursion may differ in the last bits
    v = F.round("predicted_value", 6)
    return p.select(F.col("id").alias("event_id"), "tag", v.alias("predicted_value"), java_int(v).alias("predicted"), "real")


@register("predict_ewma", _ewma_sql())
def q_predict_ewma(spark, sf):
    rows = sliced(_events(spark, sf), "tag", ORDER)
    return _ewma_columns(predict.ewma_predict(rows, "tag", ORDER, "followersCount", bucket=SLICE, keep=("id",)))


def _regression_sql(x: str) -> str:
    w = "OVER (PARTITION BY tag ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    pred = (f"CASE WHEN sxx = 0 THEN -1 ELSE CAST(trunc(greatest(least("
            f"(CAST(sxy AS DOUBLE) / CAST(sxx AS DOUBLE)) * CAST(x AS DOUBLE), 2147483647), -2147483648)) AS INTEGER) END")
    return f"""WITH p AS (SELECT event_type AS tag, event_id, ts, CAST({x} AS HUGEINT) AS x,
  CAST({sql_int('value')} AS HUGEINT) AS y FROM events WHERE event_id <> 0),
w AS (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY ts, event_id) AS rn,
  coalesce(sum(x * y) {w}, 0) AS sxy, coalesce(sum(x * x) {w}, 0) AS sxx FROM p)
SELECT event_id, tag, {pred} AS predicted, CAST(y AS INTEGER) AS real FROM w WHERE rn > {REGRESSION_WARMUP}"""


def _regression(pairs):
    rows = sliced(pairs, "tag", ORDER)
    p = predict.regression_predict(rows, "tag", ORDER, "x", "y", bucket=SLICE, keep=("id",))
    return p.select(F.col("id").alias("event_id"), "tag", "predicted", "real")


@register("predict_regression_retweets", _regression_sql(sql_k()))
def q_predict_regression_retweets(spark, sf):
    return _regression(stats.retweet_pairs(_events(spark, sf)))     # M7


@register("predict_regression_followers", _regression_sql("user_id"))
def q_predict_regression_followers(spark, sf):
    return _regression(stats.status_pairs(_events(spark, sf)))      # M8


def _sma_sql() -> str:
    return f"""SELECT event_id, event_type AS tag,
  CAST(trunc(CAST(coalesce(sum({sql_int('value')}) OVER (PARTITION BY event_type ORDER BY ts, event_id
    ROWS BETWEEN {SMA_RING} PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) / {SMA_RING}.0) AS INTEGER) AS predicted,
  {sql_int('value')} AS real FROM events"""


@register("predict_sma", _sma_sql())
def q_predict_sma(spark, sf):
    rows = sliced(_events(spark, sf), "tag", ORDER)
    p = predict.sma_predict(rows, "tag", ORDER, "followersCount", bucket=SLICE, keep=("id",))
    return p.select(F.col("id").alias("event_id"), "tag", "predicted", "real")


# --------------------------------------------------------------- K1 + S2/S4
ARCHIVE_SQL = f"""WITH {EV_POSTS}
SELECT id, tag, text, followers AS followersCount, statuses AS statusesCount, k AS retweetCount, ms AS createdAt,
  strftime(ts, '%B %d %Y, %H:%M:%S.%g') AS timestamp, id AS retweet_id, k AS retweet_retweetCount,
  ms - ms % {ARCHIVE_BUCKET_MS} AS bucket FROM ev"""


def _archive_columns(a):
    return a.select("id", "tag", "text", "followersCount", "statusesCount", "retweetCount", "createdAt",
                    "timestamp", F.col("retweet.id").alias("retweet_id"),
                    F.col("retweet.retweetCount").alias("retweet_retweetCount"),
                    bucket_ms("createdAt").alias("bucket"))


@register("archive_roundtrip", ARCHIVE_SQL)
def q_archive_roundtrip(spark, sf):
    path = scratch_path(spark, "archive")
    write_archive(_events(spark, sf), path)
    a = read_archive(spark, path)
    return _archive_columns(a.where(F.col("bucket").cast("bigint") == bucket_ms("createdAt")))


@register("archive_stream", ARCHIVE_SQL)
def q_archive_stream(spark, sf):
    """S3 over K1's streaming form: the events archived by a stream in turns, read back as a stream."""
    base = scratch_path(spark, "archive_stream")
    in_turns(spark, sf, base, lambda s: stream_archive_sink(event_posts(s), f"{base}/archive", f"{base}/ck", width_ms=DAY_MS, trigger=ONCE),
             marker=False)
    return _archive_columns(materialise_stream(spark, stream_archive(spark, f"{base}/archive"), None, "archive_read", output_mode="append"))


@register("csv_reports", "WITH " + EV_POSTS + ", " + EV_MEASURES + """, h AS (SELECT tag, max(mwl) AS a,
  CAST(sum(words) // count(words) AS INTEGER) AS b, CAST(sum(len) // count(len) AS INTEGER) AS c,
  CAST(sum(followers) // count(*) AS INTEGER) AS d, CAST(sum(k) // count(*) AS INTEGER) AS e FROM evm GROUP BY tag)
SELECT 'maxWordLength' AS report, tag, a AS value FROM h WHERE a IS NOT NULL UNION ALL
SELECT 'avgWordbyTweet', tag, b FROM h WHERE b IS NOT NULL UNION ALL SELECT 'avgTweetlength', tag, c FROM h WHERE c IS NOT NULL UNION ALL
SELECT 'avgFollower', tag, d FROM h UNION ALL SELECT 'avgRetweets', tag, e FROM h UNION ALL
SELECT 'wordcount', tag || ' ' || word, count(*) FROM (SELECT tag, unnest(""" + sql_tokens("text") + """) AS word FROM ev)
WHERE word <> '' AND word NOT IN (""" + sql_stop_list() + ") GROUP BY tag, word")
def q_csv_reports(spark, sf):
    """K2: the six result sets written as CSV and read back."""
    run = write_reports(_events(spark, sf), scratch_path(spark, "reports_out"), run_ms=1)
    sets = [spark.read.csv(f"{run}/{name}", schema="value int, tag string").select(F.lit(name).alias("report"), "tag", F.col("value").cast("bigint"))
            for name in REPORTS]
    words = spark.read.csv(f"{run}/wordcount", schema="word string, n bigint, tag string")
    out = words.select(F.lit("wordcount").alias("report"), F.concat_ws(" ", "tag", "word").alias("tag"), F.col("n").alias("value"))
    return functools.reduce(lambda a, b: a.union(b), sets, out)


# --------------------------------------------------------------- streaming forms
# Every stream reads the events in three turns of ascending time: each turn's
# files are written, then the query is started again on its checkpoint, so
# state crosses micro-batches and restarts. A marker row a week after the last event
# then closes all event-time windows; its own never closes.
ONCE = {"availableNow": True}
TURNS = 3
MARKER = "__end__"
DAY_MS = 86_400_000
FEED_ROWS = 100_000   # rows of a file of the feed: a turn that one task writes is still read by many


def in_turns(spark, sf, base, start, marker=True, side=None):
    """``start`` of the feed, turn by turn; with ``side``, rows with a time ``at`` that arrive in the same turns, ``start`` gets their feed too."""
    events = table(spark, sf, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = events.agg(F.percentile_approx(micros, [k / TURNS for k in range(1, TURNS)])).first()[0]
    turn = functools.reduce(lambda a, c: a + (micros > c).cast("int"), cuts or [], F.lit(0))
    parts = [events.where(turn == k) for k in range(TURNS)]
    if marker:
        last = events.agg(F.max("ts").alias("ts"))
        kinds = {f.name: f.dataType for f in events.schema.fields}
        values = {"event_id": F.lit(-1), "event_type": F.lit(MARKER), "ts": F.col("ts") + F.expr("INTERVAL 7 DAYS"), "props": F.lit("{}")}
        parts.append(last.select(*[values.get(n, F.lit(0)).cast(t).alias(n) for n, t in kinds.items()]))
    read = lambda schema, name: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{base}/{name}")
    if side is not None:
        at = F.unix_micros("at")
        side_turn = functools.reduce(lambda a, c: a + (at > c).cast("int"), cuts or [], F.lit(0))
    for k, part in enumerate(parts):
        part.write.option("maxRecordsPerFile", FEED_ROWS).parquet(f"{base}/feed/turn={k}")
        if side is not None:
            side.where(side_turn == k).write.option("maxRecordsPerFile", FEED_ROWS).parquet(f"{base}/side/turn={k}")
        q = start(read(events.schema, "feed"), *([] if side is None else [read(side.schema, "side")]))
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()


def _stream_rows(spark, sf, name, make, output_mode="append"):
    """All rows that ``make`` of the event posts emits over the turns."""
    base = scratch_path(spark, name)
    in_turns(spark, sf, base, lambda s: run_stream(make(event_posts(s)), f"{base}/out", f"{base}/checkpoint", output_mode))
    return spark.read.parquet(f"{base}/out").drop("_batch")


@register("stream_tumbling_stats", ORACLE["tumbling_stats"])
def q_stream_tumbling_stats(spark, sf):
    out = _stream_rows(spark, sf, "stream_tumbling_stats", lambda p: live_stats(p, window=STAT_WINDOW, watermark="1 hour"))
    return out.select(_ms("window_start"), "tag", "max_word_length",
                      *_round6(["avg_words", "avg_length", "avg_followers", "avg_reretweets"]))


@register("stream_session_stats", SESSION_SQL)
def q_stream_session_stats(spark, sf):
    base = scratch_path(spark, "stream_session_stats")
    in_turns(spark, sf, base, lambda s: start_sessions(event_posts(s), f"{base}/out", f"{base}/state", f"{base}/checkpoint",
                                                       gap=SESSION_GAP, watermark="1 hour", trigger=ONCE))
    return _session_columns(spark.read.parquet(f"{base}/out"))


@register("stream_word_count", ORACLE["tumbling_word_count"])
def q_stream_word_count(spark, sf):
    out = _stream_rows(spark, sf, "stream_word_count", lambda p: live_word_count(p, window=STAT_WINDOW, watermark="1 hour"))
    return out.select(_ms("window_start"), "tag", "word", "n")


@register("ingest_windows", "SELECT event_type AS tag, count(*) AS n FROM events GROUP BY 1")
def q_ingest_windows(spark, sf):
    """Rows windowed by their arrival; the stamp is the clock, so the windows are added up per tag."""
    counted = {"n": (F.lit(1), "count")}
    out = _stream_rows(spark, sf, "ingest_windows", lambda p: stats.windowed_stats(
        p.withColumn("t", F.current_timestamp()).withWatermark("t", "1 minute"), "t", window="30 seconds", measures=counted), output_mode="update")
    latest = out.groupBy("window_start", "tag").agg(F.max("n").alias("n"))
    return latest.where(F.col("tag") != MARKER).groupBy("tag").agg(F.sum("n").cast("bigint").alias("n"))


# --------------------------------------------------------------- documents K3-K6
@register("post_documents", ARCHIVE_SQL.replace(f"ms - ms % {ARCHIVE_BUCKET_MS} AS bucket", "true AS \"isEnglish\""))
def q_post_documents(spark, sf):
    base = scratch_path(spark, "post_documents")
    in_turns(spark, sf, base, lambda s: stream_documents(to_documents(event_posts(s), "twitter"), f"{base}/twitter", f"{base}/ck", trigger=ONCE), marker=False)
    d = archive_posts(archive_lines(spark.read.text(f"{base}/twitter").select("value")))
    return _archive_columns(d).drop("bucket").withColumn("isEnglish", F.lit(True))


_STAT_DOCS = {"max_word_length": "CAST(max(mwl) AS DOUBLE)", "avg_length": "avg(len)", "avg_followers": "avg(followers)",
              "avg_reretweets": "avg(k)", "avg_words": "avg(words)"}


@register("stat_documents", f"WITH {EV_POSTS}, {EV_MEASURES} " + " UNION ALL ".join(
    f"SELECT {sql_str(STAT_INDEX[m])} AS index, tag, round({c}, 6) AS value, true AS stamped FROM evm "
    f"GROUP BY ms - ms % {STAT_WINDOW_MS}, tag HAVING {c} IS NOT NULL" for m, c in _STAT_DOCS.items()))
def q_stat_documents(spark, sf):
    """K4: one document per closed window and tag in each index."""
    base = scratch_path(spark, "stat_documents")
    in_turns(spark, sf, base, lambda s: start_stat_documents(spark, live_stats(event_posts(s), window=STAT_WINDOW, watermark="1 hour"),
                                                             f"{base}/docs", f"{base}/ck", trigger=ONCE))
    sets = []
    for index in STAT_INDEX.values():
        value, tag, stamp = (dst for _, dst in LAYOUTS[index])
        d = spark.read.schema(f"`{value}` double, `{tag}` string, `{stamp}` bigint").json(f"{base}/docs/{index}")
        sets.append(d.select(F.lit(index).alias("index"), F.col(tag).alias("tag"), F.round(value, 6).alias("value"), (F.col(stamp) > 0).alias("stamped")))
    return functools.reduce(lambda a, b: a.union(b), sets)


def _history(spark, sf, base):
    write_history(compare.archive_averages(_events(spark, sf)), f"{base}/historic")
    return f"{base}/historic"


def _compare_stream(spark, sf, base, **how):
    history = _history(spark, sf, base)
    in_turns(spark, sf, base, lambda s: start_compare(live_stats(event_posts(s), window=STAT_WINDOW, watermark="1 hour"), history,
                                                      f"{base}/out", f"{base}/checkpoint", trigger=ONCE, **how))


@register("stream_live_vs_historic", ORACLE["live_vs_historic"])
def q_stream_live_vs_historic(spark, sf):
    base = scratch_path(spark, "stream_compare")
    _compare_stream(spark, sf, base)
    return spark.read.parquet(f"{base}/out").select("name", _ms("window_start"), "tag", F.round("diff", 6).alias("diff"))


FEED_MEASURES = ("avg_followers", "avg_reretweets")
DAY_US = 86_400_000_000


@register("stream_history_feed", f"""WITH {EV_POSTS},
live AS (SELECT ms - ms % {STAT_WINDOW_MS} AS window_start, tag, avg(followers) AS avg_followers, avg(k) AS avg_reretweets FROM ev GROUP BY 1, 2),
daily AS (SELECT tag, us - us % {DAY_US} AS day, sum(followers) AS f, sum(k) AS k, count(*) AS n FROM ev GROUP BY 1, 2),
past AS (SELECT tag, day, sum(f) OVER w AS f, sum(k) OVER w AS k, sum(n) OVER w AS n FROM daily
  WINDOW w AS (PARTITION BY tag ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
hist AS (SELECT tag, day, f / n AS avg_followers, k / n AS avg_reretweets FROM past WHERE n > 0),
j AS (SELECT l.tag, l.window_start, h.avg_followers - l.avg_followers AS f, h.avg_reretweets - l.avg_reretweets AS k
  FROM live l ASOF JOIN hist h ON l.tag = h.tag AND (l.window_start + {STAT_WINDOW_MS}) * 1000 >= h.day)
SELECT {sql_str(STAT_NAMES['avg_followers'])} AS name, window_start, tag, round(f, 6) AS diff FROM j UNION ALL
SELECT {sql_str(STAT_NAMES['avg_reretweets'])}, window_start, tag, round(k, 6) FROM j""")
def q_stream_history_feed(spark, sf):
    """J1 with history that streams in: at each day's start a tag's averages over all earlier days; a window takes the latest before its end."""
    base = scratch_path(spark, "stream_history")
    m, _ = stats.measured(_events(spark, sf), FEED_MEASURES)
    day = F.timestamp_micros(F.floor(F.unix_micros("t") / DAY_US).cast("bigint") * DAY_US)
    daily = m.groupBy("tag", day.alias("at")).agg(F.sum("m_followers").alias("f"), F.sum("m_reretweets").alias("k"), F.count("*").alias("n"))
    before = W.partitionBy("tag").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    past = daily.select("tag", "at", *[F.sum(c).over(before).alias(c) for c in ("f", "k", "n")]).where("n > 0")
    history = past.select("tag", "at", (F.col("f") / F.col("n")).alias("avg_followers"), (F.col("k") / F.col("n")).alias("avg_reretweets"))
    in_turns(spark, sf, base, lambda s, h: start_compare_feed(live_stats(event_posts(s), window=STAT_WINDOW, watermark="1 hour"), h, f"{base}/out", f"{base}/state",
                                                              f"{base}/checkpoint", measures=FEED_MEASURES, trigger=ONCE), side=history)
    return spark.read.parquet(f"{base}/out").select("name", _ms("window_start"), "tag", F.round("diff", 6).alias("diff"))


@register("comparison_documents", f"""SELECT name, tag, diff, name = {sql_str(STAT_NAMES['max_word_length'])} AS is_int, true AS stamped
FROM ({ORACLE['live_vs_historic']}) d""")
def q_comparison_documents(spark, sf):
    """One document per closed window, tag and statistic; the maximum's number is an integer."""
    base = scratch_path(spark, "compare_documents")
    _compare_stream(spark, sf, base, shape=comparison_documents, fmt="documents")
    d = spark.read.text(f"{base}/out").select(F.from_json("value", "comparedata string, comparedata_tag string, comparedata_name string, comparedata_timestamp bigint").alias("d")).select("d.*")
    return d.select(F.col("comparedata_name").alias("name"), F.col("comparedata_tag").alias("tag"), F.round(F.col("comparedata").cast("double"), 6).alias("diff"),
                    F.col("comparedata").rlike("^-?[0-9]+$").alias("is_int"), (F.col("comparedata_timestamp") > 0).alias("stamped"))


# --------------------------------------------------------------- P5: predictors on streams
def _stream_predict(spark, sf, kind, posts=lambda p: p, shape=None, schema=None, **how):
    base = scratch_path(spark, f"stream_{kind}")
    in_turns(spark, sf, base, lambda s: start_bucketed(posts(event_posts(s)), kind, f"{base}/out", f"{base}/state", f"{base}/checkpoint",
                                                       trigger=ONCE, shape=shape, **how), marker=False)
    return spark.read.schema(schema).json(f"{base}/out") if schema else spark.read.parquet(f"{base}/out")


def _emitted(out):
    return out.select(F.col("id").alias("event_id"), "tag", "predicted", "real")


@register("stream_predict_ewma", ORACLE["predict_ewma"])
def q_stream_predict_ewma(spark, sf):
    return _ewma_columns(_stream_predict(spark, sf, "ewma", value="followersCount"))


@register("stream_predict_sma", ORACLE["predict_sma"])
def q_stream_predict_sma(spark, sf):
    return _emitted(_stream_predict(spark, sf, "sma", value="followersCount"))


@register("stream_predict_regression_retweets", ORACLE["predict_regression_retweets"])
def q_stream_predict_regression_retweets(spark, sf):
    return _emitted(_stream_predict(spark, sf, "regression", stats.retweet_pairs, x="x", y="y"))


@register("stream_predict_regression_followers", ORACLE["predict_regression_followers"])
def q_stream_predict_regression_followers(spark, sf):
    return _emitted(_stream_predict(spark, sf, "regression", stats.status_pairs, x="x", y="y"))


@register("prediction_documents", f"""SELECT predicted AS predictions_predicted, real AS predictions_real, tag AS predictions_tag,
  {sql_str(MODEL_NAMES['followers'])} AS predictions_name, true AS stamped FROM ({ORACLE['predict_regression_followers']}) d""")
def q_prediction_documents(spark, sf):
    """K6 with P6: the labelled predictions of a stream as documents."""
    out = _stream_predict(spark, sf, "regression", stats.status_pairs, x="x", y="y",
                          shape=lambda p: to_documents(predict.label(p, "followers"), "tw_predictions"), fmt="documents",
                          schema="predictions_predicted int, predictions_real int, predictions_tag string, predictions_name string, predictions_timestamp bigint")
    return out.select("predictions_predicted", "predictions_real", "predictions_tag", "predictions_name", (F.col("predictions_timestamp") > 0).alias("stamped"))


# --------------------------------------------------------------- S1 + T1: the raw feed, spoilt in five ways
_SPOIL = 7    # of seven neighbouring events, five are spoilt, each in its own way


def spoilt_feed(events):
    raw = event_raw_posts(events)
    v, way = F.col("value"), F.pmod(F.get_json_object("value", "$.id").cast("bigint"), F.lit(_SPOIL))
    created = r'"created_at":"[^"]*"'
    shared = F.get_json_object("value", "$.retweeted_status.id").isNotNull()
    inner = r'("retweeted_status":\{.*?)'
    bad = (F.when(way == 1, F.concat(F.lit("{broken "), v))
           .when(way == 2, F.regexp_replace(v, r'^(.*?)"user":\{[^}]*\}', '$1"user":null'))
           .when(way == 3, F.regexp_replace(v, r'^(.*?)' + created, '$1"created_at":"never"'))
           # a re-share that is there already is spoilt, other posts get a spoilt one
           .when((way == 4) & shared, F.regexp_replace(v, inner + r',"user":\{[^}]*\}', "$1"))
           .when(way == 4, F.regexp_replace(v, r'\}$', ',"retweeted_status":{"id":1,"created_at":"Tue Oct 22 20:33:43 +0000 2019"}}'))
           .when((way == 5) & shared, F.regexp_replace(v, inner + created, '$1"created_at":"never"'))
           .when(way == 5, F.regexp_replace(v, r'\}$', ',"retweeted_status":{"id":1,"user":{"name":"x"},"created_at":"never"}}')))
    return raw.select(F.coalesce(bad, v).alias("value"))


@register("live_feed", f"""WITH {EV_POSTS} SELECT CASE id % {_SPOIL} WHEN 1 THEN 'malformed json' WHEN 2 THEN 'no user object'
  WHEN 3 THEN 'bad created_at' WHEN 4 THEN 're-share without user' WHEN 5 THEN 're-share with bad created_at' ELSE 'good' END AS outcome,
  CASE WHEN id % {_SPOIL} = 1 THEN 0 ELSE id END AS id,
  CASE WHEN id % {_SPOIL} IN (0, 2, 3, 4, 5, 6) THEN k % 2 = 1 OR id % {_SPOIL} IN (4, 5) ELSE false END AS shared FROM ev""")
def q_live_feed(spark, sf):
    """Every raw post is either a record or quarantined, with its reason."""
    base = scratch_path(spark, "live_feed")
    spoilt_feed(table(spark, sf, "events")).write.text(f"{base}/feed")
    posts = live_posts(live_raw(spark, f"{base}/feed"), tags=EVENT_TAGS, with_errors=True)
    out = materialise_stream(spark, posts, None, "live_feed", output_mode="append")
    broken = F.col("error") == "malformed json"
    return out.select(F.coalesce("error", F.lit("good")).alias("outcome"), F.when(broken, 0).otherwise(F.col("id")).alias("id"),
                      F.when(broken, False).otherwise(F.col("retweet.id") != 0).alias("shared"))

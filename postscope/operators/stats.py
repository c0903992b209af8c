"""Per-tag statistics over posts: batch (historic) and windowed (live).

One function builds the per-post measures; the aggregates are then a single
``groupBy(...).agg(...)`` so that all statistics share one scan and one
exchange (partial aggregation runs map-side, so a hot tag costs one partial
row per task, not a hot reducer). The same code runs on batch and streaming
DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import INLINE_STOP_WORDS, max_word_length, utf16_length, without_stop_words, word_rows, words_per_post
from ..vocab import STOP_WORDS

MEASURES = ("max_word_length", "avg_words", "avg_length", "avg_followers", "avg_reretweets")


def with_measures(posts: DataFrame, text: str = "text") -> DataFrame:
    """Add the per-post measures M2-M6 as ``m_*`` columns (NULL = no row emitted)."""
    return posts.select(
        "*",
        max_word_length(text).alias("m_max_word_length"),
        words_per_post(text).alias("m_words"),
        utf16_length(text).alias("m_length"),
        F.col("followersCount").alias("m_followers"),
        F.col("retweet.retweetCount").alias("m_reretweets"),
    )


#: What a caller may pass as ``measures``: names out of :data:`MEASURES`, or
#: ``{name: (column, aggregate)}`` with an aggregate out of :data:`AGGREGATES`.
Measures = Sequence[str] | Mapping[str, tuple[Column, str]]
AGGREGATES = ("avg", "max", "min", "sum", "count")

_SOURCES = {"max_word_length": "m_max_word_length", "avg_words": "m_words", "avg_length": "m_length",
            "avg_followers": "m_followers", "avg_reretweets": "m_reretweets"}


def measured(posts: DataFrame, measures: Measures, text: str = "text") -> tuple[DataFrame, dict[str, tuple[str, str]]]:
    """``posts`` with one column per measure, and ``{name: (that column, aggregate)}``.
    A NULL measure of a row takes no part in its aggregate."""
    if isinstance(measures, Mapping):
        unknown = {a for _, a in measures.values()} - set(AGGREGATES)
        if unknown:
            raise ValueError(f"unknown aggregates {sorted(unknown)}")
        cols = [c.alias(f"m_{name}") for name, (c, _) in measures.items()]
        return posts.select("*", *cols), {name: (f"m_{name}", a) for name, (_, a) in measures.items()}
    aggregate = {name: "max" if name == "max_word_length" else "avg" for name in measures}
    return with_measures(posts, text), {name: (_SOURCES[name], aggregate[name]) for name in measures}


def aggregates(sources: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Averages as doubles, the other aggregates as they are."""
    return [getattr(F, a)(c).alias(name) for name, (c, a) in sources.items()]


def retweet_pairs(posts: DataFrame, keep: Sequence[str] = ("tag", "t", "id", "createdAt")) -> DataFrame:
    """M7: ``(x = re-share count, y = followers)`` of the re-shared post, only
    for posts that are re-shares (``retweet.id != 0``)."""
    keep = [c for c in keep if c in posts.columns]
    return posts.where(F.col("retweet.id") != 0).select(
        *keep, F.col("retweet.retweetCount").alias("x"), F.col("retweet.followersCount").alias("y"))


def status_pairs(posts: DataFrame, keep: Sequence[str] = ("tag", "t", "id", "createdAt")) -> DataFrame:
    """M8: ``(x = statuses, y = followers)`` of the author, only for ``id != 0``."""
    keep = [c for c in keep if c in posts.columns]
    return posts.where(F.col("id") != 0).select(
        *keep, F.col("statusesCount").alias("x"), F.col("followersCount").alias("y"))


def _int_avg_parts(col: str, name: str) -> list[Column]:
    return [F.sum(col).alias(f"_s_{name}"), F.count(col).alias(f"_c_{name}")]


def _int_avg(name: str) -> Column:
    # truncating integer average, as the batch reducers compute it
    return F.expr(f"cast(`_s_{name}` div nullif(`_c_{name}`, 0) as int)").alias(name)


def historic_stats(posts: DataFrame, keys: Sequence[str] = ("tag",), text: str = "text",
                   measures: Measures = MEASURES) -> DataFrame:
    """One pass, one exchange; averages truncate to int like the batch job."""
    m, sources = measured(posts, measures, text)
    aggs: list[Column] = []
    for name, (col, a) in sources.items():
        aggs += _int_avg_parts(col, name) if a == "avg" else [getattr(F, a)(col).alias(name)]
    g = m.groupBy(*keys).agg(*aggs)
    return g.select(*keys, *[_int_avg(name) if a == "avg" else F.col(name) for name, (_, a) in sources.items()])


def single_stat(posts: DataFrame, name: str, keys: Sequence[str] = ("tag",),
                text: str = "text") -> DataFrame:
    """One batch statistic as ``(keys..., value)``; groups without any row are absent."""
    df = historic_stats(posts, keys, text, measures=(name,))
    return df.where(F.col(name).isNotNull()).select(*keys, F.col(name).alias("value"))


def word_count(posts: DataFrame, keys: Sequence[str] = ("tag",), text: str = "text",
               stop_words: Sequence[str] | DataFrame = STOP_WORDS) -> DataFrame:
    """A1: occurrences per (keys, word) after stop-word removal. A long stop list meets the counted words, one row each, not every occurrence."""
    long = isinstance(stop_words, DataFrame) or len(stop_words) > INLINE_STOP_WORDS
    counted = word_rows(posts, text, keys, () if long else stop_words).groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))
    return without_stop_words(counted, stop_words) if long else counted


def _window_col(time_col: str, window: str | None, session_gap: str | None) -> Column:
    if (window is None) == (session_gap is None):
        raise ValueError("give exactly one of window= or session_gap=")
    if window is not None:
        return F.window(time_col, window).alias("w")
    return F.session_window(time_col, session_gap).alias("w")


def windowed_stats(posts: DataFrame, time_col: str = "t", window: str | None = None,
                   session_gap: str | None = None, keys: Sequence[str] = ("tag",),
                   text: str = "text", measures: Measures = MEASURES,
                   session_bucket: str | Column | None = None) -> DataFrame:
    """Tumbling (``window``) or session (``session_gap``) statistics.

    Averages are doubles (sum/count), the maximum is an int. Output:
    ``window_start, window_end, keys..., <measures>``. For batch sessions,
    ``session_bucket`` (the slice column of ``operators.slices``, or a duration
    like ``"1 day"``) switches to the sliced session finder
    (``operators.sessions``), which does not put a whole key into one
    task; the result is the same. ``measures`` may be the caller's own
    (:data:`Measures`).
    """
    m, sources = measured(posts, measures, text)
    aggs = aggregates(sources)
    if session_gap is not None and session_bucket is not None:
        from .sessions import session_groups
        return session_groups(m, keys, time_col, session_gap, aggs, session_bucket)
    g = m.groupBy(_window_col(time_col, window, session_gap), *keys).agg(*aggs)
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, *sources)


def windowed_word_count(posts: DataFrame, time_col: str = "t", window: str = "60 seconds",
                        keys: Sequence[str] = ("tag",), text: str = "text",
                        stop_words: Sequence[str] | DataFrame = STOP_WORDS) -> DataFrame:
    """Word count per tumbling window."""
    rows = word_rows(posts, text, [time_col, *keys], stop_words)
    g = rows.groupBy(F.window(time_col, window).alias("w"), *keys, "word").agg(
        F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, "word", "n")


def long_form(stats: DataFrame, ids: Sequence[str], measures: Measures = MEASURES) -> DataFrame:
    """Wide statistics -> ``(ids..., stat, value double)`` rows; NULL statistics are dropped."""
    vals = [F.col(m).cast("double").alias(m) for m in measures]
    wide = stats.select(*ids, *vals)
    return (wide.unpivot(list(ids), list(measures), "stat", "value")
            .where(F.col("value").isNotNull()))

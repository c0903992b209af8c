"""K2: the historic statistics as CSV result sets under ``<root>/<run ms>/<name>``."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stats import historic_stats, word_count
from ..session import scratch_path

# Result-set folder names and the statistic each holds.
REPORTS = {
    "avgWordbyTweet": "avg_words",
    "avgTweetlength": "avg_length",
    "avgRetweets": "avg_reretweets",
    "avgFollower": "avg_followers",
    "maxWordLength": "max_word_length",
}


def write_reports(posts: DataFrame, root: str, run_ms: int | None = None) -> str:
    """Write the six result sets; returns the run folder.

    The five per-tag statistics come from one aggregation of one row per tag. CSV without header, columns in the
    order ``value, tag`` (word count: ``word, n, tag``).
    """
    run = f"{root.rstrip('/')}/{run_ms if run_ms is not None else int(time.time() * 1000)}"
    # Both families read the same posts. The four fields they use (a small part
    # of a raw post) are staged once as parquet under the shared root, so the
    # archive is parsed once and each family scans only its own columns.
    narrow = posts.select("tag", "text", "followersCount",
                          F.struct(F.col("retweet.retweetCount").alias("retweetCount")).alias("retweet"))
    staged = scratch_path(posts.sparkSession, "reports")
    narrow.write.parquet(f"{staged}/posts")
    rows = posts.sparkSession.read.schema(narrow.schema).parquet(f"{staged}/posts")
    historic_stats(rows).write.parquet(f"{staged}/stats")     # one row per tag
    stats = posts.sparkSession.read.parquet(f"{staged}/stats")
    word_count(rows).select("word", "n", "tag").write.mode("errorifexists").csv(f"{run}/wordcount")
    for name, col in REPORTS.items():
        (stats.where(F.col(col).isNotNull()).select(F.col(col).alias("value"), "tag")
         .write.mode("errorifexists").csv(f"{run}/{name}"))
    return run

"""Post-shaped DataFrames derived from the driver's tables.

No driver table holds social posts, so the library's operators run on two
fixed mappings, both computed by Spark from the whole tables:

documents -> posts (text statistics)
    tag = dominant tag of ``text`` over ``DOCUMENT_TAGS``; id = doc_id;
    text; lang; username = source; counts 0.

events -> posts (numeric statistics, time, predictors)
    tag = event_type; id = event_id; createdAt = epoch ms of ``ts``;
    t = ``ts`` as TIMESTAMP; text = props; username = 'user' || user_id;
    followersCount = int(value) (truncated); statusesCount = user_id;
    retweetCount = k (from ``props``); the re-share carries the same
    followers/retweet counts and id = event_id (so event 0 is "no re-share").
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import java_int
from ..functions.tagging import with_dominant_tag
from ..functions.time import display_time, format_created_at
from ..vocab import DOCUMENT_TAGS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def props_k() -> F.Column:
    return F.coalesce(F.try_variant_get(F.try_parse_json(F.col("props")), "$.k", "int"), F.lit(0))


def document_posts(documents: DataFrame, tags=DOCUMENT_TAGS, english_only: bool = True) -> DataFrame:
    d = documents
    if english_only:
        d = d.where(F.col("lang") == "en")  # T3 before any text work
    zero = F.lit(0)
    d = with_dominant_tag(d, "text", tags)
    return d.select(
        "tag",
        F.col("doc_id").alias("id"),
        F.col("text"),
        F.col("source").alias("username"),
        zero.alias("followersCount"), zero.alias("statusesCount"),
        zero.alias("favouritesCount"), zero.alias("retweetCount"),
        F.lit(0).cast("bigint").alias("createdAt"),
        (F.col("lang") == "en").alias("isEnglish"),
        F.lit("").alias("timestamp"),
        F.struct(F.lit(0).cast("bigint").alias("id"), F.lit("").alias("text"),
                 F.lit("").alias("username"), zero.alias("followersCount"),
                 zero.alias("statusesCount"), zero.alias("favouritesCount"),
                 zero.alias("retweetCount"), F.lit(0).cast("bigint").alias("createdAt")).alias("retweet"),
    )


def event_posts(events: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    ms = F.unix_millis(ts)
    followers = java_int(F.col("value"))
    k = props_k()
    return events.select(
        F.col("event_type").alias("tag"),
        F.col("event_id").alias("id"),
        F.col("props").alias("text"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("username"),
        followers.alias("followersCount"),
        java_int(F.col("user_id")).alias("statusesCount"),
        F.lit(0).alias("favouritesCount"),
        k.alias("retweetCount"),
        ms.alias("createdAt"),
        F.lit(True).alias("isEnglish"),
        display_time(ms).alias("timestamp"),
        F.struct(F.col("event_id").alias("id"), F.lit("").alias("text"), F.lit("").alias("username"),
                 followers.alias("followersCount"), F.lit(0).alias("statusesCount"),
                 F.lit(0).alias("favouritesCount"), k.alias("retweetCount"),
                 ms.alias("createdAt")).alias("retweet"),
        ts.alias("t"),
    )


def event_raw_posts(events: DataFrame) -> DataFrame:
    """Each event as a raw JSON post in the social-network layout (``value``).

    ``created_at`` has second precision, as in the original feed; events
    with an odd ``k`` carry a ``retweeted_status``.
    """
    ts = F.col("ts").cast("timestamp")
    k = props_k()
    user = F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("name"),
                    java_int(F.col("value")).alias("followers_count"),
                    F.col("user_id").alias("statuses_count"),
                    F.lit(0).alias("favourites_count"))
    rt = F.struct(format_created_at(ts).alias("created_at"), (F.col("event_id") + 1).alias("id"),
                  F.lit("shared").alias("text"), user.alias("user"), k.alias("retweet_count"))
    post = F.struct(
        format_created_at(ts).alias("created_at"),
        F.col("event_id").alias("id"),
        F.concat_ws(" ", F.col("event_type"), F.col("props")).alias("text"),
        user.alias("user"),
        k.alias("retweet_count"),
        F.lit("en").alias("lang"),
        F.when(k % 2 == 1, rt).alias("retweeted_status"),
    )
    return events.select(F.to_json(post, {"ignoreNullFields": "true"}).alias("value"))

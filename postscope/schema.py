"""The post record and its nested re-share record."""

from __future__ import annotations

from pyspark.sql import types as T

RETWEET = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("followersCount", T.IntegerType()),
    T.StructField("statusesCount", T.IntegerType()),
    T.StructField("favouritesCount", T.IntegerType()),
    T.StructField("retweetCount", T.IntegerType()),
    T.StructField("createdAt", T.LongType()),
])

POST = T.StructType([
    T.StructField("tag", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("followersCount", T.IntegerType()),
    T.StructField("statusesCount", T.IntegerType()),
    T.StructField("favouritesCount", T.IntegerType()),
    T.StructField("retweetCount", T.IntegerType()),
    T.StructField("createdAt", T.LongType()),
    T.StructField("isEnglish", T.BooleanType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("retweet", RETWEET),
])

POST_COLUMNS = [f.name for f in POST.fields]

# Defaults of an absent field (strings "", numbers 0, flag false).
DEFAULTS = {
    "tag": "", "id": 0, "text": "", "username": "", "followersCount": 0,
    "statusesCount": 0, "favouritesCount": 0, "retweetCount": 0, "createdAt": 0,
    "isEnglish": False, "timestamp": "",
}

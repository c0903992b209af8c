"""Raw JSON post -> typed post record (normalise, flatten, label).

Everything is native. The raw string is parsed once with ``from_json``
against a pruned schema that holds only the paths the record needs (a
large post is not materialised beyond them). Leaf fields are read as
strings: Spark keeps a JSON number's text for a string field, so numbers and
numeric strings are read alike; decimals truncate, counts saturate at the int
range, anything else is the field default.

Rows whose ``lang`` is not ``en`` are dropped. English rows that cannot be
turned into a record (no ``user`` object, missing or unparsable
``created_at``, same for an embedded re-share) and rows that are not JSON at
all are *quarantined* (``error`` column set) instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import POST_COLUMNS
from ..vocab import DEFAULT_TAGS
from .numbers import text_int, text_long
from .tagging import with_dominant_tag
from .time import display_time, parse_created_at

_S = T.StringType()
_USER = T.StructType([T.StructField(n, _S) for n in
                      ("name", "followers_count", "statuses_count", "favourites_count")])
_BASE = [T.StructField(n, _S) for n in ("created_at", "id", "text", "retweet_count")] + \
        [T.StructField("user", _USER)]
RAW_POST_SCHEMA = T.StructType(
    _BASE + [T.StructField("lang", _S),
             T.StructField("retweeted_status", T.StructType(list(_BASE))),
             T.StructField("_corrupt_record", _S)])
_JSON_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def _str(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def normalise(raw: DataFrame, value: str = "value", tags: Sequence[str] = DEFAULT_TAGS,
              keep: Sequence[str] = ()) -> DataFrame:
    """Parse raw posts; returns the post columns plus ``error`` (NULL = good)
    and ``raw``. ``keep`` lists extra input columns to carry along."""
    # The parse sits in a generator (one output row per input row), so the
    # language and quarantine filters are evaluated on the parsed struct.
    # Written as a plain projection, predicate pushdown would inline the parse
    # into the filter once per referenced field.
    parsed = raw.select(*keep, F.col(value).alias("_raw"),
                        F.explode(F.array(F.from_json(F.col(value), RAW_POST_SCHEMA, _JSON_OPTS)))
                        .alias("_p"))
    p, rt = F.col("_p"), F.col("_p.retweeted_status")
    malformed = p.isNull() | p["_corrupt_record"].isNotNull()
    # a line with a misplaced type is still JSON; its language decides first, as for any other
    valid = malformed & F.try_parse_json("_raw").isNotNull() & F.ltrim("_raw").startswith("{")
    english = parsed.where((malformed & ~valid) | (p["lang"] == F.lit("en")))
    english = with_dominant_tag(english, "_raw", tags, "_tag")

    created = parse_created_at(p["created_at"])
    has_rt = rt.isNotNull()
    rt_created = parse_created_at(rt["created_at"])
    retweet = F.when(
        has_rt,
        F.struct(
            text_long(rt["id"]).alias("id"), _str(rt["text"]).alias("text"),
            _str(rt["user"]["name"]).alias("username"),
            text_int(rt["user"]["followers_count"]).alias("followersCount"),
            text_int(rt["user"]["statuses_count"]).alias("statusesCount"),
            text_int(rt["user"]["favourites_count"]).alias("favouritesCount"),
            text_int(rt["retweet_count"]).alias("retweetCount"),
            F.coalesce(rt_created, F.lit(0).cast("bigint")).alias("createdAt"),
        ),
    ).otherwise(F.struct(
        F.lit(0).cast("bigint").alias("id"), F.lit("").alias("text"), F.lit("").alias("username"),
        F.lit(0).alias("followersCount"), F.lit(0).alias("statusesCount"),
        F.lit(0).alias("favouritesCount"), F.lit(0).alias("retweetCount"),
        F.lit(0).cast("bigint").alias("createdAt"),
    ))
    error = (F.when(malformed & ~(valid & p["user"].isNull()), F.lit("malformed json"))
             .when(p["user"].isNull(), F.lit("no user object"))
             .when(created.isNull(), F.lit("bad created_at"))
             .when(has_rt & rt["user"].isNull(), F.lit("re-share without user"))
             .when(has_rt & rt_created.isNull(), F.lit("re-share with bad created_at")))
    return english.select(
        *keep,
        F.col("_tag").alias("tag"),
        text_long(p["id"]).alias("id"),
        _str(p["text"]).alias("text"),
        _str(p["user"]["name"]).alias("username"),
        text_int(p["user"]["followers_count"]).alias("followersCount"),
        text_int(p["user"]["statuses_count"]).alias("statusesCount"),
        text_int(p["user"]["favourites_count"]).alias("favouritesCount"),
        text_int(p["retweet_count"]).alias("retweetCount"),
        F.coalesce(created, F.lit(0).cast("bigint")).alias("createdAt"),
        F.lit(True).alias("isEnglish"),
        F.coalesce(display_time(created), F.lit("")).alias("timestamp"),
        retweet.alias("retweet"),
        error.alias("error"),
        F.col("_raw").alias("raw"),
    )


def valid_posts(normalised: DataFrame) -> DataFrame:
    """Good rows only, in the post record layout (plus any kept columns)."""
    extra = [c for c in normalised.columns if c not in POST_COLUMNS and c not in ("error", "raw")]
    return normalised.where(F.col("error").isNull()).select(*extra, *POST_COLUMNS)


def quarantined(normalised: DataFrame) -> DataFrame:
    """Rejected rows: any kept columns, the raw text and the reason."""
    extra = [c for c in normalised.columns if c not in POST_COLUMNS and c not in ("error", "raw")]
    return normalised.where(F.col("error").isNotNull()).select(*extra, "raw", "error")

"""K3-K6: JSON document sinks (one folder per index).

Each statistic becomes a document with renamed fields and the wall-clock
write time in ms. The writer is generic: the ``documents`` data source
(``sinks.datasource``: JSON lines, committed batch by batch) by default, or any
installed DataFrame writer ``format`` (e.g. a search-engine connector), which goes through
``foreachBatch`` and overwrites the folder of its batch id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import POST_COLUMNS
from .datasource import FORMAT, register


def now_ms():
    return F.unix_millis(F.current_timestamp())


# Index name -> (source column -> document field), in order.
LAYOUTS: dict[str, list[tuple[str, str]]] = {
    "tw_max_wordlength": [("value", "max_wordlength"), ("tag", "max_wordlength_tag"),
                          ("__now", "max_wordlength_timestamp")],
    "tw_avg_tweetlength": [("value", "avg_tweetlength"), ("tag", "avg_tweetlength_tag"),
                           ("__now", "avg_tweetlength_timestamp")],
    "tw_avg_follower_count": [("value", "avg_follower_count"), ("tag", "avg_follower_count_tag"),
                              ("__now", "avg_follower_count_timestamp")],
    "tw_avg_reretweets": [("value", "avg_reretweets"), ("tag", "avg_reretweets_tag"),
                          ("__now", "avg_reretweets_timestamp")],
    "tw_avg_words_in_tweet": [("value", "avgWordsInTweet"), ("tag", "avgWordsInTweet_tag"),
                              ("__now", "avg_words_in_tweet_timestamp")],
    "tw_word_count": [("word", "word"), ("n", "count"), ("tag", "word_count_tag"),
                      ("__now", "word_count_timestamp")],
    "tw_comparedata": [("diff", "comparedata"), ("tag", "comparedata_tag"), ("name", "comparedata_name"),
                       ("__now", "comparedata_timestamp")],
    "tw_predictions": [("predicted", "predictions_predicted"), ("real", "predictions_real"),
                       ("tag", "predictions_tag"), ("name", "predictions_name"),
                       ("__now", "predictions_timestamp")],
}

# Which statistic column feeds which index.
STAT_INDEX = {
    "max_word_length": "tw_max_wordlength",
    "avg_length": "tw_avg_tweetlength",
    "avg_followers": "tw_avg_follower_count",
    "avg_reretweets": "tw_avg_reretweets",
    "avg_words": "tw_avg_words_in_tweet",
}


def to_documents(df: DataFrame, index: str) -> DataFrame:
    """Rename to the document layout of ``index`` and stamp the write time."""
    if index == "twitter":
        return df.select(*POST_COLUMNS)
    return df.select(*[(now_ms() if src == "__now" else F.col(src)).alias(dst) for src, dst in LAYOUTS[index]])


def stat_documents(stats: DataFrame, measure: str) -> DataFrame:
    """One statistic column of a (windowed) statistics frame as its documents."""
    return to_documents(stats.where(F.col(measure).isNotNull())
                        .select(F.col(measure).alias("value"), "tag"), STAT_INDEX[measure])


def comparison_documents(diffs: DataFrame) -> DataFrame:
    """J1-J3 rows as JSON text documents (column ``value``, for the text writer):
    the maximum's difference is an integer, the averages' are decimals."""
    def document(number):
        fields = dict((dst, src) for src, dst in LAYOUTS["tw_comparedata"])
        return F.to_json(F.struct(*[(now_ms() if src == "__now" else number if src == "diff" else F.col(src)).alias(dst)
                                    for dst, src in fields.items()]))
    return diffs.select(F.when(F.col("int_diff").isNotNull(), document(F.col("int_diff"))).otherwise(document(F.col("diff"))).alias("value"))


def lines(docs: DataFrame) -> DataFrame:
    """Documents as JSON text (column ``value``); text documents stay as they are."""
    if docs.columns == ["value"]:
        return docs
    return docs.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("value"))


def write_documents(docs: DataFrame, path: str, fmt: str = FORMAT, mode: str = "append",
                    options: dict[str, str] | None = None) -> None:
    if fmt == FORMAT:
        register(docs.sparkSession)
        docs = lines(docs)
    docs.write.format(fmt).mode(mode).options(**(options or {})).save(path)


def write_batch(docs: DataFrame, path: str, batch_id: int, fmt: str = FORMAT, folder: str = "batch") -> None:
    """The documents of one micro-batch below ``path/<folder>=<id>``, once however often the batch is run."""
    if fmt == FORMAT:
        write_documents(docs, path, options={"batch": str(batch_id), "folder": folder})
    else:
        docs.write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/{folder}={batch_id}")


def stream_documents(docs: DataFrame, path: str, checkpoint: str, fmt: str = FORMAT,
                     output_mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    if fmt == FORMAT:
        register(docs.sparkSession)
        w = lines(docs).writeStream.format(fmt).option("path", path)
    else:
        w = docs.writeStream.foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id, fmt))
    w = w.outputMode(output_mode).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()

"""Per-post text measures as native column expressions.

Tokenisation follows Java's ``String.split("\\W+")`` on the lower-cased
text: ``\\W`` is ASCII-only, a leading separator yields one leading empty
token, trailing empty tokens are dropped. Spark's ``split`` keeps trailing
empties, so the expressions below trim them explicitly where it matters.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..vocab import STOP_WORDS

NON_WORD = r"\W+"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def raw_tokens(text: str | Column) -> Column:
    """``split(lower(text), '\\W+')`` including the empty edge tokens."""
    return F.split(F.lower(_c(text)), NON_WORD)


def words_per_post(text: str | Column) -> Column:
    """Token count as Java's split reports it (M3), NULL where no row is emitted.

    Leading empty token counts, trailing ones do not; the empty string
    counts 1; a non-empty text without any word character gives 0 tokens,
    which the reference never emits, hence NULL. ``\\W+`` is greedy, so
    Spark's split leaves at most one trailing empty token to discount; the
    split is the same expression as in :func:`max_word_length`, so a
    projection computing both evaluates it once.
    """
    low = F.lower(_c(text))
    tok = raw_tokens(text)
    n = F.size(tok) - F.when(F.element_at(tok, -1) == F.lit(""), 1).otherwise(0)
    return F.when(low == F.lit(""), F.lit(1)).when(low.rlike(r"\w"), n)


def max_word_length(text: str | Column) -> Column:
    """Longest non-empty token of the post (M2 folded per post), NULL if none."""
    m = F.array_max(F.transform(raw_tokens(text), lambda w: F.length(w)))
    return F.when(m > 0, m)


def utf16_length(text: str | Column) -> Column:
    """Length in UTF-16 code units (M4), NULL for the empty text.

    ``length`` counts code points, so a character outside the BMP would
    count 1 instead of 2.
    """
    n = F.shiftright(F.octet_length(F.encode(_c(text), "UTF-16BE")), 1).cast("int")
    return F.when(n > 0, n)


#: Stop lists of more words are joined, not put into the expression.
INLINE_STOP_WORDS = 1000


def stop_list(spark: SparkSession, path: str) -> DataFrame:
    """A user's stop list on shared storage as a frame with the column ``word``: one word a line, lines that start with # are comments."""
    word = F.trim("value").alias("word")
    return spark.read.text(path).where(~F.col("value").startswith("#")).select(word).where("word <> ''").distinct()


def without_stop_words(rows: DataFrame, stop_words: Iterable[str] | DataFrame) -> DataFrame:
    """``rows`` (any with a column ``word``) whose word is not in the list.

    A list counted to have at most ``INLINE_STOP_WORDS`` words becomes part of the filter; a longer one a left anti
    join, whose right side Spark broadcasts while it measures it to be small.
    """
    if isinstance(stop_words, DataFrame):
        listed = stop_words.select("word").where("word IS NOT NULL").distinct()
        few = [r["word"] for r in listed.limit(INLINE_STOP_WORDS + 1).collect()]
    else:
        few = list(dict.fromkeys(stop_words))
        listed = None
    if len(few) <= INLINE_STOP_WORDS:
        return rows.where(~F.col("word").isin(few)) if few else rows
    if listed is None:
        listed = rows.sparkSession.createDataFrame([(w,) for w in few], "word string")
    return rows.join(listed, "word", "left_anti").select(*rows.columns)


def word_rows(df: DataFrame, text: str = "text", keep: Iterable[str] = ("tag",),
              stop_words: Iterable[str] | DataFrame = STOP_WORDS) -> DataFrame:
    """One row per kept word (M1): lower, split on ``\\W+``, drop empties and stop words (a list, or a frame with the column ``word``)."""
    rows = df.select(*keep, F.explode(raw_tokens(text)).alias("word"))
    return without_stop_words(rows.where(F.col("word") != ""), stop_words)


def token_lengths(df: DataFrame, text: str = "text", keep: Iterable[str] = ("tag",)) -> DataFrame:
    """One row per non-empty token with its length (M2, unfolded)."""
    keep = list(keep)
    rows = df.select(*keep, F.explode(raw_tokens(text)).alias("token"))
    return (rows.where(F.col("token") != "")
            .select(*keep, F.length("token").alias("value")))

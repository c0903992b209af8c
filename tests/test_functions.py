"""Layer 1: literal edge cases of the per-row operators."""


from postscope.functions.tagging import dominant_tag, occurrences, track_filter
from postscope.functions.text import max_word_length, utf16_length, word_rows, words_per_post
from postscope.functions.time import bucket_ms, display_time, parse_created_at


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"s {typ}").select(expr.alias("r")).first()["r"]


def test_dominant_tag_rules(spark):
    tags = ["A", "B"]
    assert one(spark, dominant_tag("s", tags), "xA yB zB") == "B"
    assert one(spark, dominant_tag("s", tags), "A A B B") == "A"      # tie: earlier wins
    assert one(spark, dominant_tag("s", tags), "nothing") == "A"       # no hit: first tag
    assert one(spark, dominant_tag("s", ["Apple", "Intel"]), "apple intel Intel") == "Intel"  # case-sensitive
    # the whole raw record counts, e.g. a user description
    raw = '{"text": "hi", "user": {"description": "Intel Intel"}}'
    assert one(spark, dominant_tag("s", ["Apple", "Intel"]), raw) == "Intel"


def test_occurrences_non_overlapping(spark):
    assert one(spark, occurrences("s", "aa"), "aaaa") == 2
    assert one(spark, occurrences("s", "aa"), "aaa") == 1
    assert one(spark, occurrences("s", "a.b"), "a.b axb") == 1   # literal, not a regex


def test_track_filter_case_insensitive(spark):
    assert one(spark, track_filter("s", ["Google"]), "i like GOOGLE") is True
    assert one(spark, track_filter("s", ["Google"]), "nothing") is False


def test_words_per_post(spark):
    assert one(spark, words_per_post("s"), "@a b!") == 3
    assert one(spark, words_per_post("s"), "a b!") == 2
    assert one(spark, words_per_post("s"), "!!!") is None
    assert one(spark, words_per_post("s"), "") == 1


def test_word_rows_stop_words(spark):
    df = spark.createDataFrame([("t", "RT The cat https")], "tag string, text string")
    assert [r.word for r in word_rows(df).collect()] == ["cat"]


def test_max_word_length_and_text_length(spark):
    assert one(spark, max_word_length("s"), "!!!") is None
    assert one(spark, max_word_length("s"), "ab, abcd") == 4
    assert one(spark, utf16_length("s"), "a\U0001F600") == 3
    assert one(spark, utf16_length("s"), "") is None


def test_time_parse_display_bucket(spark):
    ms = one(spark, parse_created_at("s"), "Tue Oct 22 20:33:43 +0000 2019")
    assert ms == 1571776423000
    assert one(spark, display_time("s"), 1571776423000, "bigint") == "October 22 2019, 20:33:43.000"
    assert one(spark, bucket_ms("s"), 1571776423000, "bigint") == 1571776200000
    assert one(spark, parse_created_at("s"), "") is None
    assert one(spark, parse_created_at("s"), "garbage") is None

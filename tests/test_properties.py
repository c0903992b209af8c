"""Property tests: the column expressions against plain-Python statements of
the same rules (Java ``split("\\\\W+")`` with trailing empties removed, ASCII
``\\W``; non-overlapping ``count``). One Spark job per generated batch."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from postscope.functions.tagging import dominant_tag, occurrences
from postscope.functions.text import max_word_length, utf16_length, words_per_post

ALPHABET = st.sampled_from(list("abcXYZ019_ !?.,@#\n\t-'é") + ["ß", "İ", "\U0001F600"])
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=30), min_size=1, max_size=60)
NON_WORD = re.compile(r"[^A-Za-z0-9_]+")


def java_split(s: str) -> list[str]:
    parts = NON_WORD.split(s.lower())
    if s == "":
        return [""]
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def py_words(s):
    n = len(java_split(s))
    return n if n > 0 else None


def py_max_len(s):
    m = max((len(t) for t in java_split(s) if t), default=0)
    return m if m > 0 else None


def py_utf16(s):
    n = len(s.encode("utf-16-be")) // 2
    return n if n > 0 else None


def py_dominant(s, tags):
    counts = [s.count(t) for t in tags]
    best = 0
    for i, c in enumerate(counts):
        if c > counts[best]:
            best = i
    return tags[best]


SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.too_slow])


@SETTINGS
@given(TEXTS)
def test_measures_match_java_rules(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = df.select("i", words_per_post("s").alias("w"), max_word_length("s").alias("m"),
                    utf16_length("s").alias("u")).orderBy("i").collect()
    for r, t in zip(got, texts):
        assert (r.w, r.m, r.u) == (py_words(t), py_max_len(t), py_utf16(t)), repr(t)


@SETTINGS
@given(TEXTS, st.lists(st.sampled_from(["a", "ab", "aa", "b", "é", "X"]), min_size=1, max_size=4, unique=True))
def test_dominant_tag_matches_counting(spark, texts, tags):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = df.select("i", dominant_tag("s", tags).alias("tag"),
                    *[occurrences("s", t).alias(f"c{j}") for j, t in enumerate(tags)]).orderBy("i").collect()
    for r, t in zip(got, texts):
        assert r.tag == py_dominant(t, tags), (t, tags)
        assert [r[f"c{j}"] for j in range(len(tags))] == [t.count(x) for x in tags]

"""Fixed vocabularies.

Everything in this module is a fixed value that must stay equal to the
behaviour being reproduced; change it only through the function parameters
that accept a replacement list.
"""

from __future__ import annotations

from importlib.resources import files

# The default topic vocabulary, in priority order (ties go to
# the earlier entry, posts with no hit get the first entry).
DEFAULT_TAGS: tuple[str, ...] = ("Google", "Facebook", "Apple", "Intel", "Huawei")


def read_words(text: str) -> tuple[str, ...]:
    """The words of a list file: one a line, lines that start with # are comments."""
    return tuple(dict.fromkeys(w.strip() for w in text.splitlines() if w.strip() and not w.startswith("#")))


#: The stop words removed by the word count (141 lower-case tokens, ``data/stop_words.txt``).
STOP_WORDS: tuple[str, ...] = read_words((files(__package__) / "data" / "stop_words.txt").read_text(encoding="utf-8"))

# Statistic names used by the live-vs-historic comparison and
# model names used by the predictors.
STAT_NAMES = {
    "max_word_length": "maxWordLength",
    "avg_length": "avgTweetLength",
    "avg_reretweets": "avgRetweets",
    "avg_followers": "avgFollowerCount",
    "avg_words": "avgWordInTweet",
}
MODEL_NAMES = {
    "ewma": "LengthPredictions",
    "retweets": "RetweetPredictions",
    "followers": "FollowerPredictions",
}

# Predictor constants.
EWMA_RATE = 0.1            # learning rate of the exponential smoothing model
REGRESSION_WARMUP = 20     # a regression predicts only once more rows than this were seen
SMA_RING = 100             # ring size of the moving-average model (divides by it even when not full)
ARCHIVE_BUCKET_MS = 600_000  # archive directory width: 10 minutes of createdAt

# Vocabularies used on the driver tables (no driver table holds social posts).
# Document text is tagged with common English words so that ties and
# all-zero rows really occur; events carry their own five-valued type.
DOCUMENT_TAGS: tuple[str, ...] = ("the", "of", "and", "in", "that")
EVENT_TAGS: tuple[str, ...] = ("signup", "error", "click", "view", "purchase")

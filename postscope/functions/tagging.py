"""Topic labelling (dominant tag) and the track-term filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def occurrences(s: str | Column, sub: str) -> Column:
    """Non-overlapping, case-sensitive occurrences of ``sub`` in ``s``.

    Removing every match shortens the UTF-8 bytes by ``len(sub)`` bytes per
    match, so the count is a byte-length difference (byte length is O(1) on
    Spark strings; no regex is involved).
    """
    if not sub:
        raise ValueError("tags must be non-empty strings")
    s = _c(s)
    gone = F.octet_length(s) - F.octet_length(F.replace(s, F.lit(sub), F.lit("")))
    return F.floor(gone / F.lit(len(sub.encode("utf-8")))).cast("int")


def tag_counts(s: str | Column, tags: Sequence[str]) -> list[Column]:
    return [occurrences(s, t) for t in tags]


def argmax_tag(counts: Sequence[Column], tags: Sequence[str]) -> Column:
    """First tag with the largest count (all zero -> first tag)."""
    tags = list(tags)
    if len(tags) == 1:
        return F.lit(tags[0])
    best = F.greatest(*counts)
    out = None
    for t, c in zip(tags, counts):
        out = F.when(c == best, F.lit(t)) if out is None else out.when(c == best, F.lit(t))
    return out.otherwise(F.lit(tags[0]))


def dominant_tag(s: str | Column, tags: Sequence[str]) -> Column:
    """The tag that occurs most often in ``s`` (the whole raw record).

    Strictly greater wins, so ties go to the earlier tag; no hit at all
    gives the first tag. (As one expression; :func:`with_dominant_tag`
    computes each count only once.)
    """
    tags = list(tags)
    if not tags:
        raise ValueError("need at least one tag")
    return argmax_tag(tag_counts(s, tags), tags)


def with_dominant_tag(df: DataFrame, s: str, tags: Sequence[str], name: str = "tag") -> DataFrame:
    """Add ``name`` = dominant tag of column ``s``; counts are projected first so
    each is evaluated once per row."""
    tags = list(tags)
    cnt = [f"_tc{i}" for i in range(len(tags))]
    d = df.select("*", *[c.alias(n) for c, n in zip(tag_counts(s, tags), cnt)])
    return d.select(*df.columns, argmax_tag([F.col(n) for n in cnt], tags).alias(name))


def track_filter(s: str | Column, terms: Sequence[str]) -> Column:
    """True when any track term occurs in ``s`` (case-insensitive)."""
    low = F.lower(_c(s))
    cond = None
    for t in terms:
        c = low.contains(t.lower())
        cond = c if cond is None else (cond | c)
    return cond if cond is not None else F.lit(False)

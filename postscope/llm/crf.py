"""Document quality from a linear-chain conditional random field over lines (operator 7).

Every non-blank line is good or bad. A line's evidence is its own features and
those of the lines before and after it; a 2 x 2 transition matrix and a start
vector tie neighbours together. Forward-backward marginals P(good), weighted by
line length, give a document's share of good text, and a logistic calibration
turns that share into the probability of label 1.

Training: labels are of documents, not of lines. Every line is first taken as
its document's label and judged by its own features alone; the lines of bad
documents that look good by themselves are relabelled (the worst line of each
stays bad), and the chain is fitted to these line labels. It is fitted on at most ``TRAIN_DOCS`` labelled documents, the first by a
hash of the id, of at most ``TRAIN_LINES`` lines each; features are made in Spark
tasks and only the sample's come to the driver. Everything else covers all rows.

Features are counts over characters, words and lines of the text alone; no
label, language, source or id enters a score.

Defined results: null, empty or blank text has no good text and gets the score
of share 0. Very long texts are scored whole, line by line. A null id is never labelled; several labels of an id count as the
least. Without labels of both kinds in the sample the score is the share
itself. Repeated rows each get their row, an empty table gives an empty
result, other columns are not read (or passed through by ``good_documents``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, read_table, row_blocks, stored, tidy

TRAIN_DOCS, TRAIN_LINES = 6000, 400
THRESHOLD = 0.7
BLOCK = 4 << 20  # bytes of text whose features are made at once
STEPS, RATE, RIDGE = 150, 0.1, 1e-3

LOWER, UPPER, DIGIT, SPACE, STOP, SYMBOL, LEAD, TAIL, OTHER = range(9)
FEATURES = [
    "log_chars", "letters", "upper", "digits", "spaces", "stops", "symbols", "non_ascii", "word_length", "log_words",
    "short_words", "symbol_ends", "distinct_words", "seen_before", "ends_sentence", "starts_upper",
]


def byte_classes() -> np.ndarray:
    kinds = np.full(256, OTHER, np.uint8)
    for b in range(256):
        c = chr(b)
        if b >= 0x80:
            kinds[b] = LEAD if b >= 0xC0 else TAIL
        elif c.isalpha():
            kinds[b] = LOWER if c.islower() else UPPER
        elif c.isdigit():
            kinds[b] = DIGIT
        elif c in " \t\n\r\f\v":
            kinds[b] = SPACE
        elif c in ".,;:'\"?()-":
            kinds[b] = STOP
        elif c.isprintable():
            kinds[b] = SYMBOL
    return kinds


CLASSES = byte_classes()


def line_features(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, length, counts): a row of ``FEATURES`` for each non-blank line, its characters, and the number of lines of each text."""
    raw = b"\n".join(texts) + b"\n"
    data = np.frombuffer(raw, np.uint8)
    kind = CLASSES[data]
    ends = np.flatnonzero(data == 10)
    starts = np.r_[0, ends[:-1] + 1]
    doc_starts = np.r_[0, np.cumsum([len(t) + 1 for t in texts])[:-1]]
    space = kind == SPACE
    inked = np.add.reduceat(~space, starts, dtype=np.int64)
    keep = inked > 0
    starts, ends, inked = starts[keep], ends[keep], inked[keep]
    doc = np.searchsorted(doc_starts, starts, "right") - 1
    counts = np.bincount(doc, minlength=len(texts))
    n = len(starts)
    if not n:
        return np.zeros((0, len(FEATURES)), np.float32), np.zeros(0), counts

    edges = np.stack([starts, ends], 1).ravel()

    def total(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, edges, dtype=np.int64)[::2].astype(np.float64)

    lower, upper, digit, stop, symbol, lead, tail = (total(kind == k) for k in (LOWER, UPPER, DIGIT, STOP, SYMBOL, LEAD, TAIL))
    chars = (ends - starts) - tail
    letters = lower + upper + lead
    first = np.flatnonzero(~space & np.r_[True, space[:-1]])
    last = np.flatnonzero(~space & np.r_[space[1:], True])
    size = last - first + 1
    line = np.searchsorted(starts, first, "right") - 1
    words = np.bincount(line, minlength=n).astype(np.float64)
    short = np.bincount(line, size <= 3, n)
    marked = np.bincount(line, kind[last] == SYMBOL, n)
    distinct, seen = np.empty(n), np.zeros(n)
    held: set[bytes] = set()
    at = -1
    for k, (a, b, d) in enumerate(zip(starts.tolist(), ends.tolist(), doc.tolist())):
        if d != at:
            held, at = set(), d
        body = raw[a:b]
        distinct[k] = len(set(body.split()))
        seen[k] = body in held
        held.add(body)
    ink = np.maximum(inked - tail, 1)
    final = kind[np.maximum(ends - 1, starts)]
    x = np.stack([
        np.log1p(chars), letters / ink, upper / np.maximum(letters, 1), digit / ink, 1 - ink / np.maximum(chars, 1), stop / ink, symbol / ink,
        lead / ink, np.minimum(ink / words, 40) / 10, np.log1p(words), short / words, marked / words, distinct / words, seen,
        (final == STOP) | (data[np.maximum(ends - 1, starts)] == 33), kind[starts] == UPPER,
    ], axis=1)
    return x.astype(np.float32), chars, counts


def with_neighbours(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and after it (0 where there is none), and two flags for the ends."""
    n = len(x)
    stops = np.cumsum(counts)
    firsts = (stops - counts)[counts > 0]
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[firsts] = True
    last[stops[counts > 0] - 1] = True
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first], after[last] = 0, 0
    return np.concatenate([x, before, after, first[:, None], last[:, None], np.ones((n, 1))], axis=1)


@dataclass
class Chain:
    """Weights of the evidence for good against bad, transitions [from, to] and start scores (0 bad, 1 good), and the calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    step: np.ndarray
    start: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    calibrated: bool = False

    def evidence(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return with_neighbours((x - self.mean) / self.scale, counts) @ self.weight

    def score(self, share: np.ndarray) -> np.ndarray:
        if not self.calibrated:
            return share
        return 1 / (1 + np.exp(-np.clip(self.slope * logit(share) + self.shift, -500, 500)))


def logit(p: np.ndarray) -> np.ndarray:
    q = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(q / (1 - q))


def forward_backward(evidence: np.ndarray, counts: np.ndarray, step: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(P(line good), expected transitions, sum of log normalisers), all sequences advanced together by position."""
    n = len(evidence)
    unary = np.stack([np.zeros(n), evidence], 1)
    begin = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    begin, length = begin[order], counts[order]
    longest = int(length[0]) if len(length) else 0
    alive = [int(np.searchsorted(-length, -t, "left")) for t in range(longest)]  # sequences with more than t lines
    alpha, beta = np.empty((n, 2)), np.zeros((n, 2))
    if longest:
        alpha[begin] = unary[begin] + start
    for t in range(1, longest):
        now = begin[: alive[t]] + t
        a = alpha[now - 1]
        alpha[now] = unary[now] + np.logaddexp(a[:, :1] + step[0], a[:, 1:] + step[1])
    for t in range(longest - 2, -1, -1):
        now = begin[: alive[t + 1]] + t
        ahead = unary[now + 1] + beta[now + 1]
        beta[now] = np.logaddexp(step[:, 0] + ahead[:, :1], step[:, 1] + ahead[:, 1:])
    ends = begin + length - 1
    z = np.logaddexp(alpha[ends, 0], alpha[ends, 1]) if longest else np.zeros(0)
    norm = np.empty(n)
    norm[np.concatenate([np.arange(b, b + m) for b, m in zip(begin, length)]) if longest else []] = np.repeat(z, length)
    good = np.exp(alpha[:, 1] + beta[:, 1] - norm)
    inner = np.ones(n, bool)
    inner[begin] = False
    now = np.flatnonzero(inner)
    moved = np.exp(alpha[now - 1][:, :, None] + step[None] + (unary[now] + beta[now])[:, None, :] - norm[now][:, None, None]).sum(0) if len(now) else np.zeros((2, 2))
    return good, moved, float(z.sum())


def fit_chain(x: np.ndarray, counts: np.ndarray, label: np.ndarray, chain: Chain) -> None:
    """Maximum conditional likelihood of the line labels by Adam on the exact gradient."""
    f = with_neighbours((x - chain.mean) / chain.scale, counts)
    begin = (np.cumsum(counts) - counts)[counts > 0]
    inner = np.ones(len(x), bool)
    inner[begin] = False
    now = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[now - 1], label[now]), 1)
    started = np.bincount(label[begin], minlength=2).astype(float)
    theta = np.r_[chain.weight, chain.step.ravel(), chain.start]
    k = len(chain.weight)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, STEPS + 1):
        w, step, start = theta[:k], theta[k:k + 4].reshape(2, 2), theta[k + 4:]
        good, moved, _ = forward_backward(f @ w, counts, step, start)
        grad = np.r_[f.T @ (label - good), (seen - moved).ravel(), started - np.r_[(1 - good[begin]).sum(), good[begin].sum()]] / len(x) - RIDGE * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    chain.weight, chain.step, chain.start = theta[:k], theta[k:k + 4].reshape(2, 2), theta[k + 4:]


def shares(good: np.ndarray, length: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Length-weighted share of good text of each document; 0 where there is no line."""
    doc = np.repeat(np.arange(len(counts)), counts)
    weight = np.bincount(doc, length, len(counts))
    return np.bincount(doc, good * length, len(counts)) / np.maximum(weight, 1)


def calibrate(share: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the share's logit, by Newton's method with a small ridge."""
    f = np.stack([logit(share), np.ones(len(share))], 1)
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
        h = (f * (p * (1 - p))[:, None]).T @ f + 1e-2 * np.eye(2)
        w = w + np.linalg.solve(h, f.T @ (label - p) - 1e-2 * w)
    return float(w[0]), float(w[1])


def train(x: np.ndarray, length: np.ndarray, counts: np.ndarray, label: np.ndarray) -> Chain:
    width = 3 * len(FEATURES) + 3
    chain = Chain(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(width), np.zeros((2, 2)), np.zeros(2))
    if len(x):
        chain.mean, chain.scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    if len(set(label[counts > 0].tolist())) < 2:
        return chain
    lines, alone = np.repeat(label, counts), np.ones(len(x), np.int64)
    fit_chain(x, alone, lines, chain)
    good, _, _ = forward_backward(chain.evidence(x, alone), alone, chain.step, chain.start)
    doc = np.repeat(np.arange(len(counts)), counts)
    worst = np.full(len(counts), np.inf)
    np.minimum.at(worst, doc, good)
    lines = np.where((lines == 0) & (good > 0.5) & (good > worst[doc]), 1, lines)
    chain.weight, chain.step, chain.start = np.zeros(width), np.zeros((2, 2)), np.zeros(2)
    fit_chain(x, counts, lines, chain)
    good, _, _ = forward_backward(chain.evidence(x, counts), counts, chain.step, chain.start)
    chain.slope, chain.shift = calibrate(shares(good, length, counts), label)
    chain.calibrated = True
    return chain


def body(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")).cast("binary")


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``BLOCK`` bytes of text, or one row."""
    for b in batches:
        for start, end in row_blocks(pc.binary_length(b.column(column)).to_pylist(), BLOCK):
            yield b.slice(start, end - start)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        most: int = TRAIN_DOCS, lines: int = TRAIN_LINES) -> Chain:
    """Chain learnt from the labelled rows where ``learn`` (a condition on the id column) holds."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).where(learn).groupBy(id_col).agg(F.min(label_col).cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(most)
    texts = docs.select(F.col(id_col).alias("id"), body(text_col).alias("body"))
    rows = texts.join(F.broadcast(sample.withColumnRenamed(id_col, "id")), "id").select("label", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            x, length, counts = line_features(b.column(1).to_pylist())
            at = np.cumsum(counts) - counts
            keep = np.flatnonzero(counts <= lines)
            yield pa.RecordBatch.from_pydict({
                "label": b.column(0).take(pa.array(keep)),
                "x": pa.array([x[a:a + c].tobytes() for a, c in zip(at[keep], counts[keep])], pa.binary()),
                "length": pa.array([length[a:a + c].astype(np.float32).tobytes() for a, c in zip(at[keep], counts[keep])], pa.binary()),
            })

    got = rows.mapInArrow(tidy(run), "label int, x binary, length binary").toPandas().sort_values(["x", "label"])  # task order must not matter
    x = np.frombuffer(b"".join(got["x"]), np.float32).reshape(-1, len(FEATURES)).astype(np.float64)
    length = np.frombuffer(b"".join(got["length"]), np.float32).astype(np.float64)
    counts = np.array([len(v) // 4 for v in got["length"]], np.int64)
    return train(x, length, counts, got["label"].to_numpy(np.int64))


def line_marginals(texts: Sequence[bytes], chain: Chain) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x, length, counts = line_features(texts)
    good, _, _ = forward_backward(chain.evidence(x, counts), counts, chain.step, chain.start)
    return good, length, counts


def score_documents(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, score, lines): probability of label 1 and P(good) of every non-blank line."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), body(text_col).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            good, length, counts = line_marginals(b.column(2).to_pylist(), chain)
            score = chain.score(shares(good, length, counts))
            lines = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(good.astype(np.float32)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score, pa.float64()), lines], names=["id", "text_hash", "score", "lines"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"id {kind}, text_hash bigint, score double, lines array<float>")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, score, lines), learnt from labels outside the held-out ids."""
    return score_documents(docs, fit(docs, labels, ~held_out(id_col, 4), id_col, text_col), id_col, text_col)


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` scored ``threshold`` or more, with all their columns."""
    scored = stored(quality(docs, labels, id_col, text_col).select("id", "text_hash", "score"), "quality")
    bad = scored.where(F.col("score") < threshold).select(F.col("id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs[text_col]) == bad["bad_hash"]), "left_anti")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id").select(
        "doc_id", held_out("doc_id", 4).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))

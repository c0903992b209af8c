import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postscope.llm import suffix_dedup as S


def plain(rows, length):
    """(id, bytes, removed, spans, sha) by counting every string of ``length`` bytes."""
    bodies = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k:k + length] for _, b in bodies for k in range(len(b) - length + 1))
    out = []
    for i, b in bodies:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = True
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def digest(frame):
    return sorted(((r.id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), sha256(r.kept).hexdigest()) for r in frame.collect()), key=str)


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=300) | st.text(alphabet="ab\0", min_size=1, max_size=400).map(str.encode))
def test_suffixes_and_common_prefixes(body):
    order = S.suffix_array(np.frombuffer(body, np.uint8))
    want = sorted(range(len(body)), key=lambda k: body[k:])
    assert order.tolist() == want

    def shared(a, b):
        n = 0
        while n < 16 and max(a, b) + n < len(body) and body[a + n] == body[b + n]:
            n += 1
        return n

    fenced = np.frombuffer(body + b"\xff", np.uint8)
    order = S.suffix_array(fenced)
    body += b"\xff"
    got = S.common_prefixes(fenced, order, 16, lanes=5)
    assert got.tolist() == [0] + [shared(a, b) for a, b in zip(order[:-1].tolist(), order[1:].tolist())]


def corpus(seed=1, n=120):
    """Copies, near copies, shared passages, runs of one character and NULs, some over several pieces."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijé") for _ in range(rng.randrange(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(60) for _ in range(4)]
    texts = [None, "", "short", "x" * 900, "\0" * 700, text(300) + "ab" * 400 + text(20)]
    for _ in range(n):
        t = text(rng.randrange(5, 250))
        if rng.random() < 0.5:
            t += rng.choice(shared) + text(rng.randrange(40))
        if rng.random() < 0.3 and len(texts) > 6:
            t = texts[rng.randrange(6, len(texts))]
            if rng.random() < 0.5:
                k = rng.randrange(len(t))
                t = t[:k] + word() + t[k + 3:]
        texts.append(t)
    return [*enumerate(texts), (None, texts[-1]), (3, texts[4])]


def test_equal_to_counting(spark):
    rows = corpus()
    frame = spark.createDataFrame([(*r, 1, b"k", [1]) for r in rows], "doc_id bigint, text string, id int, kept binary, spans array<int>")
    assert digest(S.without_repeats(frame)) == plain(rows, 400)
    assert S.without_repeats(frame.limit(0)).count() == 0


def test_split_keys_and_long_texts(spark, monkeypatch):
    """Shards of a few stretches, so that keys are split and merged, and texts cut into overlapping parts."""
    monkeypatch.setattr(S, "LONG", 500)
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(450))
    rows = corpus(2, 60) + [(1000 + k, "".join(rng.choice("xyz ") for _ in range(rng.randrange(60))) + passage + "".join(rng.choice("pq ") for _ in range(rng.randrange(60)))) for k in range(60)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = S.without_repeats(frame, shard=4000)
    assert digest(got) == plain(rows, 400)


def test_query_equals_counting(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = sorted(map(tuple, S.op12_suffix_dedup(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == plain(rows, 400) and sum(r[2] for r in got) > 0


@pytest.mark.parametrize("seed", range(3))
def test_runs_merge_by_binary_search(seed):
    rng = np.random.default_rng(seed)
    runs, at = [], 0
    for _ in range(7):
        d = np.unique(rng.integers(0, 40, rng.integers(0, 25)))
        runs.append((np.array([b"%016d" % x for x in d], "S16"), np.arange(at, at + len(d))))
        at += len(d)
    marked = np.zeros(at, bool)
    S.merge_runs(list(runs), marked)
    everything = np.concatenate([r[0] for r in runs]).tolist()
    count = Counter(everything)
    assert marked.tolist() == [count[x] > 1 for x in everything]

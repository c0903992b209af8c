import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from postscope.llm import periodic_runs as S


def plain_runs(words):
    """Every run by its definition: for each period the longest stretches, kept if no smaller period holds."""
    n, out = len(words), []
    for q in range(1, n // S.POWER + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            s, length = i, j + q - i
            part = words[s:s + length]
            if length >= max(S.LEAST, S.POWER * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                out.append((s, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = re.findall(S.WORD, text or "")
    n = len(words)
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = plain_runs(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    hexed = lambda t: sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *top, top[1] * 1000 // top[2] if runs else None, hexed("".join("%d,%d,%d\n" % r for r in runs)),
            hexed(" ".join(w for k, w in enumerate(words) if k not in gone)))


def found(texts):
    size = [len(t) for t in texts]
    names = {}
    ids = np.array([names.setdefault(w, len(names)) for t in texts for w in t], np.int64)
    out = [[] for _ in texts]
    for t, s, n, q in S.find_runs(ids, size).tolist():
        out[t].append((s, n, q))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=70) | st.text(alphabet="abcd", max_size=120), min_size=1, max_size=5))
def test_random_words(texts):
    assert found(texts) == [plain_runs(list(t)) for t in texts]


def test_periodic_texts():
    rng = random.Random(5)
    texts = []
    for _ in range(300):
        root = [rng.randrange(3) for _ in range(rng.randrange(1, 40))]
        body = (root * 12)[:rng.randrange(1, 300)]
        texts.append([str(x) for x in [rng.randrange(3) for _ in range(rng.randrange(30))] + body + [rng.randrange(3) for _ in range(rng.randrange(30))]])
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    texts += [[], ["x"] * 5, ["x"] * 6, ["x"] * 700, list("ab" * 200), list(fib[-1]), list(("a" * 100 + "b") * 6), list("".join("a" * k + "b" for k in range(40)))]
    assert found(texts) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("top", [2, 1000, 1 << 20, 1 << 28])
def test_sums_are_exact(top):
    """Numbers up to ``top`` take one to three primes; near misses by multiples of a prime are no match."""
    rng = np.random.default_rng(top)
    for b in (1, 2, 8, 64):
        block = rng.integers(0, top, (20, b)).astype(np.uint64)
        window = rng.integers(0, top, (20, 2 * b - 1)).astype(np.uint64)
        for k in range(20):
            window[k, k % b:k % b + b] = block[k]
        want = np.array([[(window[k, d:d + b] == block[k]).all() for d in range(b)] for k in range(20)])
        assert (S.zero_mismatches(block, window) == want).all()
    with pytest.raises(ValueError):
        S.zero_mismatches(np.full((1, 1 << 10), 1 << 44, np.uint64), np.full((1, (1 << 11) - 1), 1 << 44, np.uint64))


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = sorted(plain_row(r.doc_id, r.text) for r in docs)
    assert sorted(map(tuple, S.op11_periodic_runs(spark, "/root/testdata/sf0.001").collect())) == want
    assert sum(r[1] for r in want) > 10


def test_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 2000)
    rows = [(1, None), (2, ""), (3, " \t\x0b\x0c\r\n "), (4, "a " * 50), (4, "a " * 50), (None, "the cat " * 9), (5, "é é é é é é é é é é"), (6, "\x1cx \x1cx \x1cx \x1cx \x1cx \x1cx"),
            (7, "one two three " * 2000 + "end"), (8, " ".join(str(k) for k in range(5000)) + " z" * 9)]
    frame = spark.createDataFrame([(*r, [1], "y", 2) for r in rows], "doc_id bigint, text string, runs array<int>, collapsed string, id int")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, S.op11_periodic_runs(spark, str(tmp_path)).collect()), key=str) == sorted((plain_row(*r) for r in rows), key=str)
    got = {r.id: r for r in S.periodic_runs(frame).collect()}
    assert got[4].collapsed == "a" and got[7].collapsed == "one two three end" and [tuple(r) for r in got[7].runs] == [(0, 6000, 3)]
    assert S.periodic_runs(frame.limit(0)).count() == 0

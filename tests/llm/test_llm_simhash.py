import random
import re

import numpy as np
import pytest
import xxhash

from postscope.llm import simhash as S

SCHEMA = "doc_id bigint, text string, fp string, id string, component_id string"


def brute_print(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("text", ["", " \t\r\n\x0b\x0c ", "One", "a b c", "a b c d", "É é a\xa0b A B a b", "x " * 500, "Ünï 你好 \x1c sep a b c d e f"])
def test_fingerprint_is_the_contract_s(text):
    assert S.simhash64(text.encode()) == brute_print(text)


def family(rng, bases, most):
    out = set()
    for base in bases:
        for _ in range(most):
            x = base
            for _ in range(rng.randrange(4)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


def test_bit_sliced_comparison_equals_popcount():
    rng = random.Random(5)
    for radius in (0, 1, 3, 4, 5, 7):
        fps = np.array(family(rng, [rng.getrandbits(64) for _ in range(6)], 40), np.uint64)
        rng.shuffle(fps)
        group = np.sort(np.array([rng.randrange(3) for _ in fps]))
        a, b = S.spanning_forest(fps, group, radius)
        root = np.arange(len(fps))
        root[a] = b
        want = classes(len(fps), lambda i, j: group[i] == group[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= radius)
        assert root.tolist() == want


def test_links_span_the_brute_force_components_with_split_buckets(spark):
    rng = random.Random(2)
    fps = family(rng, [rng.getrandbits(64) for _ in range(5)] + [0], 60)
    nodes = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp bigint")
    want = classes(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    for tile in (4, 4096):
        edges = {(r.a, r.b) for r in S.links(nodes, tile=tile).collect()}
        index = {int(np.uint64(x).view(np.int64)): k for k, x in enumerate(fps)}
        pairs = {(index[a], index[b]) for a, b in edges}
        got = classes(len(fps), lambda i, j: (i, j) in pairs or (j, i) in pairs)
        assert got == want


def test_stars_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (5, 5)], "a bigint, b bigint")
    got = {r.node: r.root for r in S.stars(edges).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, 101: 100}


def rows():
    rng = random.Random(9)
    base = " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(k) for k in range(120))
    near = base.replace("alpha", "ALPHA") + " tail"
    return [(3, base), (1, near), (3, base), (7, None), (9, ""), (8, " \n"), (None, base), (None, "lone text of a null id"), (5, "short"), (6, "other words here entirely"), (2, "z " * 30000)]


def test_components_equal_brute_force(spark):
    data = rows()
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in data], SCHEMA)
    prints = [brute_print(t) for _, t in data]
    same = classes(len(data), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    want = []
    for k, (i, _) in enumerate(data):
        ids = [data[m][0] for m in range(len(data)) if same[m] == same[k] and data[m][0] is not None]
        want.append((i, prints[k], min(ids) if ids else None))
    got = [(r.id, r.fp % (1 << 64), r.component_id) for r in S.components(docs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(want, key=key)


def test_keep_one_keeps_columns_and_one_row_of_each(spark):
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows()], SCHEMA)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert got == [(False, 1), (False, 2), (False, 5), (False, 6), (False, 7), (True, 0)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert S.components(docs).count() == 0
    assert S.keep_one(docs).count() == 0


def test_keep_one_of_repeated_ids_keeps_each_component(spark):
    """Two texts that are no link apart share an id: both stay."""
    texts = ["the river ran by the old mill all day", "seven bright birds sat on a wire in June", "nobody knew where the last train had gone"]
    rows_ = [(5, texts[0], "x"), (5, texts[1], "x"), (7, texts[2], "x"), (9, texts[0], "x"), (None, texts[1], "x")]
    docs = spark.createDataFrame(rows_, "doc_id bigint, text string, root string")
    assert sorted((r.doc_id, r.text) for r in S.keep_one(docs).collect()) == sorted([(5, texts[0]), (5, texts[1]), (7, texts[2])])
    assert S.keep_one(docs).columns == docs.columns

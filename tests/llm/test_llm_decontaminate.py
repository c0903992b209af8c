import hashlib
import random
import re

import duckdb
import pytest

from postscope.llm import decontaminate as S

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, uid string, words string, item string, pos string"


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for i, text in docs:
        w = split(text)
        hit, found = set(), set()
        for item, t in items:
            q = split(t)
            n = min(13, len(q))
            for s in range(len(q) - n + 1) if q else ():
                for k in range(len(w) - n + 1):
                    if w[k:k + n] == q[s:s + n]:
                        hit.update(range(k, k + n))
                        found.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def case(seed):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(12)] + ["É", "é", "über", "12"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(k, say(rng.randrange(1, 40))) for k in range(12)] + [(None, say(20)), (3, say(15)), (50, ""), (51, None), (52, "...")]
    items.append((60, "the " * 30))
    docs = []
    for k in range(60):
        t = say(rng.randrange(30))
        if k % 3:
            q = split(rng.choice(items)[1] or "x")
            a = rng.randrange(len(q)) if q else 0
            t += " , " + "--".join(w.upper() if rng.random() < 0.3 and w.isascii() else w for w in q[a:a + rng.randrange(1, 30)]) + "! " + say(rng.randrange(300 if k % 5 == 0 else 9))
        docs.append((k, t))
    return docs + [(100, None), (101, ""), (None, items[0][1]), (7, docs[1][1]), (102, "the " * 5000)], items


def frames(spark, docs, items):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in docs], DOCS), spark.createDataFrame([(i, t, "q") for i, t in items], "item_id bigint, text string, words string")


def result(spark, docs, items):
    d, b = frames(spark, docs, items)
    return [(r.id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in S.contamination(d, b).collect()]


order = lambda r: (r[0] is None, r[0] or 0, r[1:])


@pytest.mark.parametrize("seed", [1, 2])
def test_hits_equal_brute_force(spark, seed):
    docs, items = case(seed)
    assert sorted(result(spark, docs, items), key=order) == sorted(brute(docs, items), key=order)


def test_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_TERMS", 0)
    monkeypatch.setattr(S, "BROADCAST_LOOKUPS", 0)
    docs, items = case(3)
    assert sorted(result(spark, docs, items), key=order) == sorted(brute(docs, items), key=order)


def test_sql_states_the_same(spark, tmp_path):
    docs, items = case(4)
    d, b = frames(spark, docs, items)
    d.write.parquet(f"{tmp_path}/documents.parquet")
    b.write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.execute(S.OP5_SQL).fetchall()
    assert sorted(map(tuple, S.op5_decontaminate(spark, str(tmp_path)).collect()), key=order) == sorted(want, key=order)


def test_drop_keeps_clean_rows_and_columns(spark):
    docs, items = case(1)
    d, b = frames(spark, docs, items)
    left = S.drop_contaminated(d, b)
    assert left.columns == d.columns
    want = [(i, t) for (i, t), r in zip(docs, brute(docs, items)) if not r[-1]]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    docs, items = case(1)
    assert result(spark, [], items) == []
    assert all(r[2] == 0 for r in result(spark, docs, []))


def test_proximity(spark):
    docs = [(1, "alpha x x beta x gamma"), (2, "alpha " + "x " * 30 + "beta gamma"), (3, "gamma beta alpha"), (4, "alpha beta")]
    d, b = frames(spark, docs, [(9, "alpha beta gamma"), (8, "absent alpha")])
    index = S.forward(d)
    ids = {r.uid: r.id for r in index.collect()}
    got = {(ids[r.uid], r.item) for r in S.Searches(index, S.items_of(b), slop=6).proximity_matches().collect()}
    assert got == {(1, "9"), (3, "9")}


def test_near_items_of_long_items(spark):
    """A passage of 40 words with words put in and swapped has no exact run, but its windows are near."""
    q = [f"q{k}" for k in range(40)]
    swapped = [w for k in range(0, 40, 2) for w in (q[k + 1], q[k])]
    added = [w for k, x in enumerate(q) for w in ([x, "extra"] if k % 6 == 5 else [x])]
    apart = [w for x in q for w in [x] + ["x"] * 9]
    docs = [(1, " ".join(swapped)), (2, " ".join(added)), (3, " ".join(apart)), (4, " ".join(q)), (5, None)]
    d, b = frames(spark, docs, [(9, " ".join(q)), (8, "the " * 30), (7, " ".join(q) + " absent")])
    got = {r.id: (r.n_hit, r["items"], r.near_items) for r in S.contamination(d, b).collect()}
    assert got == {1: (0, [], ["7", "9"]), 2: (0, [], ["7", "9"]), 3: (0, [], []), 4: (40, ["7", "9"], ["7", "9"]), 5: (0, [], [])}


def test_dropping_passes_clashing_columns_on(spark):
    q = " ".join(f"q{k}" for k in range(14))
    docs = spark.createDataFrame([(1, q, "a", "b", 3), (2, "clean words", "a", "b", 3)], "doc_id bigint, text string, bad_id string, uid string, bad_hash int")
    left = S.drop_contaminated(docs, spark.createDataFrame([(9, q)], "item_id bigint, text string"))
    assert [tuple(r) for r in left.collect()] == [(2, "clean words", "a", "b", 3)] and left.columns == docs.columns

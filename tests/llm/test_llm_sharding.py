from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from postscope.llm import sharding as S


def place(spark, keys, shards=8):
    rows = spark.createDataFrame(list(enumerate(keys)), "uid bigint, key string")
    return {r.uid: (r.shard, r.slot) for r in S.level(rows, S.propagate(rows, shards), shards).collect()}


def check(got, n, shards=8):
    assert len(got) == n
    slots = defaultdict(list)
    for shard, slot in got.values():
        slots[shard].append(slot)
    sizes = [len(slots[k]) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def cut(got, keys):
    where = defaultdict(set)
    for uid, (shard, _) in got.items():
        where[keys[uid]].add(shard)
    return sum(len(s) - 1 for s in where.values())


def test_small_groups_stay_whole_and_sizes_even(spark):
    keys = [f"g{k // 4}" for k in range(400)] + [f"s{k}" for k in range(600)]
    got = place(spark, keys)
    check(got, len(keys))
    assert cut(got, keys) <= 2


def test_a_group_of_a_third_of_all_rows_is_split_but_even(spark):
    keys = ["hot"] * 500 + [f"p{k // 2}" for k in range(300)] + [f"s{k}" for k in range(700)]
    got = place(spark, keys)
    check(got, len(keys))
    sizes = Counter(got[k][0] for k in range(500))
    assert sum(n for _, n in sizes.most_common(4)) >= 475
    assert cut(got, keys) < 40


def test_only_copies_of_one_text(spark):
    got = place(spark, ["x"] * 97)
    check(got, 97)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_rows_than_shards(spark, n):
    check(place(spark, [str(k) for k in range(n)]), n)


def test_quotas_let_swaps_through_and_extra_up_to_room():
    assert S.quotas({(0, 1): 10, (1, 0): 4}, [100, 100], 103)[0, 1] == pytest.approx((4 + 3) / 10)
    assert S.quotas({(0, 1): 10, (1, 0): 4}, [100, 100], 103)[1, 0] == 1


def test_query_columns_with_nulls_repeats_and_extra_columns(spark, tmp_path):
    data = [(1, "a", 0), (1, "a", 0), (None, None, 1), (None, "", 2), (4, "é" * 3, 3), (5, "long " * 20000, 4)]
    spark.createDataFrame(data, "doc_id bigint, text string, shard int").withColumn("uid", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    out = S.op2_sharding(spark, str(tmp_path))
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = out.collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter([(1, 2), (1, 2), (None, 1), (None, 1), (4, 7), (5, 100001)])
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def hashed(*parts, seed=42):
    """Spark's xxhash64 of longs, ints and strings."""
    import struct
    import xxhash
    for kind, v in parts:
        body = v.encode() if kind == "s" else struct.pack("<q" if kind == "l" else "<i", v)
        seed = xxhash.xxh64_intdigest(body, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_propagation(rows, shards=8, slack=S.SLACK):
    """The stated propagation in plain Python, over rows (uid, key)."""
    n = len({u for u, _ in rows})
    total = Counter(k for _, k in rows)
    links = [(u, k) for u, k in rows if total[k] > 1]
    lead = {}
    for u, k in links:
        lead[u] = max(lead.get(u, (0, "")), (total[k], k))
    shard = {u: hashed(("l", u)) % shards for u in lead}
    sizes = [sum(s == j for s in shard.values()) for j in range(shards)]
    capacity = max(n, (1 + slack) * sum(sizes)) / shards
    turn, best, idle = 0, None, 0
    while True:
        may = [size < capacity - 0.5 for size in sizes]
        votes = Counter((k, shard[u]) for u, k in links)
        held = {u: [0] * shards for u in lead}
        for u, k in links:
            for j in range(shards):
                held[u][j] += votes[k, j]
        want = {u: max((may[j] or shard[u] == j, held[u][j], hashed(("s", lead[u][1]), ("i", j)), j) for j in range(shards))[3] for u in lead}
        cut = sum(sum(held[u]) - held[u][shard[u]] for u in lead)
        if best is None or cut < best[0]:
            best, idle = (cut, dict(shard)), 0
        else:
            idle += 1
        moves = Counter((shard[u], want[u]) for u in lead if shard[u] != want[u])
        if not moves or idle >= S.PATIENCE:
            return best[1], best[0]
        share = S.quotas(moves, sizes, capacity)
        for u in lead:
            i, j = shard[u], want[u]
            crowded = lead[u][0] > capacity / S.CROWD
            ticket = hashed(("l", u) if crowded else ("s", lead[u][1]), ("i", turn)) % S.UNIT
            if i != j and ticket < share.get((i, j), 0.0) * S.UNIT:
                shard[u] = j
                sizes[i], sizes[j] = sizes[i] - 1, sizes[j] + 1
        turn += 1


@pytest.mark.parametrize("several", [False, True])
def test_propagation_equals_plain_python(spark, several):
    """Groups of all sizes, chains of links where rows have several keys, and a hot key."""
    import random
    rng = random.Random(several)
    rows = [(u, f"g{u // 5}") for u in range(200)] + [(u, "hot") for u in range(200, 320)] + [(u, f"s{u}") for u in range(320, 420)]
    if several:
        rows += [(u, f"c{u // 2}") for u in range(1, 200, 3)] + [(u, f"x{rng.randrange(12)}") for u in rng.sample(range(420), 90)]
        rows = sorted(set(rows))
    frame = spark.createDataFrame(rows, "uid bigint, key string")
    got = {r.uid: r.shard for r in S.propagate(frame).collect()}
    want, cut = plain_propagation(rows)
    assert got == want
    start = {u: hashed(("l", u)) % 8 for u in want}
    groups = defaultdict(list)
    for u, k in rows:
        groups[k].append(u)
    crossing = lambda at: sum(at[a] != at[b] for us in groups.values() if len(us) > 1 for a in us for b in us)
    assert crossing(want) == cut < crossing(start)

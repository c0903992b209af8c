"""Sharding by balanced label propagation (operator 2).

Documents that share a link key (here: equal texts) should share a shard, and
all shards should hold as many rows, one more or less at most (law ``rows``).

A row may have several link keys. Every row starts in the shard of its row number's hash. In a round each key
counts its members per shard (a grouped sum, then a join back), and each linked
row adds these counts up over its keys and wants the shard with most neighbours, of its own and those not full;
ties go by a hash of its largest key and shard, so members of one group agree. Per pair of shards, moves that are matched by moves the other
way are all let through, others as far as the target shard's room for linked
rows (an equal share of all rows, or ``1 + SLACK`` of one of the linked rows) allows; where a quota cuts, whole keys
go or stay by their hash, and members of keys over ``1 / CROWD`` of a shard by
their own. Rounds end when no row wishes to move, or when the cut (links between shards) has not fallen for
``PATIENCE`` rounds; the state with the smallest cut stands. Only the 8 x 8 table of wishes comes
to the driver.

Finally each shard's rows get gapless slots: linked rows first, key by key,
single rows last. Slots beyond the equal share are dealt out to shards with room,
so single rows, which cut no link, move first. Slot numbers come from counts of
(shard, part) added up over a bounded number of parts, never from one long sort.

Defined results: null text is the empty text, its size is 1. Very long texts are read for their size and hash only. Null and repeated
ids are rows like any other. With fewer rows than shards some shards stay
empty; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import partitions, read_table, stored

SHARDS, SLACK, CROWD = 8, 0.05, 16
PATIENCE = 3  # rounds in a row that do not lower the cut before propagation ends
UNIT = 1 << 20


def choose(values: list, c: Column) -> Column:
    """``values[c]``."""
    return F.get(F.array(*[F.lit(v) for v in values]), c)


def linked(rows: DataFrame) -> DataFrame:
    """(uid, key, total): rows of ``rows`` (uid, key) whose key is shared, with the number of its members; a row may have several keys."""
    # stored, so that the join has two plain sides and a key of very many rows can be split
    shared = stored(rows.groupBy("key").agg(F.count("*").alias("total")).where("total > 1"), "shared")
    return rows.select("uid", "key").join(shared, "key").select("uid", "key", "total")


def wishes(state: DataFrame, links: DataFrame, open_to: list[bool]) -> DataFrame:
    """``state`` (uid, key, total, shard) with ``want``: of the row's own and the open shards, the one that holds most neighbours over all its ``links``."""
    shards = range(len(open_to))
    there = links.join(state.select("uid", "shard"), "uid")
    votes = stored(there.groupBy("key").agg(*[F.count(F.when(F.col("shard") == k, 1)).alias(f"n{k}") for k in shards]), "votes")
    held = links.join(votes, "key").groupBy("uid").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in shards])
    best = F.array_max(F.array(*[F.struct(
        (F.lit(open_to[k]) | (F.col("shard") == k)).alias("may"), F.col(f"n{k}").alias("n"), F.xxhash64("key", F.lit(k)).alias("tie"), F.lit(k).alias("to")) for k in shards]))
    return state.join(held, "uid").select("uid", "key", "total", "shard", best["to"].alias("want"), F.aggregate(
        F.array(*[F.col(f"n{k}") for k in shards]), F.lit(0).cast("bigint"), lambda a, n: a + n).alias("all"), F.get(F.array(*[F.col(f"n{k}") for k in shards]), F.col("shard")).alias("near"))


def quotas(moves: dict[tuple[int, int], int], sizes: list[int], capacity: float) -> dict[tuple[int, int], float]:
    """The share of each (from, to) wish that is let through."""
    shards = range(len(sizes))
    swapped = {(i, j): min(moves.get((i, j), 0), moves.get((j, i), 0)) for i in shards for j in shards if i != j}
    out = {}
    for j in shards:
        extra = {i: moves.get((i, j), 0) - swapped[i, j] for i in shards if i != j}
        room = max(0.0, capacity - sizes[j])
        share = min(1.0, room / sum(extra.values())) if sum(extra.values()) else 1.0
        for i, e in extra.items():
            if moves.get((i, j), 0):
                out[i, j] = (swapped[i, j] + share * e) / moves[i, j]
    return out


def propagate(rows: DataFrame, shards: int = SHARDS, slack: float = SLACK) -> DataFrame:
    """(uid, key, total, shard) of linked rows after balanced label propagation; ``rows`` has uid and key, several rows for a uid with several keys.

    ``key`` and ``total`` of the result are those of the uid's largest group.
    """
    n = rows.select("uid").distinct().count()
    links = stored(linked(rows), "links")
    lead = links.groupBy("uid").agg(F.max(F.struct("total", "key")).alias("lead"))
    state = stored(lead.select("uid", "lead.key", "lead.total").withColumn("shard", home("uid", shards)), "shards")
    sizes = [0] * shards  # of linked rows; single rows make room for them in the end
    for r in state.groupBy("shard").count().collect():
        sizes[r["shard"]] = r["count"]
    capacity = max(n, (1 + slack) * sum(sizes)) / shards
    turn, best, idle = 0, None, 0
    while True:
        wish = stored(wishes(state, links, [size < capacity - 0.5 for size in sizes]), "wishes")
        cut = wish.agg(F.sum(F.col("all") - F.col("near"))).first()[0] or 0     # links of all rows to other shards
        best, idle, state_best = (cut, 0, state) if best is None or cut < best else (best, idle + 1, state_best)
        moves = {(r["shard"], r["want"]): r["count"] for r in wish.where("shard <> want").groupBy("shard", "want").count().collect()}
        if not moves or idle >= PATIENCE:
            break
        share = quotas(moves, sizes, capacity)
        crowded = F.col("total") > capacity / CROWD
        ticket = F.pmod(F.when(crowded, F.xxhash64("uid", F.lit(turn))).otherwise(F.xxhash64("key", F.lit(turn))), F.lit(UNIT))
        table = [share.get((i, j), 0.0) * UNIT for i in range(shards) for j in range(shards)]
        go = (F.col("shard") != F.col("want")) & (ticket < choose(table, F.col("shard") * shards + F.col("want")))
        state = stored(wish.select("uid", "key", "total", F.when(go, F.col("want")).otherwise(F.col("shard")).alias("shard"), go.alias("moved"), F.col("shard").alias("was")), "shards")
        for r in state.where("moved").groupBy("was", "shard").count().collect():
            sizes[r["was"]] -= r["count"]
            sizes[r["shard"]] += r["count"]
        turn += 1
    return state_best.select("uid", "key", "total", "shard")


def home(uid: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(uid), F.lit(shards)).cast("int")


def level(rows: DataFrame, placed: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(uid, shard, slot) of every row: sizes one apart at most, slots gapless from 0 in each shard."""
    parts = 4 * partitions(rows.sparkSession)
    n = rows.count()
    all_rows = rows.select("uid").join(placed, "uid", "left")
    single = F.col("key").isNull()
    spread = single | (F.col("total") > F.lit(n / (shards * CROWD)))
    part = F.pmod(F.when(spread, F.xxhash64("uid", F.lit(2))).otherwise(F.xxhash64("key", F.lit(2))), F.lit(parts)).cast("int")
    at = all_rows.select("uid", F.coalesce("shard", home("uid", shards)).alias("shard"), (single.cast("int") * parts + part).alias("part"),
                         F.when(~single, F.col("key")).alias("key"))
    at = stored(at, "placed")
    counts = at.groupBy("shard", "part").count()
    ahead = F.coalesce(F.sum("count").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("shard", "part", ahead.alias("ahead"))
    inside = F.row_number().over(W.partitionBy("shard", "part").orderBy("key", "uid")) - 1
    numbered = at.withColumn("inside", inside).join(offsets, ["shard", "part"]).withColumn("slot", F.col("ahead") + F.col("inside"))
    sizes = [0] * shards
    for r in at.groupBy("shard").count().collect():
        sizes[r["shard"]] = r["count"]
    longer = sorted(range(shards), key=lambda k: -sizes[k])[: n % shards]
    target = [n // shards + (k in longer) for k in range(shards)]
    over = [max(0, s - t) for s, t in zip(sizes, target)]
    room = [max(0, t - s) for s, t in zip(sizes, target)]
    before = [sum(over[:k]) for k in range(shards)]
    spare = F.col("slot") - choose(target, F.col("shard")) + choose(before, F.col("shard"))
    shard, slot, filled = F.col("shard"), F.col("slot"), 0
    beyond = F.col("slot") >= choose(target, F.col("shard"))
    for k in range(shards):
        if room[k]:
            here = beyond & (spare >= filled) & (spare < filled + room[k])
            shard, slot = F.when(here, F.lit(k)).otherwise(shard), F.when(here, spare - filled + sizes[k]).otherwise(slot)
            filled += room[k]
    return numbered.select("uid", shard.cast("int").alias("shard"), slot.cast("bigint").alias("slot"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = stored(read_table(spark, sf_dir, "documents").select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("key")), "documents")
    placed = level(docs, propagate(docs))
    return docs.join(placed, "uid").select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

"""SimHash near-duplicate groups by bit-sliced comparison (operator 1).

Fingerprints: ASCII-lower-cased whole text, words ``[^\\x20\\x09-\\x0D]+``,
``shingle``-word shingles with repeats, XXH64 (seed 42) of each; a bit is set
if it is set in over half of the hashes.

Linking: the 64 bits are cut into ``blocks`` blocks. Two fingerprints within
``radius`` bits agree on at least ``blocks - radius`` of them, so every choice
of that many blocks is one exact key table and each linked pair meets in at
least one bucket. A bucket of more than ``tile`` distinct fingerprints is dealt
out as pairs of chunks, so it is spread over tasks and no pair is lost. Within a
task the fingerprints lie as 64 vertical bit planes; lane i is compared with
lane i + lag for all lanes at once, carry-save counters add up the differing
planes, and 64-lane blocks are abandoned once every lane in them is beyond the
radius. Only a spanning forest of each bucket leaves the task.

Defined results: null or empty text, or text without words, has fingerprint 0
and links like any other. Very long texts are hashed whole, ``1 << 16`` shingles at a time. Equal fingerprints are one node, so copies are never
expanded. A null id never becomes a component id unless every id of the
component is null. Repeated rows each get their row. An empty table gives an
empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, read_table, stored, tidy

SEED = 42
SHINGLE, RADIUS, BLOCKS, TILE = 4, 4, 6, 4096
LANES = 1 << 16  # lanes gathered before a comparison
WORDS = 4096  # 64-lane words compared at once


def simhash64(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of one UTF-8 text."""
    words = text.lower().split()
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    h = xxhash.xxh64_intdigest
    if n <= shingle:
        return h(joined, SEED)
    lens = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[: n - shingle + 1].tolist()
    hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, text_hash, fp): one row per input row; ``fp`` holds the 64 bits as a signed long."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("binary").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([simhash64(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle) for x in b.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64), pa.int64())], names=["id", "text_hash", "fp"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"id {kind}, text_hash bigint, fp bigint")


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(64, words) uint64: bit i of word w of plane b is bit b of lane 64 w + i. Two spare words at the end."""
    words = -(-len(fps) // 64)
    bits = np.zeros((words * 64, 64), np.uint8)
    bits[: len(fps)] = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)
    return np.concatenate([packed, np.zeros((64, 2), np.uint64)], axis=1)


def within_radius(planes: np.ndarray, word: np.ndarray, lag: np.ndarray, alive: np.ndarray, radius: int) -> np.ndarray:
    """For each (word, lag): the lanes of ``alive`` whose fingerprint differs from that ``lag`` lanes on in at most ``radius`` bits."""
    top = planes.shape[1] - 1
    ahead, shift = word + (lag >> 6), (lag & 63).astype(np.uint64)
    low, high = np.minimum(ahead, top), np.minimum(ahead + 1, top)
    back = np.uint64(63) - shift
    one = np.uint64(1)
    slots = int(radius).bit_length()
    counter = [np.zeros(len(word), np.uint64) for _ in range(slots)]
    over = ~alive  # lanes that have left the radius, or were never compared
    where = np.arange(len(word))
    for b in range(64):
        p = planes[b]
        carry = p[word] ^ ((p[low] >> shift) | ((p[high] << one) << back))
        for s in range(slots):  # carry-save: add the plane to the vertical counters
            carry, counter[s] = counter[s] & carry, counter[s] ^ carry
        over |= carry
        if b % 8 == 7 or b == 63:
            more = np.zeros_like(over)  # counter > radius, from the highest bit down
            same = ~more
            for s in range(slots - 1, -1, -1):
                if radius >> s & 1:
                    same &= counter[s]
                else:
                    more |= same & counter[s]
                    same &= ~counter[s]
            over |= more
            keep = np.flatnonzero(~over)  # abandon blocks whose lanes are all beyond the radius
            if len(keep) < len(over):
                word, low, high, shift, back, over, where = (x[keep] for x in (word, low, high, shift, back, over, where))
                counter = [c[keep] for c in counter]
            if not len(keep):
                break
    out = np.zeros(len(alive), np.uint64)
    out[where] = ~over
    return out


def spanning_forest(fps: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Lanes and the roots that they are joined to; ``group`` holds runs of equal bucket numbers."""
    n = len(fps)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, n])
    which = np.repeat(np.arange(len(first)), size)
    end = np.repeat(first + size, size)
    parts = size.astype(np.int64)  # components left in each bucket
    parent = np.arange(n)
    planes = bit_planes(fps)
    lane = np.arange(n)

    def find(x: np.ndarray) -> np.ndarray:
        x = parent[x]
        while (y := parent[x]).tobytes() != x.tobytes():
            x = y
        return x

    lag, largest = 1, int(size.max(initial=0))
    while lag < largest:
        live = np.flatnonzero((end - lane > lag) & (parts[which] > 1))
        if not len(live):
            break
        words = np.unique(live >> 6)
        lags = np.arange(lag, min(largest, lag + max(1, WORDS // len(words))))
        mask = np.zeros((len(lags), planes.shape[1] * 64), np.uint8)
        for k, x in enumerate(lags):
            mask[k, live] = end[live] - live > x
        alive = np.packbits(mask, axis=1, bitorder="little").view(np.uint64)[:, words].ravel()
        word, each = np.tile(words, len(lags)), np.repeat(lags, len(words))
        hit = within_radius(planes, word, each, alive, radius)
        at = np.flatnonzero(hit)
        if len(at):
            on, bit = np.nonzero(np.unpackbits(hit[at].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            i = word[at][on] * 64 + bit
            j = i + each[at][on]
            ri, rj = find(i), find(j)
            for a, b in {*zip(ri[ri != rj].tolist(), rj[ri != rj].tolist())}:
                while parent[a] != a:
                    a = parent[a]
                while parent[b] != b:
                    b = parent[b]
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    parts[which[a]] -= 1
        lag = int(lags[-1]) + 1
    root = find(lane)
    moved = np.flatnonzero(root != lane)
    return moved, root[moved]


def links(nodes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """(a, b): pairs of distinct fingerprints of ``nodes.fp`` that span every linked group."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("blocks must exceed radius")
    cuts = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = [sum(((1 << cuts[k + 1]) - (1 << cuts[k])) for k in pick) for pick in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = nodes.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("key")) for k, m in enumerate(signed)])).alias("at")).select("at.k", "at.key", "fp")
    # stored, so that the join has two plain sides and a bucket of very many fingerprints can be split
    crowded = stored(keyed.groupBy("k", "key").count().where("count > 1"), "crowded")
    met = keyed.join(crowded, ["k", "key"])
    chunks = F.ceil(F.col("count") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    both = F.when(chunks == 1, F.array(F.lit(0))).otherwise(F.transform(
        F.filter(F.sequence(F.lit(0), chunks - 1), lambda c: c != own),
        lambda c: F.least(own, c) * chunks + F.greatest(own, c)))
    tiles = met.select("k", "key", F.explode(both).alias("tile"), "fp")
    dealt = tiles.repartition(partitions(nodes.sparkSession), "k", "key", "tile").sortWithinPartitions("k", "key", "tile", "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, count
            rows = np.concatenate(held)
            turn = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
            upto = len(rows) if last else (int(turn[-1]) if len(turn) else 0)
            held, count = [rows[upto:]], len(rows) - upto
            if upto:
                rows = rows[:upto]
                group = np.zeros(upto, np.int64)
                group[turn[turn < upto]] = 1
                fps = np.ascontiguousarray(rows[:, 3])
                a, b = spanning_forest(fps.view(np.uint64), np.cumsum(group), radius)
                yield pa.RecordBatch.from_arrays([pa.array(fps[a]), pa.array(fps[b])], names=["a", "b"])

        for b in batches:
            if b.num_rows:
                held.append(np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(4)], axis=1))
                count += b.num_rows
                if count >= LANES:
                    yield from flush(False)
        if count:
            yield from flush(True)

    return dealt.mapInArrow(tidy(compare), "a bigint, b bigint")


def stars(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` but the roots: connected components by alternating large and small stars.

    Every step is a grouped minimum and a join. The minima are stored, so that a hub is pre-aggregated and
    its join has two plain sides, which can be split; each round is written to the shared folder.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = now.union(now.select("b", "a"))
        low = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
        large = stored(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        small_low = stored(large.groupBy("a").agg(F.min("b").alias("m")), "small-low")
        small = large.join(small_low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        now = stored(small, "edges")
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if mark == seen or not mark["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """(id, text_hash, fp, component_id, root): one row per document; the component id is the smallest id reachable over links.

    ``root`` is one fingerprint of the component: ids may repeat over components, roots do not.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    linked = stars(links(nodes.select("fp"), radius, blocks, tile))
    member = linked.union(linked.select(F.col("root").alias("node"), "root").distinct())
    least = member.join(nodes, member.node == nodes.fp).groupBy("root").agg(F.min("least").alias("component"))
    named = member.join(least, "root").select(F.col("node").alias("fp"), "component", "root")
    # stored, so that the last join has two plain shuffles and a fingerprint of very many rows can be split
    ids = stored(nodes.join(named, "fp", "left").select("fp", F.coalesce("component", "least").alias("component_id"), F.coalesce("root", "fp").alias("root")), "ids")
    return prints.join(ids, "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` with one row left of each component: the smallest id (nulls last), then the smallest text hash."""
    found = components(docs, id_col, text_col, **how)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first"))
    # several components may choose rows with one id and one text hash only if these rows are equal in both, so one component holds them
    stay = first.select(F.col("first.id").alias("stay_id"), F.col("first.text_hash").alias("stay_hash"))
    names = docs.columns
    kept = docs.alias("d").join(stay.alias("s"), F.col(f"d.`{id_col}`").eqNullSafe(F.col("s.stay_id")) & (F.xxhash64(F.col(f"d.`{text_col}`")) == F.col("s.stay_hash")), "inner")
    one = kept.groupBy("s.stay_id", "s.stay_hash").agg(*[F.first(F.struct(*[F.col(f"d.`{c}`") for c in names])).alias("row")])
    return one.select("row.*")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""Removal of repeated byte strings by suffix arrays over shards (operator 12).

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else, in the same text or another. Strings are judged on the input.

Dealing out. The windows (strings of ``length`` bytes) of a text are cut into
stretches by their anchors: a window's anchor is the ``GRAM``-byte string in it
with the smallest hash, the leftmost of equal ones. Equal windows have equal
anchors, so all places of a string meet under one key. A stretch is sent as 40
bytes of facts (place, key, hash of its bytes), about one per 170 bytes of text;
keys that stand once in the corpus are done with. Stretches of equal bytes are
counted as one; when a key has several different ones, their bytes are fetched
and judged in shards.

Shards. Whole keys are dealt to shards of about ``SHARD`` bytes; a key with more
is split over several. Every shard sorts its suffixes by Larsson-Sadakane
refinement in numpy (ranks by the first seven bytes, then only unsorted groups are
refined by the rank h bytes on, h doubling), takes common prefixes of neighbours
by Kasai's walk in text order (many lanes in step, eight bytes a comparison) and
marks windows that a neighbour in suffix order shares. The shards of a split key
are then merged: each sends one place of every different window as a sorted run
of 128-bit digests, cut at even splitters by binary search; the runs of a piece
are merged two by two by binary search, and windows in two runs are marked.

Defined results: null text is empty; texts under ``length`` bytes keep all. Very
long texts are processed whole, in overlapping stretches of ``LONG`` windows.
Repeated rows are copies, so everything of ``length`` bytes or more in them goes. A
null id stays null; ids may repeat. An empty table gives an empty result. What is
kept is bytes, as a cut may fall inside a character. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, row_blocks, stored, tidy

LENGTH = 400
GRAM = 64
PIECE = 1 << 20  # bytes of texts handled at once
LONG = 4 << 20  # windows of a text handled at once
SHARD = 1 << 20  # bytes of a shard
LANES = 4096
LOW = np.uint64((1 << 23) - 1)  # a window's smallest hash carries its place in the low bits
BASE = 0x9E3779B97F4A7C15 | 1
FENCE = 0xFF  # no byte of UTF-8


@lru_cache(maxsize=4)
def powers(n: int, base: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:n]


def gram_hashes(body: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each ``gram`` bytes, by differences of a polynomial prefix sum modulo 2^64, mixed."""
    size = 1 << max(16, int(len(body)).bit_length())
    back, ahead = powers(size, pow(BASE, -1, 1 << 64)), powers(size, BASE)
    total = np.zeros(len(body) + 1, np.uint64)
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * back[:len(body)], out=total[1:])
    x = (total[gram:] - total[:-gram]) * ahead[:len(body) - gram + 1]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours: running minima from both ends of blocks."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def stretches(bodies: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, start, n, key, content): the runs of ``n`` windows of each text that have one anchor."""
    out: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 5]
    pieces: list[tuple[int, int, bytes]] = []
    for t, body in enumerate(bodies):
        for at in range(0, max(0, len(body) - length + 1), LONG):
            pieces.append((t, at, body[at:at + LONG + length - 1]))
    for a, z in row_blocks([len(p[2]) for p in pieces], PIECE):
        part = pieces[a:z]
        joined = b"".join(p[2] for p in part)
        body = np.frombuffer(joined, np.uint8)
        h = gram_hashes(body, gram)
        least = sliding_min((h & ~LOW) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
        anchor = (least & LOW).astype(np.int64)
        size = np.array([len(p[2]) for p in part])
        begin = np.cumsum(size) - size
        count = size - length + 1  # windows
        place = np.arange(count.sum()) + np.repeat(begin - (np.cumsum(count) - count), count)
        which = np.repeat(np.arange(len(part)), count)
        anchor = anchor[place]
        first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (which[1:] != which[:-1])])
        n = np.diff(np.r_[first, len(place)])
        start = place[first]
        content = np.frombuffer(b"".join([blake2b(joined[s:e], digest_size=8).digest() for s, e in zip(start.tolist(), (start + n + length - 1).tolist())]), np.int64)
        w = which[first]
        out.append((np.array([p[0] for p in part])[w], start - begin[w] + np.array([p[1] for p in part])[w], n, h[anchor[first]].view(np.int64), content))
    return tuple(np.concatenate(x) for x in zip(*out))


def suffix_array(body: np.ndarray) -> np.ndarray:
    """All suffixes in order, the end smallest, by Larsson-Sadakane refinement."""
    n = len(body)
    padded = np.concatenate([body.astype(np.int64) + 1, np.zeros(7, np.int64)])
    word = np.zeros(n, np.int64)
    for k in range(7):
        word = word * 257 + padded[k:k + n]
    order = np.argsort(word, kind="stable")
    rank = np.zeros(n + 1, np.int64)  # place of the first suffix of the group, from 1; 0 past the end
    group = np.maximum.accumulate(np.where(np.r_[True, word[order[1:]] != word[order[:-1]]], np.arange(n), 0)) + 1
    rank[order] = group
    h, at = 7, np.arange(n)
    while True:
        tie = group[1:] == group[:-1]
        tied = np.flatnonzero(np.r_[tie, False] | np.r_[False, tie])
        if not len(tied):
            return order
        at, group = at[tied], group[tied]  # places of unsorted groups
        part = order[at]
        key = (group << 32) | rank[np.minimum(part + h, n)]
        by = np.argsort(key, kind="stable")
        key, part = key[by], part[by]
        order[at] = part
        group = at[np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(len(at)), 0))] + 1
        rank[part] = group
        h *= 2


def common_prefixes(body: np.ndarray, order: np.ndarray, most: int, lanes: int = LANES) -> np.ndarray:
    """Common prefix, up to ``most``, of each suffix with the one before it in ``order``, by Kasai's walk: the text is walked in order by
    ``lanes`` walkers in step, each over its own part; what a place shares with its neighbour, less one, the next place shares at least."""
    n = len(body)
    total = n + most + 8
    padded = np.zeros(total + 8, np.uint8)
    padded[:n] = body
    word = np.zeros(total, np.uint64)
    for k in range(8):
        word |= padded[k:k + total].astype(np.uint64) << np.uint64(8 * k)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    step = -(-n // lanes)
    at = np.arange(0, n, step)
    end = np.minimum(at + step, n)
    h = np.zeros(len(at), np.int64)
    while len(at):
        prev = before[at]
        diff = word[at + h] ^ word[np.maximum(prev, 0) + h]
        go = (diff == 0) & (prev >= 0) & (h < most)
        h[go] += 8
        k = np.flatnonzero(~go)
        d = diff[k]
        lowest = np.maximum(d & (~d + np.uint64(1)), np.uint64(1)).astype(np.float64)  # a power of two, exact
        length = np.where(prev[k] < 0, 0, np.minimum(h[k] + (np.log2(lowest).astype(np.int64) >> 3), most))
        out[at[k]] = length
        h[k] = np.maximum(length - 1, 0)
        at[k] += 1
        more = at < end
        if not more.all():
            at, end, h = at[more], end[more], h[more]
    return out[order]


def spans_of(mark: np.ndarray) -> list[int]:
    """[from, to, from, to, ...] of the runs of true."""
    return np.flatnonzero(np.diff(np.r_[False, mark, False].astype(np.int8))).tolist()


def judge(bodies: list[bytes], length: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each stretch of one shard: which of its windows come again in the shard, and which are the first of equal ones in suffix order."""
    body = np.frombuffer(b"".join(x + bytes([FENCE]) for x in bodies), np.uint8)
    order = suffix_array(body)
    like = common_prefixes(body, order, length) >= length
    again, first = np.zeros(len(body), bool), np.zeros(len(body), bool)
    again[order] = like | np.r_[like[1:], False]
    first[order] = ~like
    ends = np.cumsum([len(x) + 1 for x in bodies]).tolist()
    cut = [(e - len(x) - 1, e - length) for e, x in zip(ends, bodies)]
    return [again[a:z] for a, z in cut], [first[a:z] for a, z in cut]


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]], marked: np.ndarray) -> None:
    """Sorted runs of (digest, number), distinct within a run, merged two by two by binary search; ``marked`` is set for numbers whose digest is in two runs."""
    while len(runs) > 1:
        merged = []
        for (a, number_a), (b, number_b) in zip(runs[::2], runs[1::2]):
            at = np.searchsorted(a, b)
            hit = np.zeros(len(b), bool)
            inside = at < len(a)
            hit[inside] = a[at[inside]] == b[inside]
            marked[number_a[at[hit]]] = marked[number_b[hit]] = True
            merged.append((np.insert(a, at[~hit], b[~hit]), np.insert(number_a, at[~hit], number_b[~hit])))
        runs = merged + runs[len(runs) // 2 * 2:]


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, body): the rows numbered and their bytes compressed; stored."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b"")).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            for start, end in row_blocks(pc.binary_length(b.column(2)).to_pylist(), PIECE):
                part = b.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([pack.compress(x.as_buffer()) for x in part.column(2)], pa.binary())], names=["row", "id", "body"])

    return stored(rows.mapInArrow(tidy(run), f"row bigint, id {rows.schema['id'].dataType.simpleString()}, body binary"), "suffix-rows")


def opened(column: pa.Array) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(x.as_buffer()) for x in column]


def all_stretches(rows: DataFrame, length: int) -> DataFrame:
    """(row, start, n, key, content) of all texts; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, end in row_blocks(pc.binary_length(b.column(1)).to_pylist(), PIECE):
                part = b.slice(start, end - start)
                text, *rest = stretches(opened(part.column(1)), length)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(text)), *map(pa.array, rest)], names=["row", "start", "n", "key", "content"])

    return stored(rows.select("row", "body").mapInArrow(tidy(run), "row bigint, start bigint, n bigint, key bigint, content bigint"), "suffix-stretches")


def repeated_keys(found: DataFrame) -> DataFrame:
    """Stretches whose key stands at least twice in the corpus; stored. The counts are stored first, so that a key of very many rows can be split."""
    twice = stored(found.groupBy("key").agg(F.count("*").alias("places")).where("places > 1").select("key"), "suffix-twice")
    return stored(found.join(twice, "key"), "suffix-repeated")


def contents(repeated: DataFrame, length: int, shard: int) -> DataFrame:
    """(key, content, copies, row, start, n, shard, parts): one row per different stretch with one of its places; ``shard`` is null where it is alone under its key. Stored."""
    one = repeated.groupBy("key", "content").agg(F.count("*").alias("copies"), F.min(F.struct("row", "start", "n")).alias("at"))
    one = stored(one.select("key", "content", "copies", "at.*"), "suffix-contents")
    sizes = stored(one.groupBy("key").agg(F.count("*").alias("others"), F.sum(F.col("n") + length).alias("bytes")).where("others > 1").select("key", "bytes"), "suffix-sizes")
    total = sizes.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    shards, parts = -(-total // shard) or 1, F.ceil(F.col("bytes") / shard)
    part = F.pmod(F.xxhash64("content"), parts)
    where = F.when(parts == 1, F.pmod(F.xxhash64("key"), F.lit(shards))).when(parts > 1, F.xxhash64("key", part))
    return stored(one.join(sizes, "key", "left").select("key", "content", "copies", "row", "start", "n", where.alias("shard"), parts.cast("bigint").alias("parts")), "suffix-dealt")


def fetched(rows: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """``asked`` with the bytes of each stretch: (key, content, copies, shard, parts, body)."""
    wants = asked.groupBy("row").agg(F.collect_list(F.struct("start", "n", "key", "content", "copies", "shard", "parts")).alias("wants"))
    both = rows.select("row", "body").join(wants, "row").select("body", "wants")
    names = ["key", "content", "copies", "shard", "parts", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, end in row_blocks(pc.binary_length(b.column(0)).to_pylist(), PIECE):
                bodies = opened(b.column(0).slice(start, end - start))
                wants = b.column(1).slice(start, end - start)
                flat = wants.flatten()
                text = np.repeat(np.arange(len(bodies)), wants.value_lengths().to_numpy()).tolist()
                cut = [bodies[t][s:s + n + length - 1] for t, s, n in zip(text, flat.field("start").to_pylist(), flat.field("n").to_pylist())]
                for k in range(0, len(cut), 2000):
                    yield pa.RecordBatch.from_arrays([*(flat.field(c).slice(k, 2000) for c in names[:-1]), pa.array(cut[k:k + 2000], pa.binary())], names=names)

    return both.mapInArrow(tidy(run), "key bigint, content bigint, copies bigint, shard bigint, parts bigint, body binary")


def table_of(rows: list[tuple], kind: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows) if rows else [[]] * len(kind), kind)], schema=kind)


FOUND = pa.schema([("key", pa.int64()), ("content", pa.int64()), ("spans", pa.list_(pa.int32()))])


def judged(bodies: DataFrame, length: int) -> DataFrame:
    """(key, content, spans): windows of each stretch that come again in its shard. For split keys also the shard's sorted run of each piece:
    (key, piece, digests, contents, offsets) of one place of every different window."""
    kind = pa.schema([*FOUND, ("piece", pa.int32()), ("digests", pa.binary()), ("contents", pa.binary()), ("offsets", pa.binary())])

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("key", "ascending"), ("content", "ascending")])
        keys, content, copies, parts, texts = (t[c].to_pylist() for c in ("key", "content", "copies", "parts", "body"))
        again, first = judge(texts, length)
        out: list[tuple] = [(k, c, spans_of(mark), None, None, None, None) for k, c, m, mark in zip(keys, content, copies, again) if m == 1 and mark.any()]
        for key, p in {k: p for k, p in zip(keys, parts) if p > 1}.items():
            own = [i for i, k in enumerate(keys) if k == key]
            at = [np.flatnonzero(first[i]).astype(np.int32) for i in own]
            digest = np.array([blake2b(texts[i][s:s + length], digest_size=16).digest() for i, a in zip(own, at) for s in a.tolist()], "S16")
            by = np.argsort(digest, kind="stable")
            digest, who, at = digest[by], np.repeat([content[i] for i in own], [len(a) for a in at])[by].astype(np.int64), np.concatenate(at)[by]
            heads = digest.view(">u4").reshape(-1, 4)[:, 0].astype(np.int64)
            pieces = 4 * p
            cuts = np.searchsorted(heads, [-(-k * (1 << 32) // pieces) for k in range(pieces + 1)]).tolist()
            out += [(key, None, None, k, digest[a:z].tobytes(), who[a:z].tobytes(), at[a:z].tobytes()) for k, (a, z) in enumerate(zip(cuts[:-1], cuts[1:])) if z > a]
        pa.default_memory_pool().release_unused()
        return table_of(out, kind)

    return bodies.groupBy("shard").applyInArrow(run, "key bigint, content bigint, spans array<int>, piece int, digests binary, contents binary, offsets binary")


def merged_shards(runs: DataFrame) -> DataFrame:
    """(key, content, spans): windows of split keys that stand in two shards, found piece by piece."""

    def run(t: pa.Table) -> pa.Table:
        key = t["key"][0].as_py()
        digests, who, at = ([np.frombuffer(x, kind) for x in t[c].to_pylist()] for c, kind in (("digests", "S16"), ("contents", np.int64), ("offsets", np.int32)))
        begin = np.cumsum([0, *map(len, at)])
        marked = np.zeros(begin[-1], bool)
        merge_runs([(d, np.arange(a, z)) for d, a, z in zip(digests, begin[:-1], begin[1:])], marked)
        who, at = np.concatenate(who)[marked], np.concatenate(at)[marked].astype(np.int64)
        by = np.lexsort((at, who))
        who, at = who[by], at[by]
        out = [(key, int(who[a]), np.stack([at[a:z], at[a:z] + 1], 1).ravel().tolist()) for a, z in zip(*edges(who))]
        pa.default_memory_pool().release_unused()
        return table_of(out, FOUND)

    return runs.groupBy("key", "piece").applyInArrow(run, "key bigint, content bigint, spans array<int>")


def edges(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Bounds of the runs of equal values."""
    cut = np.flatnonzero(values[1:] != values[:-1]) + 1
    return ([0, *cut.tolist()], [*cut.tolist(), len(values)]) if len(values) else ([], [])


def repeated_windows(rows: DataFrame, length: int, shard: int) -> DataFrame:
    """(row, start, spans): stretches with windows that stand elsewhere too, as runs of windows counted from ``start``."""
    repeated = repeated_keys(all_stretches(rows, length))
    dealt = contents(repeated, length, shard)
    shards = stored(judged(fetched(rows, dealt.where("shard IS NOT NULL"), length), length), "suffix-shards")
    whole = dealt.where("copies > 1").select("key", "content", F.array(F.lit(0), F.col("n").cast("int")).alias("spans"))
    found = whole.union(shards.where("spans IS NOT NULL").select("key", "content", "spans"))
    split = dealt.where("parts > 1").limit(1).count()  # no key is split in most corpora
    if split:
        found = found.union(merged_shards(shards.where("piece IS NOT NULL").select("key", "piece", "digests", "contents", "offsets")))
    return repeated.select("key", "content", "row", "start").join(stored(found, "suffix-found"), ["key", "content"]).select("row", "start", "spans")


def covered(starts: list[int], spans: list[list[int]], length: int) -> list[tuple[int, int]]:
    """Maximal [start, end) of bytes under the given windows."""
    each = sorted((s + a, s + z - 1 + length) for s, x in zip(starts, spans) for a, z in zip(x[::2], x[1::2]))
    out: list[tuple[int, int]] = []
    for a, z in each:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """(id, n_bytes, spans, kept): of each whole text the maximal removed runs of bytes and what is left."""
    rows = numbered(docs, id_col, text_col)
    gone = repeated_windows(rows, length, shard).groupBy("row").agg(F.collect_list("start").alias("starts"), F.collect_list("spans").alias("windows"))
    both = rows.join(gone, "row", "left").select("id", "body", "starts", "windows")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, end in row_blocks(pc.binary_length(b.column(1)).to_pylist(), PIECE):
                part = b.slice(start, end - start)
                bodies = opened(part.column(1))
                spans = [covered(s, w, length) if s else [] for s, w in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
                kept = [b"".join(x[a:z] for a, z in zip([0, *(s[1] for s in gone)], [*(s[0] for s in gone), len(x)])) for x, gone in zip(bodies, spans)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in bodies], pa.int64()), pa.array([[{"start": a, "end": z} for a, z in s] for s in spans], kind),
                                                  pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])

    return both.mapInArrow(tidy(run), f"id {both.schema['id'].dataType.simpleString()}, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary")


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

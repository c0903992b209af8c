"""Language-model scores by context-tree weighting over bytes (operator 9).

A text is its UTF-8 bytes with A-Z lower-cased and a final NUL for the end. Each
byte is eight binary decisions, coded most significant bit first; every decision
node has its own context tree over the last ``depth`` bytes (NULs before the
start; the query takes ``QUERY_DEPTH``, which reaches beyond an average word). A
tree node keeps how often the bit was 0 and 1 there in the training texts; its
Krichevsky-Trofimov estimate is weighted half and half with the product of its
children's weighted probabilities:

    Pw(s) = 1/2 Pe(s) + 1/2 prod Pw(child s)        (Pe at full depth)

The learnt trees stay fixed while scoring: a bit's probability mixes the
estimates along its context path, each node taking the share 1/2 Pe / Pw of what
the nodes above left over, unseen nodes counting 1/2.

In Spark: the corpus is packed once into blocks of at most ``BLOCK`` bytes. Each
block sends its distinct (context, byte) grams with their training counts, and its
words, to ranges dealt out by the ``NEAR`` nearest context bytes: one row for a
block and range, grams sorted and sent as differences, so a gram takes about one
and a half bytes. A range adds up the counts of all blocks and builds its trees,
deepest nodes first; it is stored as one row together with its blocks' lists. Only
the depths above NEAR meet on the driver (at most 255 decisions for each seen pair
of bytes), which sends them back with the second pass. That pass gives every gram,
seen in training or not, its log probability, and each block gets back the values
of its own grams and words alone, as fixed-point numbers, so sums of them don't
depend on their order. No larger part of the model is ever on the driver or
broadcast, and what is gathered grows with the corpus.

Defined results: null text is empty and has its end only. Very long texts are
scored whole; one longer than ``BLOCK`` is a block of its own. A null id hashes as
empty text. Without training rows all estimates are 1/2 a bit. Repeated rows
each get their row and each count in training; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import io
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, partitions, read_table, row_blocks, stored, tidy

DEPTH = 4  # context bytes unless given; a gram is one byte more, eight bytes at most
QUERY_DEPTH = 6  # context bytes of op9_ctw
NEAR = 3  # trees are dealt out by so many nearest context bytes
BLOCK = 24 << 20
PIECE = 2 << 20  # bytes whose grams are handled at once
GROUP = 1 << 17  # grams of about so many are made into trees at once
POINT = 1 << 32  # values are sent as multiples of 1 / POINT
HALF = math.log(0.5)
FREE = np.uint64(0xFFFFFFFFFFFFFFFF)  # no gram: 0xFF is no byte of UTF-8


def normalised(text: str) -> bytes:
    return text.encode().lower()


def grams(texts: list[bytes], depth: int = DEPTH) -> np.ndarray:
    """Packed grams of all texts: the nearest context byte highest, then farther ones, the byte itself lowest."""
    pad = bytes(depth)
    joined = np.frombuffer(b"".join(x for t in texts for x in (pad, t, b"\0")), np.uint8)
    out = joined.astype(np.uint64)
    for k in range(1, depth + 1):
        out[k:] |= joined[:-k].astype(np.uint64) << np.uint64(8 * (depth + 1 - k))
    keep = np.ones(len(joined), bool)
    at = np.cumsum([0] + [len(t) + depth + 1 for t in texts[:-1]])
    for k in range(depth):
        keep[at + k] = False
    return out[keep]


def pieces(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    return row_blocks([*map(len, texts)], PIECE)


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and their summed counts."""
    key, n = np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, np.int64), *counts])
    by = np.argsort(key, kind="stable")
    key = key[by]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n[by], first) if len(first) else n


def gram_counts(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [], []
    for a, b in pieces(texts):
        k = np.sort(grams(texts[a:b], depth))
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        keys.append(k[first])
        counts.append(np.diff(np.r_[first, len(k)]))
    return added(keys, counts)


def squeezed(x: np.ndarray) -> bytes:
    """Eight-byte numbers, compressed byte plane by byte plane."""
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).data) if len(x) else b""


def loosened(body: bytes, kind: type = np.int64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8).reshape(8, -1).T).view(kind).ravel() if body else np.zeros(0, kind)


def squeezed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return squeezed(np.diff(keys, prepend=np.uint64(0)))


def loosened_keys(body: bytes) -> np.ndarray:
    return np.cumsum(loosened(body, np.uint64), dtype=np.uint64)


def squeezed_words(words: list[bytes]) -> bytes:
    """Words hold no white space."""
    return zstandard.ZstdCompressor(level=3).compress(b" ".join(words)) if words else b""


def loosened_words(body: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(body).split(b" ") if body else []


def pack(docs: DataFrame, id_col: str, text_col: str, out: Column, block: int = BLOCK) -> DataFrame:
    """(block, docs): the rows as compressed Arrow streams of at most ``block`` bytes of text, or one row; stored."""
    rows = docs.select(F.col(id_col).alias("id"), out.alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal count, size
            sink = io.BytesIO()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                for x in held:
                    w.write_batch(x)
            held.clear()
            count, size = count + 1, 0
            return pa.RecordBatch.from_pydict({"block": pa.array([(task << 32) + count], pa.int64()), "docs": pa.array([sink.getvalue()], pa.binary())})

        for b in batches:
            start = 0
            for k, n in enumerate(pc.binary_length(b.column(2)).to_pylist()):
                if size and size + n > block:
                    if k > start:
                        held.append(b.slice(start, k - start))
                    yield flush()
                    start = k
                size += n
            if start < b.num_rows:
                held.append(b.slice(start))
        if held:
            yield flush()

    return stored(rows.mapInArrow(tidy(run), "block bigint, docs binary"), "blocks")


def unpack(docs: bytes) -> tuple[pa.Table, list[bytes], np.ndarray]:
    table = pa.ipc.open_stream(docs).read_all()
    return table, [normalised(t) for t in table["text"].to_pylist()], table["held_out"].to_numpy()


def ranges_of(gram: np.ndarray, depth: int, ranges: int) -> np.ndarray:
    """The range of each gram, by its NEAR nearest context bytes."""
    near = gram >> np.uint64(8 * (depth + 1 - NEAR))
    return ((near * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(ranges)).astype(np.int32)


LISTS = "range int, block bigint, grams binary, counts binary, words binary, word_counts binary"


def block_lists(packed: DataFrame, depth: int, ranges: int) -> DataFrame:
    """One row for a block and range: the block's distinct grams and words there with their training counts, 0 for those only in held-out rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, docs in zip(b.column(0).to_pylist(), b.column(1)):
                _, texts, out = unpack(docs.as_py())
                train, rest = [t for t, h in zip(texts, out) if not h], [t for t, h in zip(texts, out) if h]
                words: Counter = Counter()
                for t in train:
                    words.update(t.split())
                for t in rest:
                    words.update(dict.fromkeys(t.split(), 0))
                (keys, counts), more = gram_counts(train, depth), gram_counts(rest, depth)[0]
                keys, counts = added([keys, more], [counts, np.zeros(len(more), np.int64)])
                where = ranges_of(keys, depth, ranges)
                by = np.argsort(where, kind="stable")
                keys, counts = keys[by], counts[by]
                cut = np.searchsorted(where[by], np.arange(ranges + 1)).tolist()
                own: dict[int, list[bytes]] = {}
                for w in words:
                    own.setdefault(zlib.crc32(w) % ranges, []).append(w)
                for r, (a, z) in enumerate(zip(cut[:-1], cut[1:])):
                    mine = sorted(own.get(r, []))
                    if z > a or mine:
                        yield pa.RecordBatch.from_pydict({
                            "range": pa.array([r], pa.int32()), "block": pa.array([block], pa.int64()), "grams": [squeezed_keys(keys[a:z])], "counts": [squeezed(counts[a:z])],
                            "words": [squeezed_words(mine)], "word_counts": [squeezed(np.array([words[w] for w in mine], np.int64))]})

    return packed.mapInArrow(tidy(run), LISTS)


def log_gamma(x: np.ndarray) -> np.ndarray:
    shift, y = np.zeros_like(x), x.copy()
    for _ in range(8):
        shift -= np.log(y)
        y += 1
    return shift + (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5)


SMALL = 4096  # counts below are looked up
HALVES, WHOLES = log_gamma(np.arange(SMALL) + 0.5), log_gamma(np.arange(SMALL) + 1.0)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    both = zeros + ones
    out = HALVES[np.minimum(zeros, SMALL - 1).astype(np.int64)] + HALVES[np.minimum(ones, SMALL - 1).astype(np.int64)] - WHOLES[np.minimum(both, SMALL - 1).astype(np.int64)]
    big = np.flatnonzero(both >= SMALL)
    out[big] = log_gamma(zeros[big] + 0.5) + log_gamma(ones[big] + 0.5) - log_gamma(both[big] + 1.0)
    return out - math.log(math.pi)


def weighted(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log Pw, stopping share, estimate of a 1) of nodes with these bit counts; ``below`` is the sum of their children's log Pw."""
    own = log_kt(zeros, ones)
    log_w = own if below is None else HALF + np.logaddexp(own, below)
    stop = np.ones(len(own)) if below is None else np.exp(HALF + own - log_w)
    return log_w, stop, (ones + 0.5) / (zeros + ones + 1.0)


def decisions(byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, bit) of the eight decisions of each byte, as (8, n) arrays; node 1 is the first decision."""
    j = np.arange(8)[:, None]
    return (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1


class Nodes:
    """The nodes of one depth, from sorted distinct grams of that depth; those of a decision lie in the grams' order, so sums are over runs.

    Grams that only held-out rows have are nodes with counts 0: their Pw is 1 and their estimate 1/2, as if absent.
    """

    def __init__(self, gram: np.ndarray, n: np.ndarray, below: "Nodes | None" = None, short: np.ndarray | None = None):
        node, bit = decisions((gram & 255).astype(np.int64))
        new = np.ones(node.shape, bool)
        for j in range(8):
            part = gram >> (8 - j)
            new[j, 1:] = part[1:] != part[:-1]
        self.gram, self.n = gram, n
        self.at = np.cumsum(new.ravel()).reshape(new.shape) - 1  # the node of each decision of each gram
        first = np.flatnonzero(new.ravel())
        self.decision, self.first = np.divmod(first, len(gram))
        self.node = node.ravel()[first]
        self.ones = np.add.reduceat((bit * n).ravel(), first)
        self.zeros = np.add.reduceat(np.tile(n, 8), first) - self.ones
        if below is not None:
            below.up = self.at[below.decision, short[below.first]]
        self.log_w, self.stop, self.one = weighted(self.zeros, self.ones, None if below is None else np.bincount(below.up, below.log_w, len(first)))

    def above(self) -> "Nodes":
        """The nodes one context byte shorter."""
        gram, short = np.unique((self.gram >> 16 << 8) | (self.gram & 255), return_inverse=True)
        return Nodes(gram, np.bincount(short, self.n, len(gram)), self, short)

    def shorter(self) -> np.ndarray:
        """Each node's key one context byte shorter: (context, decision)."""
        return (self.gram[self.first] >> 16 << 8).astype(np.int64) | self.node


def trees(gram: np.ndarray, n: np.ndarray, depth: int) -> list[Nodes]:
    """Nodes of ``depth`` down to NEAR for whole groups of the NEAR nearest context bytes."""
    levels = [Nodes(gram, n.astype(np.float64))]
    while len(levels) < depth - NEAR + 1:
        levels.append(levels[-1].above())
    return levels


def groups(gram: np.ndarray, depth: int) -> Iterator[slice]:
    """Slices of about GROUP sorted grams, cut between groups of the NEAR nearest context bytes only."""
    near = gram >> np.uint64(8 * (depth + 1 - NEAR))
    start = 0
    while start < len(gram):
        end = len(gram) if start + GROUP >= len(gram) else int(np.searchsorted(near, near[start + GROUP], "right"))
        yield slice(start, end)
        start = end


class Crown:
    """The mixed probability of a 1 and the share left to deeper nodes, from the depths below NEAR: for each nearest byte and decision,
    and for each seen context of NEAR - 1 bytes and decision (sorted ``keys``)."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        two = weighted(zeros, ones, below)
        byte_keys, where = np.unique((keys >> 16 << 8) | (keys & 255), return_inverse=True)
        zeros, ones, below = (np.bincount(where, x, len(byte_keys)) for x in (zeros, ones, two[0]))
        one = weighted(zeros, ones, below)
        nodes, where = np.unique(byte_keys & 255, return_inverse=True)
        root = weighted(*(np.bincount(where, x, len(nodes)) for x in (zeros, ones, one[0])))
        self.done, self.left = np.full((256, 256), 0.25), np.full((256, 256), 0.5)
        self.done[:, nodes], self.left[:, nodes] = root[1] * root[2], 1 - root[1]
        byte, node = byte_keys >> 8, byte_keys & 255
        self.done[byte, node] += self.left[byte, node] * one[1] * one[2]
        self.left[byte, node] *= 1 - one[1]
        byte, node = keys >> 16, keys & 255
        self.keys = keys
        self.key_done = self.done[byte, node] + self.left[byte, node] * two[1] * two[2]
        self.key_left = self.left[byte, node] * (1 - two[1])

    def __getitem__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        done, left = self.done[keys >> 16, keys & 255], self.left[keys >> 16, keys & 255]
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            done[hit], left[hit] = self.key_done[at[hit]], self.key_left[at[hit]]
        return done, left


def tops(gram: np.ndarray, c: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """(key, zeros, ones, log_w): what whole groups of sorted grams give the contexts of NEAR - 1 bytes; a key may come several times."""
    out = [(np.zeros(0, np.int64), *(np.zeros(0),) * 3)]
    for part in groups(gram, depth):
        top = trees(gram[part], c[part], depth)[-1]
        key, where = np.unique(top.shorter(), return_inverse=True)
        out.append((key, *(np.bincount(where, x, len(key)) for x in (top.zeros, top.ones, top.log_w))))
    return tuple(np.concatenate(x) for x in zip(*out))


SUMMED = """range int, blocks array<bigint>, grams binary, counts binary, lists array<binary>, words array<binary>, word_counts array<binary>,
            key binary, zeros binary, ones binary, log_w binary, tokens bigint, types bigint"""


def range_sums(lists: DataFrame, depth: int) -> DataFrame:
    """One row per range: corpus counts of its grams, its blocks' lists of grams and words with the words' corpus counts, and what its trees
    give the depths above them; stored."""

    def run(t: pa.Table) -> pa.Table:
        lists = t["grams"].to_pylist()
        gram, c = added([loosened_keys(x) for x in lists], [loosened(x) for x in t["counts"].to_pylist()])
        key, zeros, ones, log_w = tops(gram, c, depth)
        total: Counter = Counter()
        words = t["words"].to_pylist()
        for w, n in zip(words, t["word_counts"].to_pylist()):
            for x, k in zip(loosened_words(w), loosened(n).tolist()):
                total[x] += k
        known = [squeezed(np.array([total[x] for x in loosened_words(w)], np.int64)) for w in words]
        row = {"range": t["range"][:1], "blocks": [t["block"].to_pylist()], "grams": [squeezed_keys(gram)], "counts": [squeezed(c)], "lists": [lists], "words": [words], "word_counts": [known],
               "key": [squeezed(key)], "zeros": [squeezed(zeros)], "ones": [squeezed(ones)], "log_w": [squeezed(log_w)],
               "tokens": [sum(total.values())], "types": [sum(n > 0 for n in total.values())]}
        pa.default_memory_pool().release_unused()
        return pa.table(row)

    return stored(lists.groupBy("range").applyInArrow(run, SUMMED), "ctw-ranges")


def crown(summed: DataFrame) -> Crown:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, *rest in zip(*(c.to_pylist() for c in b.columns)):
                yield pa.RecordBatch.from_pydict({"key": loosened(key)} | {k: loosened(x, np.float64) for k, x in zip(("zeros", "ones", "log_w"), rest)})

    low = summed.select("key", "zeros", "ones", "log_w").mapInArrow(tidy(run), "key bigint, zeros double, ones double, log_w double").groupBy("key").agg(
        F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_w").alias("log_w")).orderBy("key").toPandas()
    return Crown(low["key"].to_numpy(np.int64), *(low[x].to_numpy(np.float64) for x in ("zeros", "ones", "log_w")))


def gram_values(gram: np.ndarray, c: np.ndarray, top: Crown, depth: int) -> np.ndarray:
    """log10 probability, in multiples of 1 / POINT, of the byte after its context for whole groups of sorted grams."""
    out = [np.zeros(0, np.int64)]
    for part in groups(gram, depth):
        levels = trees(gram[part], c[part], depth)[::-1]
        p, rest = top[levels[0].shorter()]
        for level in levels:
            if level is not levels[0]:
                p, rest = p[level.up], rest[level.up]
            p, rest = p + rest * level.stop * level.one, rest * (1 - level.stop)
        _, bit = decisions((levels[-1].gram & 255).astype(np.int64))
        p = p[levels[-1].at]
        out.append(np.rint(np.log10(np.where(bit == 1, p, 1 - p)).sum(0) * POINT).astype(np.int64))
    return np.concatenate(out)


def block_values(summed: DataFrame, top: Crown, depth: int) -> DataFrame:
    """(block, grams, gram_values, words, word_counts): what each block needs to know, range by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blocks, grams_, counts, lists, words, known in zip(*(c.to_pylist() for c in b.columns)):
                gram = loosened_keys(grams_)
                value = gram_values(gram, loosened(counts), top, depth)
                for block, own, w, n in zip(blocks, lists, words, known):
                    yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "grams": [own], "gram_values": [squeezed(value[np.searchsorted(gram, loosened_keys(own))])], "words": [w], "word_counts": [n]})

    return summed.select("blocks", "grams", "counts", "lists", "words", "word_counts").mapInArrow(
        tidy(run), "block bigint, grams binary, gram_values binary, words binary, word_counts binary")


class Lookup:
    """Open-addressing table from gram to value; every gram asked for is in it."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, FREE, np.uint64)
        self.values = np.zeros(1 << self.bits, np.int64)
        slot = self.slot(keys)
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == FREE]
            self.keys[slot[free]] = keys[free]
            mine = self.keys[slot[todo]] == keys[todo]
            self.values[slot[todo[mine]]] = values[todo[mine]]
            todo = todo[~mine]
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        slot = self.slot(keys)
        odd = np.flatnonzero(self.keys[slot] != keys)
        while len(odd):
            slot[odd] = (slot[odd] + 1) & (len(self.keys) - 1)
            odd = odd[self.keys[slot[odd]] != keys[odd]]
        return self.values[slot]


def score(docs: DataFrame, out: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """Per row: id, held_out, n_bytes (with the end), n_tokens, n_known, train_tokens, base_score, score.

    ``out`` is the condition of rows that are not learnt from.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    packed = pack(docs, id_col, text_col, out)
    ranges = max(partitions(docs.sparkSession), packed.select("block").count() // 8)
    summed = range_sums(block_lists(packed, depth, ranges), depth)
    told = block_values(summed, crown(summed), depth)

    none = pa.table({"id": pa.nulls(0), "held_out": pa.array([], pa.bool_())} | {c: pa.array([], pa.int64()) for c in ("n_bytes", "words", "seen")}
                    | {c: pa.array([], pa.float64()) for c in ("logs", "score")})

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return none
        count = {w: n for x, c in zip(right["words"].to_pylist(), right["word_counts"].to_pylist()) for w, n in zip(loosened_words(x), loosened(c).tolist())}
        table = Lookup(np.concatenate([loosened_keys(x) for x in right["grams"].to_pylist()]), np.concatenate([loosened(x) for x in right["gram_values"].to_pylist()]))
        parts = []
        for body in left["docs"]:
            rows, texts, held = unpack(body.as_py())
            total, base, seen, tokens = [], [], [], []
            for a, b in pieces(texts):
                each = table[grams(texts[a:b], depth)]
                total.append(np.add.reduceat(each, np.cumsum([0] + [len(t) + 1 for t in texts[a:b - 1]])))
            for t in texts:
                c = np.array([count[w] for w in t.split()])
                tokens.append(len(c))
                seen.append(int((c > 0).sum()))
                base.append(float(np.log10(c + 1).sum()))
            parts.append(pa.table({"id": rows["id"].combine_chunks(), "held_out": pa.array(held, pa.bool_()), "n_bytes": pa.array([len(t) + 1 for t in texts], pa.int64()),
                                   "words": pa.array(tokens, pa.int64()), "seen": pa.array(seen, pa.int64()), "logs": pa.array(base, pa.float64()),
                                   "score": pa.array(np.concatenate(total) / POINT, pa.float64())}))
        pa.default_memory_pool().release_unused()
        return pa.concat_tables(parts)

    schema = f"id {kind}, held_out boolean, n_bytes bigint, words bigint, seen bigint, logs double, score double"
    scored = packed.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, schema)
    ends = docs.agg(F.count(F.when(~out, 1)).alias("ends")).first()["ends"]
    facts = summed.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("types"), F.lit(0)).alias("types")).first()
    train, types = facts["tokens"] + ends, facts["types"] + (1 if ends else 0)
    n_tokens = F.col("words") + 1
    base = F.col("logs") + math.log10(ends + 1) - n_tokens * math.log10(train + types + 1)
    return scored.select("id", "held_out", "n_bytes", n_tokens.alias("n_tokens"), (F.col("seen") + (1 if ends else 0)).alias("n_known"),
                         F.lit(train).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score")


def op9_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(read_table(spark, sf_dir, "documents"), held_out("doc_id", 7), depth=QUERY_DEPTH)
    return found.withColumnRenamed("id", "doc_id").withColumn("bits_per_byte", -F.col("score") / F.col("n_bytes") / math.log10(2))

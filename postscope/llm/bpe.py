"""Byte-level BPE encoding and decoding by a pair occurrence index (operator 8).

Texts are cut into pre-tokens; the distinct pre-tokens of a block of rows form
one symbol array. The index maps each adjacent pair, by its merge rank, to all
its positions in that array. Active ranks are applied in ascending order: one
step merges every position of a rank, and only the lists of the two
neighbouring pairs of each merged position are updated. A merge rule always
outranks the rules that make its parts (checked on loading), so no step can
bring back an earlier rank and the result equals merging word by word.

Pre-tokens seen in earlier blocks are kept in a table of bounded size; beyond
that bound it starts empty again, which changes time and no result.

Defined results: a null text is empty and has no ids. Very long texts are encoded
whole, each as a block of its own. The contents of added
tokens are recognised inside texts, as the reference library does by default.
Decoding replaces invalid UTF-8 by U+FFFD. Repeated rows each get their row,
an empty table gives an empty result, other columns of the input are not read
or, for ``encode(keep=...)``, passed through under their names.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, row_blocks, sha_hex, tidy, unused

TABLE = 100_000  # pre-tokens kept between blocks
BLOCK = 2 << 20  # UTF-8 bytes of text handled at once

# Code points that the regex module's newer Unicode tables call letters or numbers and the tokenizer's tables do not.
NEWER = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 "
    "16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 "
    "1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 "
    "1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of every byte: printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Merge rules and token bytes of one tokenizer file; a few MB, bounded by the file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], byte_alphabet()
        vocab: dict[str, int] = model["vocab"]
        self.added: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for token, k in vocab.items():
            self.token_bytes[k] = bytes(alphabet[c] for c in token)
        for token, k in self.added.items():
            self.token_bytes[k] = token.encode()
        self.byte_ids = np.array([vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        made = np.full(size, -1)
        made[self.merged] = np.arange(len(pairs))
        if len(set(self.merged.tolist())) < len(pairs) or (np.maximum(made[left], made[right]) >= np.arange(len(pairs))).any():
            raise ValueError("merge rules must each make a new token out of earlier ones")
        self.size = size
        order = np.argsort(left * size + right)
        self.keys, self.key_rank = (left * size + right)[order], order.astype(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 where there is no rule."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_rank[at], -1)


def merge_all(words: Sequence[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of non-empty words one after another, merged together through the pair occurrence index, and how many each has."""
    raw = np.frombuffer(b"".join(words), np.uint8)
    n = len(raw)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    sym = v.byte_ids[raw]
    nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
    nxt[ends - 1] = -1
    prv[np.r_[0, ends[:-1]]] = -1
    rank = np.full(n, -1)
    inner = np.flatnonzero(nxt >= 0)
    rank[inner] = v.ranks(sym[inner], sym[inner + 1])
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(at: np.ndarray) -> None:
        at = at[rank[at] >= 0]
        if not len(at):
            return
        r = rank[at]
        order = np.argsort(r, kind="stable")
        at, r = at[order], r[order]
        cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
        for x, part in zip(r[np.r_[0, cuts]].tolist(), np.split(at, cuts)):
            if x in index:
                index[x].append(part)
            else:
                index[x] = [part]
                heapq.heappush(heap, x)

    enter(inner)
    alive = np.ones(n, bool)
    while heap:
        r = heapq.heappop(heap)
        lists = index.pop(r)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        at = at[rank[at] == r]
        if not len(at):
            continue
        if sym[at[0]] == sym[nxt[at[0]]]:  # runs of one symbol: every other position, from the left
            at = np.sort(at)
            head = np.r_[True, nxt[at[:-1]] != at[1:]]
            run = np.flatnonzero(head)
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))) % 2 == 0]
        gone = nxt[at]
        after = nxt[gone]
        sym[at] = v.merged[r]
        nxt[at] = after
        prv[after[after >= 0]] = at[after >= 0]
        alive[gone] = False
        rank[gone] = -1
        before = prv[at]
        touched = np.unique(np.concatenate([at, before[before >= 0]]))
        follow = nxt[touched]
        rank[touched] = -1
        on = follow >= 0
        touched, follow = touched[on], follow[on]
        rank[touched] = v.ranks(sym[touched], sym[follow])
        enter(touched)
    count = np.add.reduceat(alive.astype(np.int64), np.r_[0, ends[:-1]])
    return sym[alive].astype(np.int32), count


class Encoder:
    """Encodes blocks of texts; one per Python worker and tokenizer file."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.split = regex.compile(public_tokenizers.PATTERN)
        newer = "".join("-".join(f"\\U{int(x, 16):08x}" for x in r.split("-")) for r in NEWER.split())
        self.newer = regex.compile(f"[{newer}]")
        self.far = re.compile("[\u0558-\U0010ffff]")  # from the first code point of NEWER on
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(v.added, key=len, reverse=True))) + ")") if v.added else None
        self.reset()

    def reset(self) -> None:
        self.number: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)  # ids of all known pre-tokens, one after another
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def pre_tokens(self, text: str) -> list[str]:
        if not text.isascii() and self.far.search(text) and self.newer.search(text):
            plain = self.newer.sub("\uffff", text)
            return [text[m.start():m.end()] for m in self.split.finditer(plain)]
        return self.split.findall(text)

    def words(self, text: str) -> list[str]:
        """Pre-tokens; those that are added tokens carry a leading NUL NUL mark, which no pre-token has."""
        if self.special is None or not self.special.search(text):
            return self.pre_tokens(text)
        out: list[str] = []
        for part in self.special.split(text):
            if part in self.v.added:
                out.append("\0\0" + part)
            elif part:
                out += self.pre_tokens(part)
        return out

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts): the ids of all texts one after another, and how many each text has."""
        if len(self.number) > TABLE:
            self.reset()
        number, fresh, row, counts = self.number, [], array("q"), []
        known = len(number)
        for text in texts:
            words = self.words(text)
            for w in words:
                if w not in number:
                    number[w] = known + len(fresh)
                    fresh.append(w)
            row.extend(map(number.__getitem__, words))
            counts.append(len(words))
        if fresh:
            marked = [w.startswith("\0\0") and w[2:] in self.v.added for w in fresh]
            plain = [w.encode() for w, m in zip(fresh, marked) if not m]
            ids, sizes = merge_all(plain, self.v) if plain else (np.zeros(0, np.int32), np.zeros(0, np.int64))
            if len(plain) < len(fresh):
                done = iter(np.split(ids, np.cumsum(sizes)[:-1]))
                each = [np.array([self.v.added[w[2:]]], np.int32) if m else next(done) for w, m in zip(fresh, marked)]
                ids, sizes = np.concatenate(each), np.array([len(x) for x in each])
            self.start = np.r_[self.start, len(self.flat) + np.cumsum(sizes) - sizes]
            self.length, self.flat = np.r_[self.length, sizes], np.r_[self.flat, ids]
        seen = np.frombuffer(row, np.int64) if len(row) else np.zeros(0, np.int64)
        size = self.length[seen]
        upto = np.cumsum(size)
        take = np.repeat(self.start[seen] - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)
        ends = np.r_[0, upto][np.cumsum(counts)]
        return self.flat[take], np.diff(np.r_[0, ends])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(Vocabulary(path))
    return _ENCODERS[path]


def encode(docs: DataFrame, text_col: str = "text", keep: Sequence[str] = ("doc_id",), path: str | None = None, decoded: bool = False) -> DataFrame:
    """``keep`` columns and ``ids`` array<int>: the token ids of every whole text;
    with ``decoded`` also the text that these ids decode to, in the same pass.
    Where a kept column has one of these names, the result's gets underscores in front."""
    path = path or default_path()
    fields = [*(docs.schema[c] for c in keep)]
    text, *made = unused(keep, "text", "ids", *["decoded"] * decoded)
    rows = docs.select(F.col(f"`{text_col}`").alias(text), *[F.col(f"`{c}`") for c in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            for start, end in row_blocks(pc.binary_length(b.column(0)).to_pylist(), BLOCK):
                part = b.slice(start, end - start)
                ids, counts = e.encode([t or "" for t in part.column(0).to_pylist()])
                offsets = np.r_[0, np.cumsum(counts)]
                out = [*part.columns[1:], pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))]
                if decoded:
                    out.append(pa.array([decode_ids(ids[x:y].tolist(), e.v) for x, y in zip(offsets[:-1], offsets[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=[*keep, *made])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), *(f"`{c}` {kind}" for c, kind in zip(made, ("array<int>", "string")))])
    return rows.mapInArrow(tidy(run), schema)


def decode_ids(ids: Sequence[int], v: Vocabulary) -> str:
    table = v.token_bytes
    return b"".join([table[k] for k in ids]).decode("utf-8", "replace")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``: the text that its ``ids`` stand for."""
    path = path or default_path()
    names = encoded.columns
    spot = names.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = encoder(path).v
        for b in batches:
            col = b.column(spot)
            values, at = col.values.to_numpy(), col.offsets.to_numpy()
            texts = [decode_ids(values[x:y].tolist(), v) for x, y in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields), "decoded string"])
    return encoded.mapInArrow(tidy(run), schema)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = encode(read_table(spark, sf_dir, "documents"), decoded=True)
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       sha_hex(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
                       sha_hex(F.col("decoded")).alias("decoded_sha256"))

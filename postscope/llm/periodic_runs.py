"""Periodic runs of words by block convolution (operator 11).

A run is a stretch of consecutive words with smallest period q and at least
max(6, 4 q) words that no neighbouring word extends. For every dyadic scale B
the text is cut into blocks of B words, and runs with B <= q < 2 B are searched:
such a run holds at least two neighbouring blocks that come again q words later.
The squared differences between a block and every stretch of the following
window,

    sum (P[i] - T[d + i])^2 = sum P^2 - 2 sum P[i] T[d + i] + sum T[d + i]^2,

are computed for all distances at once by a number-theoretic transform, exactly:
modulo one, two or three primes whose product exceeds the largest possible sum,
so a zero is a true zero-mismatch occurrence. Its distance is a seed; chains of
neighbouring blocks with one distance are extended to both sides word by word,
and a run whose period has a smaller divisor that is a period too belongs to that
one. Blocks with a word that does not come again within 2 B words have no
occurrence and are not transformed.

Texts are handled in pieces of about ``PIECE`` bytes inside a task, a long text
as one piece.

Defined results: null and empty texts have no words, so no runs and an empty
collapsed text. Very long texts are processed whole, by the task that reads
them. Runs of one text may overlap; they are sorted by start, then period.
Repeated rows and ids each get their row, a null id stays null; an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, row_blocks, sha_hex, tidy

LEAST, POWER = 6, 4  # words of a run at least; periods in it at least
PIECE = 1 << 20
PRIMES = ((2013265921, 31), (1811939329, 13), (469762049, 3))  # modulus with 2^26 | modulus - 1, and a generator
LANES = 1 << 19  # numbers transformed at once
WORD = r"[^\x20\x09-\x0D]+"


def shortest(q: int) -> int:
    return max(LEAST, POWER * q)


def chain_of(q: int, b: int) -> int:
    """Neighbouring whole blocks that a run of period ``q`` holds at least, with their copies."""
    return (shortest(q) - q - (b - 1)) // b


@lru_cache(maxsize=None)
def twiddles(n: int, p: int, g: int, inverse: bool) -> list[np.ndarray]:
    """Roots of unity of the stages of a transform of ``n`` numbers, largest span first."""
    root = pow(g, (p - 1) // n, p)
    root = pow(root, p - 2, p) if inverse else root
    out = []
    while n > 1:
        powers = np.ones(1, np.uint64)
        while len(powers) < n // 2:
            powers = np.concatenate([powers, powers * np.uint64(pow(root, len(powers), p)) % np.uint64(p)])
        out.append(powers)
        root, n = root * root % p, n // 2
    return out


def transform(x: np.ndarray, p: int, g: int, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of each row (a power of two long), modulo ``p``, self-sorting; without the inverse's 1 / n."""
    m, n = x.shape
    mod = np.uint64(p)
    x = x.reshape(m, n, 1)
    for w in twiddles(n, p, g, inverse):
        half = x.shape[1] // 2
        low, high = x[:, :half], x[:, half:]
        x = np.concatenate([((low + high) % mod)[:, :, None, :], ((low + mod - high) * w[None, :, None] % mod)[:, :, None, :]], axis=2).reshape(m, half, -1)
    return x.reshape(m, n)


def zero_mismatches(block: np.ndarray, window: np.ndarray) -> np.ndarray:
    """(m, B) booleans: where in each row's window of 2 B - 1 numbers its block of B stands, by exact sums of squared differences."""
    m, b = block.shape
    most = b * int(max(block.max(), window.max())) ** 2
    zero = np.ones((m, b), bool)
    covered = 1
    for p, g in PRIMES:
        mod, n = np.uint64(p), 2 * b
        pattern, text = np.zeros((m, n), np.uint64), np.zeros((m, n), np.uint64)
        pattern[:, :b] = block[:, ::-1] % mod
        text[:, :n - 1] = window % mod
        both = transform(transform(pattern, p, g) * transform(text, p, g) % mod, p, g, inverse=True)[:, b - 1:n - 1]
        both = both * np.uint64(pow(n, p - 2, p)) % mod
        squares = np.concatenate([np.zeros((m, 1), np.uint64), np.cumsum(text * text % mod, axis=1, dtype=np.uint64)], axis=1)
        own = (pattern * pattern % mod).sum(1, dtype=np.uint64)[:, None]
        zero &= (own + squares[:, b:n] - squares[:, :n - b] + (mod - both) * np.uint64(2)) % mod == 0
        covered *= p
        if covered > most:
            return zero
    raise ValueError("words beyond the primes' product")


def next_distance(ids: np.ndarray) -> np.ndarray:
    """How many words on the same word comes again; very large if never."""
    order = np.argsort(ids, kind="stable")
    out = np.full(len(ids), len(ids) + 1, np.int64)
    same = ids[order[1:]] == ids[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def seeds(ids: np.ndarray, far: np.ndarray, start: np.ndarray, size: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, distance) of the zero-mismatch occurrences at scale ``b`` that can be part of a run."""
    texts = np.flatnonzero(size >= shortest(b))
    count = size[texts] // b
    text = np.repeat(texts, count)
    place = start[text] + b * (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count))
    lost = np.concatenate([[0], np.cumsum(far >= 2 * b)])
    ok = lost[place + b] == lost[place]
    # chains of neighbouring blocks that can recur
    number = np.cumsum(np.r_[True, ~ok[1:] | ~ok[:-1] | (text[1:] != text[:-1])]) - 1 if len(ok) else np.zeros(0, np.int64)
    least = min(chain_of(q, b) for q in range(b, 2 * b)) if b < 4 else chain_of(b, b)
    keep = np.flatnonzero(ok & (np.bincount(number, minlength=1)[number] >= least)) if len(ok) else np.zeros(0, np.int64)
    found = [(np.zeros(0, np.int64),) * 3]
    step = max(1, LANES // (2 * b))
    for at in range(0, len(keep), step):
        part = keep[at:at + step]
        here, t = place[part], text[part]
        window = here[:, None] + b + np.arange(2 * b - 1)
        zero = zero_mismatches(ids[here[:, None] + np.arange(b)], ids[np.minimum(window, len(ids) - 1)])
        row, d = np.nonzero(zero)
        inside = here[row] + 2 * b + d <= start[t[row]] + size[t[row]]
        row, d = row[inside], d[inside]
        found.append((t[row], here[row], d + b))
    return tuple(np.concatenate(x) for x in zip(*found))


def extend(ids: np.ndarray, left: int, right: int, low: int, high: int, q: int) -> tuple[int, int]:
    """[left, right) grown inside [low, high) as long as words equal those ``q`` on."""
    step = 16
    while left > low:
        a = max(low, left - step)
        odd = np.flatnonzero(ids[a:left] != ids[a + q:left + q])
        if len(odd):
            left = a + int(odd[-1]) + 1
            break
        left, step = a, 4 * step
    step = 16
    while right < high:
        z = min(high, right + step)
        odd = np.flatnonzero(ids[right:z] != ids[right + q:z + q])
        if len(odd):
            right += int(odd[0])
            break
        right, step = z, 4 * step
    return left, right


def prime_factors(q: int) -> list[int]:
    out, f = [], 2
    while f * f <= q:
        if q % f == 0:
            out.append(f)
            while q % f == 0:
                q //= f
        f += 1
    return out + [q] * (q > 1)


def find_runs(ids: np.ndarray, size: np.ndarray) -> np.ndarray:
    """(text, start, length, period) rows of the runs of texts of ``size`` words laid end to end, sorted; starts count from each text's first word."""
    size = np.asarray(size, np.int64)
    start = np.cumsum(size) - size
    ids = ids.astype(np.uint64)
    runs: set[tuple[int, int, int, int]] = set()
    far = next_distance(ids) if len(ids) else np.zeros(0, np.int64)
    b = 1
    while len(size) and shortest(b) <= size.max():
        text, place, q = seeds(ids, far, start, size, b)
        order = np.lexsort((place, q, text))
        text, place, q = text[order], place[order], q[order]
        first = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (q[1:] != q[:-1]) | (place[1:] != place[:-1] + b)]) if len(q) else np.zeros(0, np.int64)
        length = np.diff(np.r_[first, len(q)])
        need = (np.maximum(LEAST, POWER * q[first]) - q[first] - (b - 1)) // b
        for k in np.flatnonzero(length >= need).tolist():
            at, period, t = int(place[first[k]]), int(q[first[k]]), int(text[first[k]])
            low, end = int(start[t]), int(start[t] + size[t])
            left, right = extend(ids, at, at + b * int(length[k]), low, end - period, period)
            if right + period - left < shortest(period):
                continue
            root = ids[left:left + 2 * period]
            if not any((root[:period] == root[period // f:period // f + period]).all() for f in prime_factors(period)):
                runs.add((t, left - low, right + period - left, period))
        b *= 2
    return np.array(sorted((t, s, n, q) for t, s, n, q in runs), np.int64).reshape(-1, 4) if runs else np.zeros((0, 4), np.int64)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words, words of each text)."""
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    flat, sizes = lists.flatten(), lists.value_lengths().to_numpy()
    full = pc.greater(pc.binary_length(flat), 0)
    total = np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False))]
    ends = np.cumsum(sizes)
    return flat.filter(full), total[ends] - total[ends - sizes]


def runs_and_rest(texts: pa.Array) -> tuple[list[list[dict]], pa.Array]:
    """Each text's runs and its words outside their repeats, joined by one space."""
    words, size = words_of(texts)
    found = find_runs(words.dictionary_encode().indices.to_numpy(zero_copy_only=False), size)
    start = np.cumsum(size) - size
    cover = np.zeros(len(words) + 1, np.int64)
    runs: list[list[dict]] = [[] for _ in range(len(size))]
    for t, s, n, q in found.tolist():
        runs[t].append({"start": s, "length": n, "period": q})
        cover[start[t] + s + q] += 1
        cover[start[t] + s + n] -= 1
    kept = np.cumsum(cover[:-1]) == 0
    offsets = np.r_[0, np.r_[0, np.cumsum(kept)][start + size]]
    return runs, pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.filter(pa.array(kept))), " ")


RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs, collapsed): the runs of each whole text by start, then period, and its words outside the repeats of any run."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, end in row_blocks(pc.binary_length(b.column(1)).to_pylist(), PIECE):
                part = b.slice(start, end - start)
                runs, rest = runs_and_rest(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(runs, kind), rest], names=["id", "runs", "collapsed"])

    return rows.mapInArrow(tidy(run), f"id {rows.schema['id'].dataType.simpleString()}, runs {RUNS}, collapsed string")


def edited(id_col: Column, text: Column) -> Column:
    """The contract's text: for one id in ten by crc32, words from one place on repeat with one period; other texts as they are."""
    h = F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    g, n = F.floor(h / 10), F.size(words)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", edited(F.col("doc_id"), F.col("text")).alias("text"))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    found = periodic_runs(docs).withColumn("top", longest)
    return found.select(F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
                        (-F.col("top.period")).alias("period"), F.floor(F.col("top.length") * 1000 / -F.col("top.period")).cast("bigint").alias("exponent_milli"),
                        sha_hex(F.array_join(lines, "")).alias("runs_sha256"), sha_hex(F.col("collapsed")).alias("collapsed_sha256"))

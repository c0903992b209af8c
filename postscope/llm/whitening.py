"""Embedding whitening by Jacobi-Davidson eigenvectors (operator 13).

Every usable vector becomes whole numbers x = floor(64 c) + 1000000. The fit
list, each distinct x vector once, is packed into blocks and stored; no
covariance matrix is ever made. All that the solver asks of the data is the
product of the covariance with a few columns at once: every task centres its
blocks (whole-number distance from the floor of the mean, so nothing cancels),
multiplies, and its d x columns numbers are added up by a shuffled sum.

The solver is a block Jacobi-Davidson: Rayleigh-Ritz in the search space gives
the leading pairs; a pair whose residual is at double precision (``TOLERANCE``
of the largest eigenvalue) is locked; for the others the correction equation
(I - QQ')(V - theta I)(I - QQ') t = -r, with Q the locked and the wanted Ritz
vectors, is solved by MINRES, in step for all of them so that one pass over the
data serves every equation. The space grows by the corrections and restarts from
its best Ritz vectors. Rounds end when all wanted pairs are locked and no pair
left in the space is larger than a locked one.

Defined results: rows whose vector is null or has a null or non-finite entry are
dropped, and so are vectors that have not the fit list's most frequent length
(ties: the longest). Products 64 c beyond 2^60 count as 2^60. Repeated rows and
repeated ids each get their rows; equal vectors count once in the fit, whatever
their number. Components are those with eigenvalues above rounding, so none
for a single distinct vector, and fewer than asked for where vectors are short
or lie in a smaller space; equal eigenvalues give any basis of their space.
``deviation`` beyond a long is null. An empty table gives an empty result. Very
long vectors only need d x (search space) numbers on the driver. Other columns
are not read. There is no text here.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, stored, tidy

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 60)
BLOCK = 1 << 20  # bytes of a packed block
GUARD = 4  # vectors searched beyond the wanted ones
INNER = 10  # MINRES steps of a round at most
TOLERANCE = 2.0 ** -44  # residual over largest eigenvalue: 256 units of double rounding

Product = Callable[[np.ndarray], np.ndarray]


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))


def whole(vector: Column) -> Column:
    """The x vector less SHIFT, as longs."""
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))).cast("bigint"))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def pack(vectors: DataFrame) -> DataFrame:
    """(d, n, wide, body): the distinct vectors of column ``y`` in blocks of one length, as int32 or, where needed, int64; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(0)
            sizes = col.value_lengths().to_numpy()
            for d in np.unique(sizes).tolist():
                rows = matrix(col.filter(pa.array(sizes == d)), d) if d else np.zeros((int((sizes == 0).sum()), 0), np.int64)
                step = max(1, BLOCK // (8 * max(1, d)))
                for at in range(0, len(rows), step):
                    part = rows[at:at + step]
                    wide = bool(part.size and (part.min() < -(1 << 31) or part.max() >= 1 << 31))
                    body = part.astype(np.int64 if wide else np.int32).tobytes()
                    yield pa.RecordBatch.from_pydict({"d": pa.array([d], pa.int32()), "n": pa.array([len(part)], pa.int64()), "wide": [wide], "body": pa.array([body], pa.binary())})

    return stored(vectors.select("y").distinct().mapInArrow(tidy(run), "d int, n bigint, wide boolean, body binary"), "whitening-fit")


def unpacked(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    """Blocks of whole vectors from (wide, body)."""
    for b in batches:
        for wide, body in zip(b.column(0).to_pylist(), b.column(1)):
            yield np.frombuffer(body.as_buffer(), np.int64 if wide else np.int32).reshape(-1, d).astype(np.int64)


class Fit:
    """The stored fit list of one length: exact sums, and sums over centred vectors."""

    def __init__(self, blocks: DataFrame):
        by = blocks.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
        self.n, self.d = (by["n"], by["d"]) if by else (0, 0)
        self.blocks = blocks.where(F.col("d") == self.d).select("wide", "body")
        self.sums, squares = self.exact_sums() if self.n and self.d else ([], [])
        n = self.n
        self.sums_x = [s + SHIFT * n for s in self.sums]
        self.trace = float(sum((n * q - s * s for s, q in zip(self.sums, squares)), 0)) / n / n if n else 0.0
        self.floor = np.array([s // n for s in self.sums], np.int64)
        self.rest = np.array([s % n for s in self.sums], np.float64) / max(1, n)

    def exact_sums(self) -> tuple[list[int], list[int]]:
        d = self.d

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, squares = [0] * d, [0] * d
            for y in unpacked(batches, d):
                if y.size and max(int(y.max()), -int(y.min())) ** 2 * len(y) >= 1 << 62:
                    y = y.astype(object)
                sums = [a + int(b) for a, b in zip(sums, y.sum(0))]
                squares = [a + int(b) for a, b in zip(squares, (y * y).sum(0))]
            kind = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(d), pa.int32()), "s": pa.array([Decimal(x) for x in sums], kind), "q": pa.array([Decimal(x) for x in squares], kind)})

        rows = self.blocks.mapInArrow(tidy(run), "i int, s decimal(38,0), q decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("i").collect()
        return [int(r["s"]) for r in rows], [int(r["q"]) for r in rows]

    def summed(self, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
        """Sum over all blocks of ``of``(centred vectors); tasks send their sums to a shuffled sum, the driver gets one matrix."""
        d, floor, rest = self.d, self.floor, self.rest

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for y in unpacked(batches, d):
                total += of((y - floor).astype(np.float64) - rest)
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(total.size), pa.int32()), "s": total.ravel()})

        rows = self.blocks.mapInArrow(tidy(run), "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
        out = np.zeros(shape[0] * shape[1])
        for r in rows:
            out[r["i"]] = r["s"]
        return out.reshape(shape)

    def product(self, columns: np.ndarray) -> np.ndarray:
        """Covariance times ``columns``, without the covariance."""
        return self.summed(lambda z: z.T @ (z @ columns), columns.shape) / self.n

    def identity_error(self, basis: np.ndarray) -> float:
        """Largest absolute entry of the whitened fit list's covariance minus the identity."""
        k = basis.shape[1]

        def of(z: np.ndarray) -> np.ndarray:
            w = z @ basis
            return np.vstack([w.T @ w, w.sum(0)])

        both = self.summed(of, (k + 1, k)) / self.n
        return float(np.abs(both[:k] - np.outer(both[k], both[k]) - np.eye(k)).max()) if k else 0.0


def orthogonal(columns: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Orthonormal basis of what ``columns`` adds to the spaces ``against``; directions lost to rounding go."""
    for _ in range(3):
        for q in against:
            columns = columns - q @ (q.T @ columns)
        size = np.linalg.norm(columns, axis=0)
        columns = columns[:, size > 0] / size[size > 0]
        if not columns.shape[1]:
            return columns
        q, r = np.linalg.qr(columns)
        columns = q[:, np.abs(np.diag(r)) > 1e-10]
    return columns


def minres(product: Product, theta: np.ndarray, q: np.ndarray, right: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Solutions of (I - qq')(V - theta_j I)(I - qq') t_j = right_j by Lanczos and Givens rotations, in step for all j; one product a step."""

    def project(x: np.ndarray) -> np.ndarray:
        return x - q @ (q.T @ x)

    v = project(right)
    beta = np.linalg.norm(v, axis=0)
    goal = np.maximum(enough, 1e-3 * beta)
    left = beta.copy()  # the residuals' norms
    t, v_old, w, w_old = (np.zeros_like(right) for _ in range(4))
    v = v / np.where(beta > 0, beta, 1)
    eta, c, c_old, s, s_old, beta_now = beta.copy(), np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        on = left > goal
        if not on.any():
            break
        av = np.zeros_like(v)
        av[:, on] = product(v[:, on])
        av = project(av - v * theta)
        alpha = (v * av).sum(0)
        nxt = project(av - alpha * v - beta_now * v_old)
        beta_next = np.linalg.norm(nxt, axis=0)
        delta = c * alpha - c_old * s * beta_now
        r1 = np.hypot(delta, beta_next)
        on &= r1 > 0
        r2, r3 = s * alpha + c_old * c * beta_now, s_old * beta_now
        safe = np.where(r1 > 0, r1, 1)
        c_old, s_old = c, s
        c, s = np.where(on, delta / safe, 1), np.where(on, beta_next / safe, 0)
        w, w_old = (v - r3 * w_old - r2 * w) / safe, w
        t = t + np.where(on, c * eta, 0) * w
        eta, left = -s * eta, np.where(on, left * np.abs(s), 0)
        v_old, v, beta_now = v, nxt / np.where(beta_next > 0, beta_next, 1), beta_next
    return project(t)


def leading_pairs(product: Product, d: int, k: int, most: int | None = None, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit vectors (d x k), of the symmetric operator ``product``, by Jacobi-Davidson."""
    k = min(k, d)
    most = most or max(4 * (k + GUARD), 64)  # vectors of the search space before it restarts
    x, values = np.zeros((d, 0)), np.zeros(0)  # locked
    v = orthogonal(np.random.default_rng(seed).standard_normal((d, min(d, k + GUARD))))
    av = product(v)
    while True:
        h = v.T @ av
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        u, au = v @ y, av @ y
        top = max([*np.abs(values), *np.abs(theta)], default=0.0)
        enough = TOLERANCE * top
        least = np.sort(values)[::-1][k - 1] if len(values) >= k else -math.inf
        wanted = max(k - len(values), int((theta > least + enough).sum()) if len(values) >= k else 0)
        wanted = min(wanted, len(theta))
        if not wanted:
            break
        r = au[:, :wanted] - u[:, :wanted] * theta[:wanted]
        size = np.linalg.norm(r, axis=0)
        full = v.shape[1] + x.shape[1] >= d
        done = size <= (max(enough, size.max()) if full else enough)  # the whole space: Rayleigh-Ritz is exact but for rounding
        if done.any():
            rest = np.r_[~done, np.ones(len(theta) - wanted, bool)]
            x, values = np.hstack([x, u[:, :wanted][:, done]]), np.r_[values, theta[:wanted][done]]
            v, av = u[:, rest], au[:, rest]
            if not v.shape[1]:
                if len(values) >= min(k, d):
                    break
                v = orthogonal(np.random.default_rng(seed + len(values)).standard_normal((d, min(d - len(values), GUARD + 1))), x)
                av = product(v)
            continue
        t = minres(product, theta[:wanted], np.hstack([x, u[:, :wanted]]), -r, INNER, enough / 4)
        if v.shape[1] + wanted > most:
            v, av = u[:, :wanted + GUARD], au[:, :wanted + GUARD]
        t = orthogonal(t, x, v)
        if not t.shape[1]:  # corrections are lost to rounding: a fresh direction
            t = orthogonal(np.random.default_rng(seed + v.shape[1]).standard_normal((d, 1)), x, v)
        v, av = np.hstack([v, t]), np.hstack([av, product(t)])
    order = np.argsort(-values, kind="stable")[:k]
    return values[order], np.linalg.qr(x[:, order])[0]


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): per remaining row and component."""
    vector = F.col(f"`{vector_col}`")
    kept = rows.where(usable(vector)).select(F.col(f"`{id_col}`").alias("id"), whole(vector).alias("y"))
    fit = Fit(pack(kept))
    n, d = fit.n, fit.d
    values, basis = leading_pairs(fit.product, d, components) if n and d and fit.trace > 0 else (np.zeros(0), np.zeros((d, 0)))
    real = values > d * np.finfo(float).eps * fit.trace
    values, basis = values[real], basis[:, real]
    scaled = basis / np.sqrt(values)
    error = fit.identity_error(scaled) if len(values) else 0.0
    explained = values / fit.trace if len(values) else values
    k, floor, rest = len(values), fit.floor, fit.rest
    over = np.array([s - n * int(f) for s, f in zip(fit.sums, floor)], np.int64)  # S - n floor, below n
    kind = rows.schema[id_col].dataType.simpleString()

    def deviations(z: np.ndarray) -> list[int | None] | np.ndarray:
        """Sums of (n x - S)^2, exact; None beyond a long."""
        most = max(int(z.max()), -int(z.min())) + 1
        if d * (n * most) ** 2 < 1 << 63:
            part = n * z - over
            return (part * part).sum(1)
        part = n * z.astype(object) - over.astype(object)
        return [s if s < 1 << 63 else None for s in map(int, (part * part).sum(1))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            step = max(1, BLOCK // (8 * d))
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                z = matrix(part.column(1), d) - floor
                who = np.repeat(np.arange(len(z)), k)
                w = (z.astype(np.float64) - rest) @ scaled
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(who)), pa.array(np.tile(np.arange(1, k + 1), len(z)), pa.int32()),
                                                  pa.array(deviations(z), pa.int64()).take(pa.array(who)), pa.array(w.ravel()), pa.array(np.tile(explained, len(z)))],
                                                 names=["id", "component", "deviation", "whitened", "explained"])

    alike = kept.where(F.size("y") == d) if k else kept.limit(0)
    out = alike.mapInArrow(tidy(run), f"id {kind}, component int, deviation bigint, whitened double, explained double")
    return out.select("id", "component", F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", "explained", F.lit(error).cast("double").alias("identity_error"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")

"""Predict-then-learn models as window queries.

Each model reads rows of one key in arrival order ``order`` and, for every
row, emits the prediction made *before* learning that row. In batch these
are prefix computations, so they become window functions.

Scale: a plain ``Window.partitionBy(key)`` puts a whole key into one task
(five tags -> five tasks, and one hot tag holds a third of the data). Every
model here therefore takes an optional ``bucket`` column (e.g. the hour or
day of the event time, monotone in ``order``) and runs as a *bucketed prefix
scan*:

1. windows run per ``(key, bucket)``, so work spreads over keys x buckets;
2. a small per-bucket summary (count and sums, or the affine EWMA state, or
   the last 100 values) is aggregated with partial aggregation;
3. the summaries are prefixed per key over the buckets (tiny: keys x buckets
   rows) and joined back as a carry-in.

Without ``bucket`` the same code runs with a single bucket per key (plain
form). Both forms give identical results; tests check that.

Every model also takes ``init``, a small per-key state table (the model
after earlier rows), which enters as a pseudo-bucket before all real ones,
and has a ``*_state`` function giving the state after the rows. Together
they let a stream run the same skew-free computation per micro-batch
(``streaming.predictors.start_bucketed``).

All arithmetic stays in native expressions; nothing is collected.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import java_int
from ..vocab import EWMA_RATE, MODEL_NAMES, REGRESSION_WARMUP, SMA_RING
from .slices import PART, partition_columns

UNB = Window.unboundedPreceding


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _with_bucket(df: DataFrame, bucket: str | Column | None) -> DataFrame:
    # Non-nullable on purpose: a nullable join key makes Catalyst infer an
    # extra IS NOT NULL filter on one branch only, and the two branches that
    # read the rows (windows, per-bucket summary) then no longer share their
    # exchange. Rows without a bucket (no time) go to bucket 0.
    # A slice table (``operators.slices``) has its ``_part`` as it is stored.
    if bucket is None:
        return df.drop(PART).withColumn("_b", F.lit(0).cast("bigint"))
    return df.withColumn("_b", F.coalesce(_c(bucket).cast("bigint"), F.lit(0).cast("bigint")))


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


INIT_BUCKET = -(2 ** 62)   # pseudo-bucket of the initial state, before every real bucket


def _order_cols(order, ks, keep):
    return [c for c in order if c not in ks and c not in keep]


def _stored_part(d, ks, keep):
    return [PART] if PART in d.columns and PART not in (*ks, *keep) else []


def _parts(d, ks):
    return partition_columns(d, ks)


# --------------------------------------------------------------------- P2/P3

def _reg_rows(df, ks, order, x, y, bucket, keep):
    d = _with_bucket(df, bucket)
    d = d.select(
        *keep, *ks, *_order_cols(order, ks, keep), "_b", *_stored_part(d, ks, keep),
        F.col(x).cast("bigint").alias("_x"), F.col(y).cast("bigint").alias("_y"))
    return d.withColumn("_xy", (F.col("_x") * F.col("_y")).cast("decimal(38,0)")) \
            .withColumn("_xx", (F.col("_x") * F.col("_x")).cast("decimal(38,0)"))


def _reg_summary(rows, ks, init):
    own = [c for c in _parts(rows, ks) if c not in ks and c != "_b"]
    summ = rows.groupBy(*ks, "_b", *own).agg(F.count(F.lit(1)).alias("_n"), F.sum("_xy").alias("_bxy"),
                                             F.sum("_xx").alias("_bxx"))
    if init is not None:
        summ = summ.unionByName(init.select(
            *ks, F.lit(INIT_BUCKET).cast("bigint").alias("_b"), F.col("n").cast("bigint").alias("_n"),
            F.col("sxy").cast("decimal(38,0)").alias("_bxy"), F.col("sxx").cast("decimal(38,0)").alias("_bxx")), allowMissingColumns=True)
    return summ


def regression_predict(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                       x: str, y: str, warmup: int = REGRESSION_WARMUP,
                       bucket: str | Column | None = None, keep: Sequence[str] = (),
                       init: DataFrame | None = None) -> DataFrame:
    """Through-origin regression of ``y`` on ``x``.

    Counts first; from row ``warmup + 1`` of a key on, predicts
    ``x * Sxy / Sxx`` over the *earlier* rows (−1 when ``Sxx`` is 0), then
    learns the row. Output: ``keep..., key..., predicted int, real int``.
    Sums are exact (decimal) and converted to double only for the division.
    ``init``: ``(key..., n, sxy, sxx)`` of earlier rows.
    """
    ks = _keys(key)
    if init is not None and bucket is None:
        bucket = F.lit(0)
    d = _reg_rows(df, ks, order, x, y, bucket, keep)
    parts = _parts(d, ks)
    wb = Window.partitionBy(*parts).orderBy(*order)
    prev = wb.rowsBetween(UNB, -1)
    d = d.select("*", F.row_number().over(wb).alias("_r"),
                 F.coalesce(F.sum("_xy").over(prev), F.lit(0)).alias("_sxy"),
                 F.coalesce(F.sum("_xx").over(prev), F.lit(0)).alias("_sxx"))
    if bucket is not None:
        summ = _reg_summary(d, ks, init)
        wk = Window.partitionBy(*ks).orderBy("_b").rowsBetween(UNB, -1)
        carry = summ.select(*parts,
                            F.coalesce(F.sum("_n").over(wk), F.lit(0)).alias("_cn"),
                            F.coalesce(F.sum("_bxy").over(wk), F.lit(0)).alias("_cxy"),
                            F.coalesce(F.sum("_bxx").over(wk), F.lit(0)).alias("_cxx"))
        d = d.join(carry, parts)
        n = F.col("_cn") + F.col("_r")
        sxy = F.col("_cxy") + F.col("_sxy")
        sxx = F.col("_cxx") + F.col("_sxx")
    else:
        n, sxy, sxx = F.col("_r"), F.col("_sxy"), F.col("_sxx")
    slope = sxy.cast("double") / sxx.cast("double")
    pred = F.when(sxx == 0, F.lit(-1)).otherwise(java_int(slope * F.col("_x").cast("double")))
    return d.where(n > warmup).select(*keep, *ks, pred.alias("predicted"),
                                      java_int(F.col("_y")).alias("real"))


def regression_state(df: DataFrame, key: str | Sequence[str], x: str, y: str,
                     init: DataFrame | None = None) -> DataFrame:
    """Model after all rows of ``df`` (and ``init``): ``key..., n, sxy, sxx``.
    Order-free, so a plain partial/final aggregate."""
    ks = _keys(key)
    summ = _reg_summary(_reg_rows(df, ks, (), x, y, None, ()), ks, init)
    return summ.groupBy(*ks).agg(F.sum("_n").alias("n"), F.sum("_bxy").cast("decimal(38,0)").alias("sxy"),
                                 F.sum("_bxx").cast("decimal(38,0)").alias("sxx"))


# --------------------------------------------------------------------- P4

def _sma_rows(df, ks, order, value, bucket, keep):
    d = _with_bucket(df, bucket)
    d = d.select(*keep, *ks, *_order_cols(order, ks, keep), "_b", *_stored_part(d, ks, keep), F.col(value).cast("bigint").alias("_x"))
    wb = Window.partitionBy(*_parts(d, ks)).orderBy(*order)
    return d.withColumn("_r", F.row_number().over(wb)), wb


def _sma_tails(d, ks, ring, init):
    """Per (key, bucket): its last ``ring`` values in order (bounded arrays)."""
    parts = _parts(d, ks)
    cnt = F.count(F.lit(1)).over(Window.partitionBy(*parts))
    cols = list(dict.fromkeys([*ks, "_b", *parts]))
    tails = (d.select(*cols, "_r", "_x", cnt.alias("_m"))
             .where(F.col("_r") > F.col("_m") - ring)
             .groupBy(*cols)
             .agg(F.sort_array(F.collect_list(F.struct("_r", "_x"))).alias("_t")))
    if init is not None:
        seeded = F.transform(F.col("last").cast("array<bigint>"),
                             lambda v, i: F.struct((i + 1).alias("_r"), v.alias("_x")))
        tails = tails.unionByName(init.select(*ks, F.lit(INIT_BUCKET).cast("bigint").alias("_b"),
                                              seeded.alias("_t")), allowMissingColumns=True)
    return tails


def _last(arr: Column, ring: int) -> Column:
    """The last ``ring`` elements of ``arr``."""
    return F.slice(arr, F.greatest(F.size(arr) - ring + 1, F.lit(1)), ring)


def sma_with_state(df: DataFrame, key: str | Sequence[str], order: Sequence[str], value: str,
                   ring: int = SMA_RING, bucket: str | Column | None = None, keep: Sequence[str] = (),
                   init: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Predictions, the state after the rows (latest ``ring`` values per key)
    and the windowed row frame both are built on (persist it to compute the
    windows once for both)."""
    ks = _keys(key)
    d, wb = _sma_rows(df, ks, order, value, F.lit(0) if bucket is None else bucket, keep)
    d = d.withColumn("_s", F.coalesce(F.sum("_x").over(wb.rowsBetween(UNB, -1)), F.lit(0)))
    d = d.withColumn("_win", F.col("_s") - F.coalesce(F.lag("_s", ring).over(wb), F.lit(0)))
    tails = _sma_tails(d, ks, ring, init)
    flat = lambda w: F.flatten(F.transform(F.collect_list("_t").over(w), lambda a: a["_x"]))
    wk = Window.partitionBy(*ks).orderBy("_b")
    parts = _parts(d, ks)
    carry = tails.select(*dict.fromkeys([*ks, "_b", *parts]), _last(flat(wk.rowsBetween(-ring, -1)), ring).alias("_carry"),
                         _last(flat(wk.rowsBetween(-ring, 0)), ring).alias("_upto"))
    j = d.join(carry.select(*parts, "_carry"), parts)   # every bucket of d has its tails row
    need = F.lit(ring + 1) - F.col("_r")
    arr = F.coalesce(F.col("_carry"), F.array().cast("array<bigint>"))
    part = F.slice(arr, F.greatest(F.size(arr) - need + 1, F.lit(1)), need)
    extra = F.when(F.col("_r") <= ring,
                   F.aggregate(part, F.lit(0).cast("bigint"), lambda a, v: a + v)).otherwise(0)
    pred = java_int((F.col("_win") + extra).cast("double") / F.lit(float(ring)))
    preds = j.select(*keep, *ks, pred.alias("predicted"), java_int(F.col("_x")).alias("real"))
    state = carry.groupBy(*ks).agg(F.max_by("_upto", "_b").alias("last"))
    return preds, state, d


def sma_predict(df: DataFrame, key: str | Sequence[str], order: Sequence[str], value: str,
                ring: int = SMA_RING, bucket: str | Column | None = None,
                keep: Sequence[str] = (), init: DataFrame | None = None) -> DataFrame:
    """Moving average over a ring of ``ring`` slots that starts full of zeros.

    Prediction = ``(int)(sum of the previous ring values / ring)``. The
    window sum of the last ``ring`` rows is computed as a difference of exact
    running sums (``lag`` of the running sum), so it costs O(1) per row.
    ``init``: ``(key..., last array<bigint>)``, the latest values, oldest first.
    """
    ks = _keys(key)
    if bucket is None and init is None:
        d, wb = _sma_rows(df, ks, order, value, None, keep)
        d = d.withColumn("_s", F.coalesce(F.sum("_x").over(wb.rowsBetween(UNB, -1)), F.lit(0)))
        d = d.withColumn("_win", F.col("_s") - F.coalesce(F.lag("_s", ring).over(wb), F.lit(0)))
        pred = java_int(F.col("_win").cast("double") / F.lit(float(ring)))
        return d.select(*keep, *ks, pred.alias("predicted"), java_int(F.col("_x")).alias("real"))
    return sma_with_state(df, key, order, value, ring, bucket, keep, init)[0]


def sma_state(df: DataFrame, key: str | Sequence[str], order: Sequence[str], value: str,
              ring: int = SMA_RING, bucket: str | Column | None = None,
              init: DataFrame | None = None) -> DataFrame:
    """The latest ``ring`` values per key after ``df`` (and ``init``): ``key..., last``."""
    return sma_with_state(df, key, order, value, ring, bucket, (), init)[1]


# --------------------------------------------------------------------- P1

def _ewma_block(rate: float) -> int:
    # rows over which a weight falls to about 1e-150, so that weights relative to a block's start stay in range
    return max(1, int(345.0 / -math.log(1.0 - rate)))


_BACK = 3   # earlier blocks that reach a row: what is older weighs under 1e-450, below the smallest double


def _ewma_local(df, ks, order, value, rate, bucket, keep):
    """Rows with ``_v``: the model value before each row, starting from 0 at
    the start of the row's bucket (block-rescaled closed form)."""
    q = 1.0 - rate
    blk = _ewma_block(rate)
    d = _with_bucket(df, bucket)
    d = d.select(*keep, *ks, *_order_cols(order, ks, keep), "_b", *_stored_part(d, ks, keep), F.col(value).cast("double").alias("_x"))
    parts = _parts(d, ks)
    wb = Window.partitionBy(*parts).orderBy(*order)
    d = d.withColumn("_r", F.row_number().over(wb))
    d = d.withColumn("_p", (F.col("_r") - 1) % blk).withColumn("_k", F.floor((F.col("_r") - 1) / blk))
    wk = Window.partitionBy(*parts, "_k")
    wko = wk.orderBy(*order)
    d = d.select("*",
                 F.coalesce(F.sum(F.col("_x") * F.pow(F.lit(q), -F.col("_p"))).over(wko.rowsBetween(UNB, -1)),
                            F.lit(0.0)).alias("_s1"),
                 F.sum(F.col("_x") * F.pow(F.lit(q), F.lit(blk) - F.col("_p"))).over(wk).alias("_t0"))
    # same order as wb (the block number grows with it), written so that all
    # block windows share one sort of the partition
    wbk = Window.partitionBy(*parts).orderBy("_k", *order)
    total = F.col("_s1")
    for back in range(1, _BACK + 1):   # the whole-block sum of the block so many before
        d = d.withColumn("_l", F.coalesce(F.lag(f"_t{back - 1}", 1).over(wbk), F.lit(0.0)))
        d = d.withColumn(f"_t{back}", F.first("_l").over(wko.rowsBetween(UNB, 0)))
        total = total + F.col(f"_t{back}") * F.lit(q ** (blk * (back - 1)))
    return d.withColumn("_v", F.lit(rate) * F.pow(F.lit(q), F.col("_p") - 1) * total)


def _ewma_summary(d, ks, rate, init):
    """Per (key, bucket): rows ``_m`` and end value from 0 ``_e`` (an affine map
    ``v -> q^m v + e``); the initial state is the map ``v -> init``."""
    q = 1.0 - rate
    after = F.lit(q) * F.col("_v") + F.lit(rate) * F.col("_x")
    own = [c for c in _parts(d, ks) if c not in ks and c != "_b"]
    summ = d.groupBy(*ks, "_b", *own).agg(F.count(F.lit(1)).alias("_m"), F.max_by(after, F.col("_r")).alias("_e"))
    if init is not None:
        summ = summ.unionByName(init.select(*ks, F.lit(INIT_BUCKET).cast("bigint").alias("_b"),
                                            F.lit(0).cast("bigint").alias("_m"),
                                            F.col("v").cast("double").alias("_e")), allowMissingColumns=True)
    return summ


SPAN = 256   # maps composed one after another at each level of a prefix scan


def affine_prefix(summ: DataFrame, ks: Sequence[str], q: float) -> DataFrame:
    """``summ`` (keys, ``_b``, and the map ``v -> q^_m v + _e``) with ``_c``, the composition of **all** earlier
    maps of the key applied to 0, and ``_ci``, the same including the own one.

    A scan of two levels and a top: maps inside groups of ``SPAN``, groups inside groups of ``SPAN`` groups, and
    those one after another, so a key of S buckets costs about ``3 SPAN`` steps a bucket, not S.
    """
    def then(a, b):
        """``a`` first, then ``b``."""
        return F.struct((a["m"] + b["m"]).alias("m"), (a["e"] * F.pow(F.lit(q), b["m"]) + b["e"]).alias("e"))

    def composed(maps):
        start = F.struct(F.lit(0).cast("bigint").alias("m"), F.lit(0.0).alias("e"))
        return F.aggregate(maps, start, lambda acc, s: then(acc, s))

    own = F.struct(F.col("_m").alias("m"), F.col("_e").alias("e"))
    d = summ.withColumn("_n", F.row_number().over(Window.partitionBy(*ks).orderBy("_b")) - 1)
    d = d.withColumn("_g1", F.floor(F.col("_n") / SPAN)).withColumn("_g2", F.floor(F.col("_n") / (SPAN * SPAN)))
    w1 = Window.partitionBy(*ks, "_g1").orderBy("_n")
    d = d.select("*", composed(F.collect_list(own).over(w1.rowsBetween(UNB, -1))).alias("_p1"),
                 F.when(F.col("_n") % SPAN == 0, composed(F.collect_list(own).over(w1.rowsBetween(UNB, Window.unboundedFollowing)))).alias("_t1"))
    w2 = Window.partitionBy(*ks, "_g2").orderBy("_g1")
    d = d.select("*", composed(F.collect_list("_t1").over(w2.rangeBetween(UNB, -1))).alias("_p2"),
                 F.when(F.col("_n") % (SPAN * SPAN) == 0, composed(F.collect_list("_t1").over(w2.rangeBetween(UNB, Window.unboundedFollowing)))).alias("_t2"))
    d = d.select("*", composed(F.collect_list("_t2").over(Window.partitionBy(*ks).orderBy("_g2").rangeBetween(UNB, -1))).alias("_p3"))
    d = d.withColumn("_c", then(then(F.col("_p3"), F.col("_p2")), F.col("_p1"))["e"])
    return d.withColumn("_ci", F.col("_c") * F.pow(F.lit(q), F.col("_m")) + F.col("_e")).select(*summ.columns, "_c", "_ci")


def ewma_with_state(df: DataFrame, key: str | Sequence[str], order: Sequence[str], value: str,
                    rate: float = EWMA_RATE, bucket: str | Column | None = None, keep: Sequence[str] = (),
                    init: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Predictions, the model value per key after the rows, and the windowed
    row frame both are built on (persist it to compute the windows once)."""
    if not 0.0 < rate < 1.0:
        raise ValueError("rate must be in (0, 1)")
    ks = _keys(key)
    q = 1.0 - rate
    d = _ewma_local(df, ks, order, value, rate, F.lit(0) if bucket is None else bucket, keep)
    summ = _ewma_summary(d, ks, rate, init)
    carry = affine_prefix(summ, ks, q)
    parts = _parts(d, ks)
    j = d.join(carry.select(*parts, "_c"), parts)
    v = F.pow(F.lit(q), F.col("_r") - 1) * F.col("_c") + F.col("_v")
    preds = j.select(*keep, *ks, v.alias("predicted_value"), java_int(v).alias("predicted"),
                     java_int(F.col("_x")).alias("real"))
    state = carry.groupBy(*ks).agg(F.max_by("_ci", "_b").alias("v"))
    return preds, state, d


def ewma_predict(df: DataFrame, key: str | Sequence[str], order: Sequence[str], value: str,
                 rate: float = EWMA_RATE, bucket: str | Column | None = None,
                 keep: Sequence[str] = (), init: DataFrame | None = None) -> DataFrame:
    """Exponential smoothing (P1): ``v0 = 0``; emit ``v``; ``v += rate * (x - v)``.

    Emits ``predicted_value`` (double, the model state) and ``predicted``
    (its Java int cast), ``real``. ``init``: ``(key..., v)``.

    Closed form: ``v_i = rate * sum_{j<i} q^(i-1-j) x_j`` with ``q = 1-rate``.
    Rows are cut into blocks of ``B`` rows with ``q^B`` about ``1e-150``. Inside a block the weights are
    rescaled relative to the block start (``q^-p``, no overflow), and the three blocks before
    contribute one whole-block sum each, taken by ``lag``; what is older weighs less than
    the smallest double. Everything is window arithmetic, O(1) per row. Across
    buckets the state carries as the composition of all earlier buckets' affine maps
    (:func:`affine_prefix`).
    """
    if not 0.0 < rate < 1.0:
        raise ValueError("rate must be in (0, 1)")
    if bucket is None and init is None:
        ks = _keys(key)
        d = _ewma_local(df, ks, order, value, rate, None, keep)
        return d.select(*keep, *ks, F.col("_v").alias("predicted_value"),
                        java_int(F.col("_v")).alias("predicted"), java_int(F.col("_x")).alias("real"))
    return ewma_with_state(df, key, order, value, rate, bucket, keep, init)[0]


def ewma_state(df: DataFrame, key: str | Sequence[str], order: Sequence[str], value: str,
               rate: float = EWMA_RATE, bucket: str | Column | None = None,
               init: DataFrame | None = None) -> DataFrame:
    """Model value per key after all rows of ``df`` (and ``init``): ``key..., v``."""
    return ewma_with_state(df, key, order, value, rate, bucket, (), init)[1]


def label(pred: DataFrame, model: str) -> DataFrame:
    """Append the model name."""
    return pred.withColumn("name", F.lit(MODEL_NAMES.get(model, model)))

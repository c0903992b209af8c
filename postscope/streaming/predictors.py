"""P5: keyed predict-then-learn state on a stream.

Each micro-batch runs the sliced batch predictors of ``operators.predict`` from
a small per-key state table (EWMA value; regression count and exact decimal
sums; the last ``ring`` values of the moving average) that is versioned by
batch id. Batch and stream are the same code, so they give the same numbers,
and no tag is one task in either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import predict as P
from ..operators.slices import SLICE, sliced
from ..sinks.documents import write_batch
from .runner import committed, remove


def start_bucketed(posts: DataFrame, kind: str, out: str, state: str, checkpoint: str,
                   value: str | None = None, x: str | None = None, y: str | None = None,
                   key: str = "tag", order: tuple[str, ...] = ("t", "id"), slices: int | None = None,
                   trigger: dict | None = None, shape=None, fmt: str = "parquet"):
    """Run predictor ``kind`` (``ewma`` | ``sma`` | ``regression``) on a stream.

    Per micro-batch ``b``: cut its rows into even slices of ``(key, order)``
    (``operators.slices``), so that a tag holding most of one batch is spread
    like any other; read the state version before ``b``; run the batch
    predictor with that state as ``init``; write predictions to
    ``out/batch=b`` and the new per-key state to ``state/batch=b`` (both overwritten on a
    replay, so a re-run batch reproduces its output). Only the last two
    states are kept: a replay needs the one before its batch. ``shape``
    maps the predictions before writing (e.g. to documents), ``fmt`` is the
    writer.
    """
    spark = posts.sparkSession

    def _batch(batch: DataFrame, batch_id: int) -> None:
        versions = committed(spark, state, "batch=")
        prev = [v for v in versions if v < batch_id]
        init = spark.read.parquet(f"{state}/batch={prev[-1]}") if prev else None
        staged = f"{state}/_rows_{batch_id}"
        rows = sliced(batch, key, order, slices, staged)
        bucket = F.col(SLICE)
        if kind == "ewma":
            pred, new, _ = P.ewma_with_state(rows, key, order, value, bucket=bucket, keep=["id"], init=init)
        elif kind == "sma":
            pred, new, _ = P.sma_with_state(rows, key, order, value, bucket=bucket, keep=["id"], init=init)
        elif kind == "regression":
            pred = P.regression_predict(rows, key, order, x, y, bucket=bucket, keep=["id"], init=init)
            new = P.regression_state(rows, key, x, y, init=init)
        else:
            raise ValueError(kind)
        if shape is not None:
            pred = shape(pred)
        write_batch(pred, out, batch_id, fmt)
        if init is not None:   # keys absent from this batch keep their state
            new = new.unionByName(init.join(new.select(key), key, "left_anti"))
        new.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        remove(spark, staged)
        for old in prev[:-1]:
            remove(spark, f"{state}/batch={old}")

    w = (posts.writeStream.foreachBatch(_batch).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})))
    return w.start()

"""Live-vs-historic comparison.

History holds one value per (statistic, tag); every live window emits
``historic - live`` for the tags that have history and nothing otherwise,
i.e. an inner equi-join. The historic side is an aggregate (statistics x
tags rows); it is not hinted: Spark broadcasts it when its measured size
(file size for a materialised table, runtime shuffle size under AQE) is under
the broadcast threshold and falls back to a shuffle join otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import java_int
from ..vocab import STAT_NAMES
from .stats import MEASURES, Measures, aggregates, long_form, measured


def stat_name_col(stat_col: str = "stat"):
    m = F.create_map(*[x for k, v in STAT_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, F.col(stat_col)), F.col(stat_col))   # a caller's own measure keeps its name


def live_vs_historic(live: DataFrame, historic: DataFrame, keys: Sequence[str] = ("tag",),
                     measures: Measures = MEASURES) -> DataFrame:
    """``live``: windowed stats (window_start, window_end, keys, measures);
    ``historic``: one row per key with the same measure columns.

    Output: ``name, window_start, window_end, keys..., diff`` (double), and
    ``int_diff``: the same as an integer for the maximum, NULL for averages.
    """
    keys = list(keys)
    lv = long_form(live, ["window_start", "window_end", *keys], measures)
    hv = long_form(historic, keys, measures).withColumnRenamed("value", "hist")
    j = lv.join(hv, ["stat", *keys], "inner")
    return j.select(stat_name_col().alias("name"), "window_start", "window_end", *keys,
                    (F.col("hist") - F.col("value")).alias("diff"),
                    F.when(F.col("stat") == "max_word_length", java_int(F.col("hist") - F.col("value"))).alias("int_diff"))


def archive_averages(posts: DataFrame, keys: Sequence[str] = ("tag",), text: str = "text",
                     measures: Measures = MEASURES) -> DataFrame:
    """The historic side as the archive reader produces it: one double average
    (and the maximum) per key over the whole archive."""
    m, sources = measured(posts, measures, text)
    return m.groupBy(*keys).agg(*aggregates(sources))

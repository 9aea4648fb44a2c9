"""The monitor for a long table of many series: (series, ID, yield).

The same five statistics per series: rolling windows per series (dense
index and halo blocks keyed by series, so one long series still spreads
over many tasks), a full-history baseline per series, and the five flags.
Records without an ID or a number are left out (``split_invalid`` gives them);
a NULL series is a series like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwin.config import STATS, RiskParams
from riskwin.functions.overrun import overrun
from riskwin.operators.batch import target_stats
from riskwin.operators.index import dense_index
from riskwin.operators.lookup import attach
from riskwin.operators.rolling import rolling_stats
from riskwin.session import checkpoint_root
from riskwin.sources.clean import split_invalid


def rolling_by_series(long: DataFrame, params: RiskParams = RiskParams(), key: str = "series",
                      order: str = "ID", value: str = "yield") -> DataFrame:
    """(series, window_index, mean, median, tenth, tail_mean, safety)."""
    valid, _ = split_invalid(long.select(key, order, value), [value], order)
    checkpoint_root(long.sparkSession)
    counts = valid.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n_full"))
    indexed = dense_index(valid, order, keys=[key])
    # series too short for a window give none and needn't be shuffled
    long_enough = counts.where(F.col("_n_full") >= params.window).checkpoint()
    rows = attach(indexed.df, long_enough, key, "_key", "_n_full")
    return rolling_stats(rows, [value], F.col("_n_full"), params, keys=[key], portfolio=False, names="plain",
                         carry=["_n_full"], n_rows=indexed.n_rows).drop("_n_full")


def flags_by_series(long: DataFrame, params: RiskParams = RiskParams(), key: str = "series",
                    order: str = "ID", value: str = "yield") -> DataFrame:
    """(series, window_index, <stat>_ovr...) against each series' own history."""
    valid, _ = split_invalid(long.select(key, order, value), [value], order)
    windows = rolling_by_series(valid, params, key, order, value)
    return flags_against(windows, baseline_by_series(valid, params, key, value), params, key)


def baseline_by_series(long: DataFrame, params: RiskParams = RiskParams(), key: str = "series",
                       value: str = "yield") -> DataFrame:
    """(_key, _n, b_<stat>...): a row for each series' full history, checkpointed."""
    base = target_stats(long.select(F.col(key).alias("target"), F.col(value).alias("x")), params)
    return base.select(F.col("target").alias("_key"), F.col("n").alias("_n"), *[F.col(s).alias(f"b_{s}") for s in STATS]).checkpoint()


def flags_against(windows: DataFrame, baseline: DataFrame, params: RiskParams = RiskParams(), key: str = "series") -> DataFrame:
    """(key, window_index, <stat>_ovr...) of the windows of series that have a
    baseline."""
    return attach(windows, baseline, key, "_key", "_n").select(key, "window_index", *[
        overrun(F.col(s), F.col(f"b_{s}"), params.threshold).alias(f"{s}_ovr") for s in STATS])

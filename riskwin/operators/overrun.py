"""Overrun monitor (OVR1-OVR4): window statistics against the baseline.

The baseline is 35 scalars (one per target and statistic), so it enters the
plan as literals: the flag step is a pure projection of the window table,
no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwin.config import PORTFOLIO, STATS, RiskParams
from riskwin.functions.names import flag_name, window_name
from riskwin.functions.overrun import overrun_vs_scalar
from riskwin.operators.batch import BatchStats


def flag_columns(assets: Sequence[str], stats: Sequence[str] = STATS) -> list[str]:
    """The original's 35-flag order: per stat, assets then portfolio."""
    return [flag_name(t, s) for s in stats for t in [*assets, PORTFOLIO]]


def overrun_flags(windows: DataFrame, baseline: BatchStats, assets: Sequence[str],
                  params: RiskParams = RiskParams(), stats: Sequence[str] = STATS,
                  keep_stats: bool = False) -> DataFrame:
    """(window_index, 35 int flags) from the reference-named window table."""
    cols = ["window_index"]
    if keep_stats:
        cols += [window_name(t, s) for s in stats for t in [*assets, PORTFOLIO]]
    for s in stats:
        for t in [*assets, PORTFOLIO]:
            b = baseline.get(t, s)
            cols.append(overrun_vs_scalar(F.col(window_name(t, s)), b, params.threshold)
                        .alias(flag_name(t, s)))
    return windows.select(*cols)


def alerts_long(flags: DataFrame, assets: Sequence[str], stats: Sequence[str] = STATS,
                keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., window_index, target, stat) for every raised flag (OVR4)."""
    items = []
    for s in stats:
        for t in [*assets, PORTFOLIO]:
            items.append(F.struct(F.lit(t).alias("target"), F.lit(s).alias("stat"),
                                  F.col(flag_name(t, s)).alias("flag")))
    return (
        flags.select(*keys, "window_index", F.inline(F.array(*items)))
        .where(F.col("flag") == 1)
        .drop("flag")
    )


def overrun_counts(flags: DataFrame, assets: Sequence[str], stats: Sequence[str] = STATS) -> DataFrame:
    """Flagged-window count per (target, stat): one aggregation, 35 rows."""
    sums = flags.agg(*[F.sum(flag_name(t, s)).alias(flag_name(t, s))
                       for s in stats for t in [*assets, PORTFOLIO]])
    items = [F.struct(F.lit(t).alias("target"), F.lit(s).alias("stat"),
                      F.coalesce(F.col(flag_name(t, s)), F.lit(0)).cast("long").alias("flagged"))
             for s in stats for t in [*assets, PORTFOLIO]]
    return sums.select(F.inline(F.array(*items)))

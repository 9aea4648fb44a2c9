"""The overrun predicate (SCL6): how far a window statistic fell below its
full-history value, relative to ``1 + baseline``."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def overrun(window_stat: Column, baseline: Column, threshold: float) -> Column:
    """1 when ``(baseline - window) / (1 + baseline) >= threshold``, else 0.

    Guards, matching what the original's Python arithmetic yields: a NaN on
    either side, or as the ratio of infinities, gives 0 (``nan >= t`` is
    false); NULL (no value) gives 0;
    ``1 + baseline == 0`` gives the sign of the infinite ratio, i.e. 1 when
    the window fell below the baseline. Division is ``try_divide`` so ANSI
    mode never raises.
    """
    b, w = baseline.cast("double"), window_stat.cast("double")
    ratio = F.try_divide(b - w, F.lit(1.0) + b)
    return (
        F.when(b.isNull() | w.isNull() | F.isnan(b) | F.isnan(w), F.lit(0))
        .when(F.lit(1.0) + b == 0, F.when(b > w, F.lit(1)).otherwise(F.lit(0)))
        .when(~F.isnan(ratio) & (ratio >= F.lit(threshold)), F.lit(1))
        .otherwise(F.lit(0))
        .cast("int")
    )


def overrun_vs_scalar(window_stat: Column, baseline: float | None, threshold: float) -> Column:
    """``overrun`` against a baseline known when the plan is built.

    The guards on the baseline side are decided here, so each flag is one
    comparison on the window side; identical results to ``overrun``."""
    if baseline is None or math.isnan(baseline):
        return F.lit(0).cast("int")
    w = window_stat.cast("double")
    den = 1.0 + baseline
    if den == 0.0:
        return F.when(w < F.lit(baseline), F.lit(1)).otherwise(F.lit(0)).cast("int")
    ratio = (F.lit(baseline) - w) / F.lit(den)
    # NaN sorts above every number in Spark, so it is excluded explicitly
    return F.when(~F.isnan(ratio) & (ratio >= F.lit(threshold)), F.lit(1)).otherwise(F.lit(0)).cast("int")

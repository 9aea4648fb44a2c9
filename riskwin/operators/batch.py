"""Full-history statistics per target (AGG1-AGG9, RSH5-RSH8).

Targets are the asset columns plus the pooled portfolio (all asset values
together), or, for keyed series, one target per key. Statistics:

* ``mean``: arithmetic mean;
* ``median``: ``round((Q(0.5) + Q((N//2+1)/N)) / 2, 4)`` with
  ``Q(p) = s[ceil(p*N)-1]`` (0-based ascending order ``s``), rounded as in
  ``functions.rounding``;
* ``tenth``: ``Q(0.1)``;
* ``tail_mean``: mean of the ``k = int(0.1*N)`` smallest values;
* ``safety``: ``mean - sum(|x - mean|) / (2*N)``.

``target_stats`` reads the values twice, whatever the number of targets. Ranks
are products in binary floating point on purpose: an exact quantile summary
computes ``ceil(p * n)`` that way, which can exceed the decimal result
(``((29//2+1)/29)*29`` is slightly above 15, so the upper median rank for 29
values is 16).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwin.config import BATCH_MEDIAN_DIGITS, PORTFOLIO, STATS, TAIL_SHARE, RiskParams
from riskwin.functions.names import batch_name
from riskwin.functions.rounding import round_exact
from riskwin.operators.lookup import attach
from riskwin.operators.order_stats import history_cells, value_at
from riskwin.operators.reshape import stack_targets
from riskwin.session import checkpoint_root
from riskwin.sources.clean import valid_records, valid_values


def target_stats(values: DataFrame, params: RiskParams = RiskParams(), stats: Sequence[str] = STATS) -> DataFrame:
    """(target, n, <stat>...) for ``values`` (target, x), NULL or NaN x left out."""
    values = valid_values(values)
    if list(stats) == ["mean"]:
        return values.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"))
    checkpoint_root(values.sparkSession)
    if set(stats) <= {"mean", "safety"}:
        return _sums(values, stats)
    if params.ranks == "approx":
        return _approximate(values, params, stats)
    cells = history_cells(values, (TAIL_SHARE, 0.5), params.approx_accuracy)
    n, tail = F.col("n").cast("double"), F.floor(F.lit(TAIL_SHARE) * F.col("n"))
    ranks = {
        "tenth": F.ceil(F.lit(TAIL_SHARE) * n),
        "med_lo": F.ceil(F.lit(0.5) * n),
        "med_hi": F.least(F.ceil(((F.col("n") / 2).cast("long") + 1).cast("double") / n * n), F.col("n")),
        "tail": tail,
    }
    under = F.col("upto") <= tail
    found = cells.groupBy("target", "n", "mean").agg(
        *[value_at(F.greatest(r, F.lit(1)) if name != "tail" else r).alias(name) for name, r in ranks.items()],
        F.sum(F.when(under, F.col("sx")).otherwise(0.0)).alias("under_sum"),
        F.sum(F.when(under, F.col("c")).otherwise(0)).alias("under_n"),
        F.sum("sd").alias("absdev"),
    )
    columns = {
        "mean": F.col("mean"),
        "median": round_exact((F.col("med_hi") + F.col("med_lo")) / 2, BATCH_MEDIAN_DIGITS),
        "tenth": F.col("tenth"),
        "tail_mean": F.when(tail > 0, (F.col("under_sum") + F.when(tail > F.col("under_n"), (
            tail - F.col("under_n")) * F.col("tail")).otherwise(0.0)) / tail),
        "safety": F.col("mean") - F.col("absdev") / (F.lit(2.0) * n),
    }
    return found.select("target", "n", *[columns[s].alias(s) for s in stats])


def _sums(values: DataFrame, stats: Sequence[str]) -> DataFrame:
    """Mean and safety, which need sums but no ranks."""
    heads = values.groupBy(F.col("target").alias("of")).agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean")).checkpoint()
    found = attach(values, heads, "target", "of", "n").groupBy("target", "n", "mean").agg(
        F.sum(F.abs(F.col("x") - F.col("mean"))).alias("absdev"))
    columns = {"mean": F.col("mean"), "safety": F.col("mean") - F.col("absdev") / (F.lit(2.0) * F.col("n").cast("double"))}
    return found.select("target", "n", *[columns[s].alias(s) for s in stats])


def _approximate(values: DataFrame, params: RiskParams, stats: Sequence[str]) -> DataFrame:
    """Statistics from the sketch's quantiles; the tail mean is that of the values
    up to the tenth quantile. NULL where ``int(0.1 * N)`` is 0, as with exact
    ranks."""
    heads = values.groupBy("target").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"),
        F.percentile_approx("x", [TAIL_SHARE, 0.5], params.approx_accuracy).alias("q"))
    heads = heads.select(F.col("target").alias("of"), "n", "mean", F.get("q", 0).alias("tenth"),
                         round_exact(F.get("q", 1), BATCH_MEDIAN_DIGITS).alias("median")).checkpoint()
    around = attach(values, heads, "target", "of", "n").groupBy("target", "n", "mean", "tenth", "median").agg(
        F.avg(F.when(F.col("x") <= F.col("tenth"), F.col("x"))).alias("low"),
        F.avg(F.abs(F.col("x") - F.col("mean"))).alias("dev"))
    columns = {"mean": F.col("mean"), "median": F.col("median"), "tenth": F.col("tenth"),
               "tail_mean": F.when(F.floor(F.lit(TAIL_SHARE) * F.col("n")) > 0, F.col("low")),
               "safety": F.col("mean") - F.col("dev") / 2}
    return around.select("target", "n", *[columns[s].alias(s) for s in stats])


def history_frame(wide: DataFrame, assets: Sequence[str], params: RiskParams = RiskParams(),
                  stats: Sequence[str] = STATS) -> DataFrame:
    """``target_stats`` of every asset column and the pooled portfolio; records
    with a missing or NaN yield are left out."""
    return target_stats(stack_targets(valid_records(wide, assets), assets), params, stats)


def stats_long(frame: DataFrame, stats: Sequence[str] = STATS) -> DataFrame:
    """(target, stat, value)."""
    return frame.select("target", F.inline(F.array(*[
        F.struct(F.lit(s).alias("stat"), F.col(s).alias("value")) for s in stats])))


def stats_wide(frame: DataFrame, targets: Sequence[str], stats: Sequence[str] = STATS) -> DataFrame:
    """One row; columns in the original per-asset order (NULL without data)."""
    return frame.agg(*[F.max(F.when(F.col("target") == t, F.col(s))).alias(batch_name(t, s))
                       for t in targets for s in stats])


def stats_per_stat(frame: DataFrame, targets: Sequence[str], stats: Sequence[str] = STATS) -> DataFrame:
    """Stat-major orientation: one row per stat, one column per target."""
    return stats_long(frame, stats).groupBy("stat").agg(
        *[F.max(F.when(F.col("target") == t, F.col("value"))).alias(t) for t in targets])


@dataclass
class BatchStats:
    """A baseline as scalars: one per target and statistic, None without data."""

    targets: list[str]
    counts: dict[str, int]
    values: dict[tuple[str, str], float | None]

    def get(self, target: str, stat: str) -> float | None:
        return self.values[(target, stat)]


def full_history_stats(wide: DataFrame, assets: Sequence[str], params: RiskParams = RiskParams()) -> BatchStats:
    """``history_frame`` collected: one row per asset column and one for the
    portfolio."""
    targets = [*assets, PORTFOLIO]
    rows = {r["target"]: r for r in history_frame(wide, assets, params).collect()}
    return BatchStats(targets, {t: int(rows[t]["n"]) if t in rows else 0 for t in targets},
                      {(t, s): rows[t][s] if t in rows else None for t in targets for s in STATS})


def keyed_stats_frame(long: DataFrame, key_col: str, value_col: str, params: RiskParams = RiskParams()) -> DataFrame:
    """(key, mean, median, tenth, tail_mean, safety) per key; NULL is a key like
    any other."""
    values = long.select(F.col(key_col).alias("target"), F.col(value_col).alias("x"))
    return target_stats(values, params).drop("n").withColumnRenamed("target", key_col)

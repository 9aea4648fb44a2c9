"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads all rows of the given tables (through ``sources.fixtures``).
Six assets are the original's width, so the wide tables made from vectors take
their first six coordinates; ``batch_all_coordinates`` takes all.
Computed doubles are rounded to ``DIGITS`` places so results compare equal
across engines whose summation order differs; flags and ranks are exact.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwin.config import PORTFOLIO, STATS, RiskParams
from riskwin.operators import overrun as ovr
from riskwin.operators.batch import history_frame, keyed_stats_frame, stats_long, stats_per_stat, stats_wide, target_stats
from riskwin.operators.index import dense_index
from riskwin.operators.order_stats import k_smallest
from riskwin.operators.reshape import flatten_records, melt
from riskwin.operators.rolling import rolling_stats
from riskwin.operators.series import flags_by_series, rolling_by_series
from riskwin.operators.valuation import portfolio_value, segment_holdings
from riskwin.plans.monitor import prepare, run_monitor
from riskwin.session import checkpoint_root
from riskwin.sinks.metrics import metrics_block, overrun_lines
from riskwin.sources import fixtures as fx
from riskwin.sources.clean import split_invalid
from riskwin.sources.text import parse_lines, render_lines

DIGITS = 6
PARAMS = RiskParams()
K_REPORT = 10


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Half-even rounding on the binary value: ``rint(x * 10^d) / 10^d``.

    Plain double arithmetic keeps it in generated code (``round`` on a
    double goes through BigDecimal, which costs more than the statistics)."""
    scale = float(10 ** digits)
    return df.select(*[
        (F.rint(F.col(f.name) * F.lit(scale)) / F.lit(scale)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _y1(spark, sf):
    return fx.wide_from_embeddings(spark, sf)


def _y2(spark, sf):
    return fx.wide_from_lineitem(spark, sf)


# ---- batch statistics (Y1) -------------------------------------------------
SIX = fx.asset_names(6)
TARGETS = [*SIX, PORTFOLIO]


def _batch_stat(stat: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark, sf):
        return round_doubles(stats_wide(history_frame(_y1(spark, sf), SIX, PARAMS, [stat]), TARGETS, [stat]))
    return q


def batch_stats_wide(spark, sf):
    return round_doubles(stats_wide(history_frame(_y1(spark, sf), SIX, PARAMS), TARGETS))


def batch_stats_long(spark, sf):
    return round_doubles(stats_long(history_frame(_y2(spark, sf), SIX, PARAMS)))


def batch_stats_per_asset(spark, sf):
    return round_doubles(history_frame(_y1(spark, sf), SIX, PARAMS).drop("n"))


def batch_stats_per_stat(spark, sf):
    return round_doubles(stats_per_stat(history_frame(_y1(spark, sf), SIX, PARAMS), TARGETS))


def batch_stats_approx(spark, sf):
    """Quantiles as the sketch gives them, exact up to as many values as it holds."""
    return round_doubles(stats_long(history_frame(_y1(spark, sf), SIX, replace(PARAMS, ranks="approx"))))


def batch_hot_ties(spark, sf):
    """Statistics of two columns with a handful of distinct values."""
    li = fx.table(spark, sf, "lineitem")
    values = li.select(F.inline(F.array(*[F.struct(F.lit(c).alias("target"), F.col(c).alias("x")) for c in ("l_discount", "l_tax")])))
    return round_doubles(target_stats(values, PARAMS))


def batch_all_coordinates(spark, sf):
    """Statistics of all coordinates of the vectors, long form."""
    emb = fx.table(spark, sf, "embeddings")
    values = emb.select(F.posexplode("embedding").alias("target", "x")).withColumn("x", F.col("x").cast("double"))
    return round_doubles(target_stats(values, PARAMS))


# ---- reshapes ----------------------------------------------------------------
def melt_assets(spark, sf):
    return round_doubles(melt(_y1(spark, sf), fx.asset_names(6)))


def flatten_records_q(spark, sf):
    p = prepare(_y1(spark, sf), SIX)
    return round_doubles(flatten_records(p.indexed.df, p.assets))


def dense_index_q(spark, sf):
    return dense_index(_y2(spark, sf).select("ID"), "ID").df


def dense_index_repeated(spark, sf):
    """Order lines by order key, which repeats; their columns break the ties."""
    li = fx.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("ID"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return dense_index(li, "ID").df


# ---- rolling statistics ------------------------------------------------------
def _rolling(stats=STATS, targets=None, params=PARAMS) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark, sf):
        p = prepare(_y1(spark, sf), SIX)
        return round_doubles(rolling_stats(p.indexed.df, p.assets, p.indexed.n_rows, params, stats=stats, targets=targets))
    return q


def rolling_all(spark, sf):
    p = prepare(_y2(spark, sf), SIX, persist=True)
    return round_doubles(rolling_stats(p.indexed.df, p.assets, p.indexed.n_rows, PARAMS))


# ---- overrun monitor -------------------------------------------------------
def overrun_flags_q(spark, sf):
    return run_monitor(_y1(spark, sf), SIX, params=PARAMS).flags


def overrun_alerts_long(spark, sf):
    m = run_monitor(_y2(spark, sf), SIX, params=PARAMS, persist=True)
    return ovr.alerts_long(m.flags, m.assets)


def overrun_counts(spark, sf):
    m = run_monitor(_y2(spark, sf), SIX, params=PARAMS, persist=True)
    return ovr.overrun_counts(m.flags, m.assets)


def overrun_lines_q(spark, sf):
    m = run_monitor(_y1(spark, sf), SIX, params=PARAMS)
    return overrun_lines(m.flags, m.assets)


# ---- order statistics report ---------------------------------------------------
def k_smallest_q(spark, sf):
    long = melt(_y2(spark, sf), fx.asset_names(6))
    # every value under its asset and under the portfolio, in one scan
    both = long.select(F.explode(F.array(F.col("asset"), F.lit(PORTFOLIO))).alias("target"),
                       "ID", "asset", "yield")
    return round_doubles(k_smallest(both, K_REPORT, "target", "yield", ("ID", "asset")))


# ---- sources -----------------------------------------------------------------
def parse_yield_lines(spark, sf):
    parsed, _ = parse_lines(render_lines(_y1(spark, sf), SIX), 6)
    return round_doubles(parsed)


def _odd_lines(spark, sf) -> DataFrame:
    """A line for each order, every way of being unusable among them."""
    key, n = F.col("o_orderkey"), F.col("o_orderkey") % 7
    line = (
        F.when(n == 0, F.concat(F.lit("\t"), key, F.lit(" 0.1 0.2")))
        .when(n == 1, F.concat(key, F.lit(" 0.1")))
        .when(n == 2, F.concat(key, F.lit(" NA 0.2")))
        .when(n == 3, F.concat(key, F.lit(" 0.1f 0.2d")))
        .when(n == 4, F.lit(" \t "))
        .when(n == 5, F.concat(F.lit('"'), key, F.lit('"  -.5\t1e-3 more  ')))
        .otherwise(F.concat(F.lit("x"), key, F.lit(" 1. +2")))
    )
    return fx.table(spark, sf, "orders").select(line.alias("value"))


def parse_rejects(spark, sf):
    return parse_lines(_odd_lines(spark, sf), 2)[1]


def parse_odd_lines(spark, sf):
    return parse_lines(_odd_lines(spark, sf), 2)[0]


def yield_rejects(spark, sf):
    """Records of a table with holes: every 10th value NULL, every 15th NaN,
    every 25th key NULL."""
    y = _y1(spark, sf)
    holes = F.when(F.col("ID") % 10 == 0, None).when(F.col("ID") % 15 == 1, F.lit(float("nan"))).otherwise(F.col("asset_1"))
    holed = y.select(F.when(F.col("ID") % 25 != 0, F.col("ID")).alias("ID"), holes.alias("asset_1"), "asset_2")
    rejects = split_invalid(holed, ["asset_1", "asset_2"])[1]
    return round_doubles(rejects.select("ID", "asset_2", "reason"))


# ---- sinks ---------------------------------------------------------------------
def _metrics(by: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark, sf):
        frame = history_frame(_y1(spark, sf), SIX, PARAMS)
        return metrics_block(stats_long(frame), "Baseline", TARGETS, by, digits=DIGITS, stamp=False)
    return q


# ---- keyed series (Y3) -----------------------------------------------------
def rolling_by_series_q(spark, sf):
    return round_doubles(rolling_by_series(fx.long_from_events(spark, sf), PARAMS))


def batch_by_series(spark, sf):
    return round_doubles(keyed_stats_frame(fx.long_from_events(spark, sf), "series", "yield", PARAMS))


def overrun_by_series(spark, sf):
    return flags_by_series(fx.long_from_events(spark, sf), PARAMS)


# ---- valuation (Y4) ----------------------------------------------------------
def portfolio_value_q(spark, sf):
    checkpoint_root(spark)
    prices = fx.segment_prices(spark, sf).checkpoint()  # a row per segment and month, read three times
    holdings = segment_holdings(fx.table(spark, sf, "customer"))
    return round_doubles(portfolio_value(prices, holdings))


def stream_portfolio_value(spark, sf):
    from riskwin.streaming.valuation_stream import stream_value_from_table
    prices = fx.segment_prices(spark, sf)
    holdings = segment_holdings(fx.table(spark, sf, "customer"))
    return round_doubles(stream_value_from_table(spark, prices, holdings, files=4))


def stream_rolling_by_series(spark, sf):
    from riskwin.streaming.keyed_windows import stream_rolling_by_series as run
    return round_doubles(run(spark, fx.long_from_events(spark, sf), PARAMS, files=4))


def stream_overruns_by_series(spark, sf):
    """Each series' windows against its own history, from records that arrive up to
    40 IDs out of order."""
    from riskwin.streaming.keyed_windows import stream_flags_by_series
    return stream_flags_by_series(spark, fx.long_from_events(spark, sf), PARAMS, files=4, max_delay=40)


def stream_overruns(spark, sf):
    from riskwin.streaming.count_window import stream_flags_from_table
    return stream_flags_from_table(spark, _y1(spark, sf), SIX, PARAMS, files=5)


def stream_overruns_text(spark, sf):
    """The same stream, fed by text files of lines."""
    from riskwin.streaming.count_window import stream_flags_from_table
    return stream_flags_from_table(spark, _y1(spark, sf), SIX, PARAMS, files=3, as_text=True)


def catalog() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "overrun_flags": overrun_flags_q,
        "batch_means": _batch_stat("mean"),
        "batch_medians": _batch_stat("median"),
        "batch_tenth_quantile": _batch_stat("tenth"),
        "batch_tail_mean": _batch_stat("tail_mean"),
        "batch_safety": _batch_stat("safety"),
        "batch_stats_wide": batch_stats_wide,
        "batch_stats_long": batch_stats_long,
        "batch_stats_per_asset": batch_stats_per_asset,
        "batch_stats_per_stat": batch_stats_per_stat,
        "melt_assets": melt_assets,
        "flatten_records": flatten_records_q,
        "dense_index": dense_index_q,
        "rolling_mean": _rolling(["mean"]),
        "rolling_median": _rolling(["median"]),
        "rolling_tenth": _rolling(["tenth"]),
        "rolling_tail_mean": _rolling(["tail_mean"]),
        "rolling_safety": _rolling(["safety"]),
        "rolling_portfolio": _rolling(targets=[PORTFOLIO]),
        "rolling_all": rolling_all,
        "overrun_alerts_long": overrun_alerts_long,
        "overrun_counts": overrun_counts,
        "overrun_lines": overrun_lines_q,
        "k_smallest": k_smallest_q,
        "parse_yield_lines": parse_yield_lines,
        "rolling_by_series": rolling_by_series_q,
        "batch_by_series": batch_by_series,
        "overrun_by_series": overrun_by_series,
        "portfolio_value": portfolio_value_q,
        "stream_overruns": stream_overruns,
        "stream_portfolio_value": stream_portfolio_value,
        "stream_rolling_by_series": stream_rolling_by_series,
        "stream_overruns_text": stream_overruns_text,
        "stream_overruns_by_series": stream_overruns_by_series,
        "batch_stats_approx": batch_stats_approx,
        "batch_hot_ties": batch_hot_ties,
        "batch_all_coordinates": batch_all_coordinates,
        "dense_index_repeated": dense_index_repeated,
        "rolling_true_median": _rolling(["median"], params=replace(PARAMS, median="true")),
        "rolling_disc_quantile": _rolling(["tenth"], params=replace(PARAMS, quantile_index="disc")),
        "rolling_window_safety": _rolling(["safety"], params=replace(PARAMS, safety_divisor="window")),
        "rolling_all_native": _rolling(params=replace(PARAMS, engine="native")),
        "parse_rejects": parse_rejects,
        "parse_odd_lines": parse_odd_lines,
        "yield_rejects": yield_rejects,
        "metrics_per_stat": _metrics("stat"),
        "metrics_per_asset": _metrics("target"),
    }

"""Rolling-window statistics (WIN1-WIN9) in one Window node.

Each record starts a forward frame of ``W`` records (itself and the next
``W-1``); only complete frames produce a row, keyed by ``window_index`` =
the 0-based position of the frame's first record. The frame is collected
once per asset (``collect_list`` over a ROWS frame), sorted natively, and
all statistics are read off the arrays; the pooled portfolio frame is the
concatenation of the asset frames (``W * n`` values), which is exactly the
original's ``6W``-row frame over the record-major flattened table.

Partitioning: ``partitionBy(keys..., blk)`` on halo blocks (see
``index.halo_blocks``), so frames never need the whole series in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskwin.config import PORTFOLIO, STATS, RiskParams
from riskwin.functions import window_arrays as wa
from riskwin.functions.names import window_name
from riskwin.operators.index import block_size, halo_blocks


def window_frames(indexed: DataFrame, assets: Sequence[str], params: RiskParams,
                  keys: Sequence[str] = (), idx_col: str = "idx",
                  carry: Sequence[str] = (), n_rows: int | None = None) -> DataFrame:
    """(keys..., window_index, carry..., l_<asset>...) for every complete
    frame. ``carry``: per-row columns passed through (e.g. a per-series
    count). ``n_rows``: total record count, sizes the blocks."""
    W = params.window
    B = params.block_rows
    if n_rows is not None:
        B = block_size(n_rows, W, params.block_rows, indexed.sparkSession.sparkContext.defaultParallelism)
    blocks = halo_blocks(indexed.select(*keys, idx_col, *carry, *assets), W, B, idx_col)
    w = Window.partitionBy(*keys, "blk").orderBy(idx_col).rowsBetween(Window.currentRow, W - 1)
    lists = [F.collect_list(a).over(w).alias(f"l_{a}") for a in assets]
    framed = blocks.select(*keys, idx_col, *carry, "own", *lists)
    return framed.where(F.col("own") & (F.size(f"l_{assets[0]}") == W)).select(
        *keys, F.col(idx_col).alias("window_index"), *carry, *[f"l_{a}" for a in assets])


def _stat_columns(l, s, m, size: int, n_assets: int, divisor_count: int,
                  params: RiskParams) -> dict[str, object]:
    return {
        "mean": m,
        "median": wa.median(s, size, params.median),
        "tenth": wa.tenth(s, size, n_assets, params.quantile_index),
        "tail_mean": wa.tail_mean(s, size, n_assets),
        "safety": wa.safety(l, m, divisor_count, size),
    }


def rolling_stats(indexed: DataFrame, assets: Sequence[str], n_full: int,
                  params: RiskParams = RiskParams(), keys: Sequence[str] = (),
                  stats: Sequence[str] = STATS, portfolio: bool = True,
                  idx_col: str = "idx", names: str = "reference",
                  carry: Sequence[str] = (), n_rows: int | None = None,
                  targets: Sequence[str] | None = None) -> DataFrame:
    """One row per complete window with ``len(stats) * (n+1)`` statistics.

    ``n_full``: full-history record count, the divisor of the original
    safety measure (``safety_divisor='history'``); a Column gives a
    per-series count (keyed series).
    ``names='reference'`` uses the original column names, ``'plain'`` uses
    ``<stat>`` (single asset) or ``<target>_<stat>``. ``targets``: the assets
    (and the portfolio) to report, by default all; only these are computed."""
    assets = list(assets)
    W, n = params.window, len(assets)
    if list(stats) == ["mean"] and not keys and isinstance(n_full, int):
        return _rolling_means(indexed, assets, n_full, params, portfolio, idx_col, names, targets)
    if params.engine == "blocks":
        from riskwin.operators.rolling_blocks import rolling_stats_blocks

        if isinstance(n_full, int):
            return rolling_stats_blocks(indexed, assets, n_full, params, keys, stats, portfolio,
                                        idx_col, names, n_rows, targets=targets)
        # a per-series count travels as the first carried column
        return rolling_stats_blocks(indexed, assets, None, params, keys, stats, portfolio,
                                    idx_col, names, n_rows, n_full_col=carry[0], targets=targets)
    if n_rows is None and isinstance(n_full, int) and not keys:
        n_rows = n_full
    frames = window_frames(indexed, assets, params, keys, idx_col, carry, n_rows)
    parts = {}
    for a in assets:
        l = F.col(f"l_{a}")
        parts[a] = (l, F.sort_array(l), W, 1)
    if portfolio:
        pooled = F.flatten(F.array(*[F.col(f"l_{a}") for a in assets]))
        parts[PORTFOLIO] = (F.col(f"l_{PORTFOLIO}"), F.sort_array(F.col(f"l_{PORTFOLIO}")), W * n, n)
        frames = frames.withColumn(f"l_{PORTFOLIO}", pooled)

    # step 1: sorted arrays and asset means, once per row
    sel = [*keys, "window_index", *carry]
    for t, (l, s, size, k) in parts.items():
        sel += [l.alias(f"l_{t}"), s.alias(f"s_{t}")]
        if t != PORTFOLIO:
            sel.append(wa.mean(l, size).alias(f"m_{t}"))
    step = frames.select(*sel)
    if PORTFOLIO in parts:
        # equal-length asset frames: the pooled mean is the mean of the means
        pooled_mean = sum((F.col(f"m_{a}") for a in assets), F.lit(0.0)) / F.lit(float(n))
        step = step.select("*", pooled_mean.alias(f"m_{PORTFOLIO}"))

    # step 2: statistics read off the arrays
    out = [*keys, "window_index"]
    for t, (_, _, size, k) in parts.items():
        if targets and t not in targets:
            continue
        if params.safety_divisor == "history":
            div = n_full * (n if t == PORTFOLIO else 1) if isinstance(n_full, int) else n_full
        else:
            div = size
        cols = _stat_columns(F.col(f"l_{t}"), F.col(f"s_{t}"), F.col(f"m_{t}"), size, k, div, params)
        for st in stats:
            if names == "reference":
                nm = window_name(t, st)
            else:
                nm = st if len(parts) == 1 else f"{t}_{st}"
            out.append(cols[st].alias(nm))
    return step.select(*out)


def _rolling_means(indexed: DataFrame, assets: list[str], n_rows: int, params: RiskParams, portfolio: bool,
                   idx_col: str, names: str, targets: Sequence[str] | None) -> DataFrame:
    """Window means as plain window averages; the pooled mean is the mean of the
    means, since all assets have the same count."""
    W = params.window
    B = block_size(n_rows, W, params.block_rows, indexed.sparkSession.sparkContext.defaultParallelism)
    blocks = halo_blocks(indexed.select(idx_col, *assets), W, B, idx_col)
    w = Window.partitionBy("blk").orderBy(idx_col).rowsBetween(Window.currentRow, W - 1)
    framed = blocks.select(idx_col, "own", F.count(F.lit(1)).over(w).alias("c"), *[F.avg(a).over(w).alias(a) for a in assets])
    means = {a: F.col(a) for a in assets}
    if portfolio:
        means[PORTFOLIO] = sum(means.values(), F.lit(0.0)) / F.lit(float(len(assets)))
    shown = {t: m for t, m in means.items() if not targets or t in targets}
    return framed.where(F.col("own") & (F.col("c") == W)).select(
        F.col(idx_col).alias("window_index"),
        *[m.alias(window_name(t, "mean") if names == "reference" else "mean" if len(means) == 1 else f"{t}_mean")
          for t, m in shown.items()])

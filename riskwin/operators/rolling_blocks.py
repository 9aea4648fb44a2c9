"""Rolling statistics per halo block with numpy (the ``blocks`` engine).

Spark does the distribution exactly as in ``rolling.py``: halo blocks keyed
by (keys..., blk), one hash shuffle on that key. Each block goes through
``applyInArrow`` in record order, batch by batch; a task holds one batch, the
last ``W - 1`` records before it and the statistics of ``CHUNK`` frames,
whatever the size of a block. The frames are a zero-copy sliding view of
these records' columns, sorted and reduced in vectorised numpy. Same
statistics and options as ``rolling.py`` (the tests hold both engines to one
brute-force model).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskwin.config import PORTFOLIO, STATS, TAIL_SHARE, RiskParams
from riskwin.functions.names import window_name
from riskwin.functions.window_arrays import tail_share
from riskwin.operators.index import block_size, halo_blocks

CHUNK = 4096  # records read and frames reduced per numpy step (bounds memory)
SORTED = ("median", "tenth", "tail_mean")  # statistics read off the sorted frame


def _stats(v: np.ndarray, m: np.ndarray, size: int, n_assets: int, div: np.ndarray,
           params: RiskParams, stats: Sequence[str] = STATS) -> dict[str, np.ndarray]:
    """v: (frames, size) values in record order; m: (frames,) means. Only what
    ``stats`` asks for is computed."""
    out = {"mean": m}
    if "safety" in stats:
        out["safety"] = m - np.abs(v - m[:, None]).sum(axis=1) / (2.0 * div)
    if not any(st in stats for st in SORTED):
        return out
    s = np.sort(v, axis=1)
    if params.median == "reference":
        c = size // 2
        med = (s[:, c] + s[:, c + 1]) / 2 if c + 1 < size else np.full(len(s), np.nan)
    elif size % 2:
        med = s[:, size // 2]
    else:
        med = (s[:, size // 2 - 1] + s[:, size // 2]) / 2
    share = tail_share(size, n_assets)
    if params.quantile_index == "reference":
        ti = int(share)
    else:
        ti = max(int(np.ceil(TAIL_SHARE * size)), 1) - 1
    tenth = s[:, ti] if ti < size else np.full(len(s), np.nan)
    k = int(share)
    tail = s[:, :k].sum(axis=1) / share if k else np.zeros(len(s))
    return out | {"median": med, "tenth": tenth, "tail_mean": tail}


def rolling_stats_blocks(indexed: DataFrame, assets: Sequence[str], n_full,
                         params: RiskParams = RiskParams(), keys: Sequence[str] = (),
                         stats: Sequence[str] = STATS, portfolio: bool = True,
                         idx_col: str = "idx", names: str = "reference",
                         n_rows: int | None = None, n_full_col: str | None = None,
                         targets: Sequence[str] | None = None) -> DataFrame:
    """Same output as ``rolling.rolling_stats``. ``n_full``: an int, or None
    with ``n_full_col`` naming a per-series count column in ``indexed``."""
    assets, keys = list(assets), list(keys)
    W, n = params.window, len(assets)
    pooled = portfolio
    spark = indexed.sparkSession
    if n_rows is None:
        n_rows = n_full if isinstance(n_full, int) else indexed.count()
    B = block_size(n_rows, W, params.block_rows, spark.sparkContext.defaultParallelism)
    carry = [n_full_col] if n_full_col else []
    blocks = halo_blocks(indexed.select(*keys, idx_col, *carry, *assets), W, B, idx_col)

    targets = list(targets) if targets else ([*assets, PORTFOLIO] if pooled else assets)
    pooled = pooled and PORTFOLIO in targets
    out_names = []
    for t in targets:
        for st in stats:
            out_names.append((t, st, window_name(t, st) if names == "reference"
                              else (st if len(targets) == 1 else f"{t}_{st}")))
    key_fields = [f for f in indexed.schema.fields if f.name in keys]
    schema = T.StructType([*key_fields, T.StructField("window_index", T.LongType())]
                          + [T.StructField(nm, T.DoubleType()) for _, _, nm in out_names])
    safety_window = params.safety_divisor == "window"
    fixed_n = n_full if isinstance(n_full, int) else None

    def reduced(x: np.ndarray, nf: float) -> dict[str, np.ndarray]:
        """Statistics by name of all frames over the records ``x`` (m, n)."""
        view = np.lib.stride_tricks.sliding_window_view(x, W, axis=0)  # (m-W+1, n, W)
        f = len(view)
        frames = view[np.arange(f)]  # a copy
        means = frames.mean(axis=2)
        res = {}
        for j, a in enumerate(assets):
            if a in targets:
                div = np.full(f, float(W) if safety_window else nf)
                res[a] = _stats(frames[:, j, :], means[:, j], W, 1, div, params, stats)
        if pooled:
            div = np.full(f, float(W * n) if safety_window else nf * n)
            res[PORTFOLIO] = _stats(frames.reshape(f, n * W), means.mean(axis=1), W * n, n, div, params, stats)
        return {nm: res[t][st] for t, st, nm in out_names}

    def per_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the records that later frames start with
        at, own, x = np.empty(0, np.int64), np.empty(0, bool), np.empty((0, n))
        for whole in batches:
            for i in range(0, whole.num_rows, CHUNK):
                b = whole.slice(i, CHUNK)
                cols = [b.column(a).to_numpy(zero_copy_only=False) for a in assets]
                at = np.concatenate([at, b.column(idx_col).to_numpy()])
                own = np.concatenate([own, b.column("own").to_numpy(zero_copy_only=False)])
                x = np.concatenate([x, np.stack(cols, axis=1).astype(np.float64)])
                if (np.diff(at) != 1).any():
                    raise ValueError("a block's records must come in the order of their index, without gaps")
                # the copies of the next block's records come last and start no frame here
                f = int(own[:max(len(at) - W + 1, 0)].sum())
                if f:
                    nf = float(fixed_n if fixed_n is not None else b.column(n_full_col)[0].as_py())
                    out = reduced(x[:f + W - 1], nf)
                    keep = [pa.repeat(b.column(k.name)[0], f) for k in key_fields]
                    yield pa.RecordBatch.from_arrays(
                        [*keep, pa.array(at[:f]), *[pa.array(out[nm], from_pandas=True) for _, _, nm in out_names]],
                        schema.fieldNames())
                at, own, x = at[f:], own[f:], x[f:]

    by = [*keys, "blk"]
    ordered = blocks.repartition(*by).sortWithinPartitions(*by, idx_col)
    return ordered.groupBy(*by).applyInArrow(per_block, schema)

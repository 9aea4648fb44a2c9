"""End-to-end monitor: wide yields -> baseline -> window stats -> flags."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskwin.config import RiskParams
from riskwin.operators.batch import BatchStats, full_history_stats
from riskwin.operators.index import Indexed, dense_index
from riskwin.operators.overrun import overrun_flags
from riskwin.operators.reshape import asset_columns
from riskwin.operators.rolling import rolling_stats
from riskwin.session import checkpoint_root
from riskwin.sources.clean import split_invalid


@dataclass
class Prepared:
    """Usable records with their index, and the rejected ones with the reason."""

    assets: list[str]
    indexed: Indexed
    rejects: DataFrame


@dataclass
class Monitor:
    prepared: Prepared
    baseline: BatchStats
    windows: DataFrame
    flags: DataFrame

    @property
    def assets(self) -> list[str]:
        return self.prepared.assets

    @property
    def rejects(self) -> DataFrame:
        return self.prepared.rejects


def prepare(wide: DataFrame, assets: Sequence[str] | None = None, id_col: str = "ID",
            persist: bool = False, contiguous: bool = False) -> Prepared:
    """Select, validate and index the wide table.

    Index, baseline and windows each read the input. A file scan is cheap to
    repeat (pruned columns, pushed filters); one that takes work (an aggregation, a
    join) is computed once with ``persist``, in a checkpoint that outlives lost
    executors and holds no memory."""
    assets = list(assets) if assets else asset_columns(wide, id_col)
    base = wide.select(wide[id_col].alias("ID"), *assets)
    if persist:
        checkpoint_root(base.sparkSession)
        base = base.checkpoint()
    valid, rejects = split_invalid(base, assets)
    return Prepared(assets, dense_index(valid, "ID", contiguous=contiguous), rejects)


def run_monitor(wide: DataFrame, assets: Sequence[str] | None = None, id_col: str = "ID",
                params: RiskParams = RiskParams(), persist: bool = False) -> Monitor:
    prepared = prepare(wide, assets, id_col, persist)
    baseline = full_history_stats(prepared.indexed.df, prepared.assets, params)
    windows = rolling_stats(prepared.indexed.df, prepared.assets, prepared.indexed.n_rows, params)
    return Monitor(prepared, baseline, windows, overrun_flags(windows, baseline, prepared.assets, params))

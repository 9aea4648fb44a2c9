"""Reshapes of the wide yields table (ID, asset_1..asset_n)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwin.config import PORTFOLIO


def asset_columns(df: DataFrame, id_col: str = "ID") -> list[str]:
    return [c for c in df.columns if c != id_col]


def melt(df: DataFrame, assets: Sequence[str], id_col: str = "ID") -> DataFrame:
    """Column-major stack: (ID, asset, yield), one row per value."""
    return df.unpivot(id_col, list(assets), "asset", "yield")


def flatten_records(df: DataFrame, assets: Sequence[str], id_col: str = "ID",
                    idx_col: str = "idx") -> DataFrame:
    """Record-major flattening: values r0a1..r0an, r1a1.. with a dense key.

    ``idx_col`` must be a dense 0-based record index; the flat key is
    ``idx * n + pos`` which orders exactly like the original's pooled
    column and needs no global id assignment.
    """
    n = len(assets)
    return df.select(
        id_col, idx_col, F.posexplode(F.array(*[F.col(a) for a in assets])).alias("pos", PORTFOLIO)
    ).select(
        (F.col(idx_col) * n + F.col("pos")).alias("flat_idx"),
        id_col,
        F.element_at(F.array(*[F.lit(a) for a in assets]), F.col("pos") + 1).alias("asset"),
        PORTFOLIO,
    )


def stack_targets(df: DataFrame, assets: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., target, x): every value once under its asset and once under
    the pooled portfolio. Feeds one grouped aggregation for all targets;
    the duplication stays inside the task (partial aggregation follows)."""
    pairs = []
    for a in assets:
        pairs += [F.lit(a), F.col(a)]
    for a in assets:
        pairs += [F.lit(PORTFOLIO), F.col(a)]
    n = len(pairs) // 2
    return df.select(
        *keys, F.inline(F.array(*[F.struct(pairs[2 * i].alias("target"), pairs[2 * i + 1].alias("x"))
                                  for i in range(n)]))
    )

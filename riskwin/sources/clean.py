"""What counts as a usable record: one rule for every entry.

A record needs a key and a number for each yield; infinities are numbers. The
others go to the rejects with the reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _missing(assets: Sequence[str]) -> Column:
    bad = F.lit(False)
    for a in assets:
        bad = bad | F.col(a).isNull() | F.isnan(F.col(a).cast("double"))
    return bad


def split_invalid(wide: DataFrame, assets: Sequence[str], id_col: str = "ID") -> tuple[DataFrame, DataFrame]:
    """(valid, rejects): records with a NULL key or a NULL or NaN yield are
    rejected, with a ``reason``. A long table is split by its value column."""
    no_key, no_value = F.col(id_col).isNull(), _missing(assets)
    rejects = wide.where(no_key | no_value).withColumn(
        "reason", F.when(no_key, F.lit("missing key")).otherwise(F.lit("missing or NaN yield")))
    return wide.where(~no_key & ~no_value), rejects


def valid_records(wide: DataFrame, assets: Sequence[str]) -> DataFrame:
    """Records with a number for each yield (statistics need no key)."""
    return wide.where(~_missing(assets))


def valid_values(values: DataFrame, value_col: str = "x") -> DataFrame:
    return values.where(~_missing([value_col]))

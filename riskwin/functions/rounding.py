"""Rounding to decimal places as Python's ``round`` does it: to the nearest
decimal of the exact binary value, half to even.

``x * 10**d`` in doubles can land on a tie that the exact product isn't on
(0.00035 is a little under it). The product's rounding error, found by
splitting ``x`` in two halves, then says on which side it lies.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLIT = float(2 ** 27 + 1)


def round_exact(x: Column, digits: int) -> Column:
    """``round(x, digits)`` for doubles below 2**50 / 10**digits in size; larger
    ones, NaN and infinities come back as they are."""
    scale = F.lit(float(10 ** digits))
    p = x * scale
    high = F.lit(SPLIT) * x - (F.lit(SPLIT) * x - x)
    error = (high * scale - p) + (x - high) * scale
    down = F.floor(p).cast("double")
    on_tie = (p - down == 0.5) & (error != 0.0)
    whole = F.when(on_tie & (error > 0), down + 1).when(on_tie, down).otherwise(F.rint(p))
    return F.when(F.abs(p) < F.lit(float(2 ** 50)), whole / scale).otherwise(x)


def round_exact_sql(x: str, digits: int) -> str:
    """The same in DuckDB SQL."""
    s, p = f"{10 ** digits}.0::DOUBLE", f"(({x}) * {10 ** digits}.0::DOUBLE)"
    high = f"({SPLIT}::DOUBLE * ({x}) - ({SPLIT}::DOUBLE * ({x}) - ({x})))"
    error = f"(({high} * {s} - {p}) + (({x}) - {high}) * {s})"
    return (f"(CASE WHEN {p} - floor({p}) = 0.5 AND {error} <> 0 THEN floor({p}) + CASE WHEN {error} > 0 THEN 1 ELSE 0 END "
            f"ELSE round_even({p}, 0) END / {s})")

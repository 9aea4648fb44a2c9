"""Statistics of one rolling window held as an array column.

``l`` is the window's values in record order, ``s`` the same sorted. All
expressions are native higher-order functions (no Python in the plan);
``F.get`` is 0-based and yields NULL instead of failing when the index is
out of range.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskwin.config import TAIL_SHARE


# Up to this many elements, sums are written out element by element. Longer
# sums use ``aggregate``: measured on 30- and 180-value windows, a long
# unrolled sum makes the generated method too large for the JIT and runs
# 3x slower than the lambda.
UNROLL_LIMIT = 3


def _sum(terms: list[Column]) -> Column:
    """Balanced sum, so the expression tree stays shallow."""
    while len(terms) > 1:
        terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i]
                 for i in range(0, len(terms), 2)]
    return terms[0]


def total(arr: Column, size: int | None = None) -> Column:
    """Sum of the first ``size`` elements (all when the size is unknown)."""
    if size is not None and 0 < size <= UNROLL_LIMIT:
        return _sum([F.get(arr, i) for i in range(size)])
    return F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)


def mean(l: Column, size: int) -> Column:
    return total(l, size) / F.lit(float(size))


def median(s: Column, size: int, rule: str = "reference") -> Column:
    if rule == "reference":
        # elements size//2 and size//2+1 of the sorted window (0-based)
        c = size // 2
        return (F.get(s, c) + F.get(s, c + 1)) / 2
    if size % 2:
        return F.get(s, size // 2)
    return (F.get(s, size // 2 - 1) + F.get(s, size // 2)) / 2


def tail_share(size: int, n_assets: int = 1) -> float:
    """Window tail size as the original computes it: ``0.1*W`` for one
    asset, ``W*(n/10)`` pooled (``W*0.6`` for six assets)."""
    return TAIL_SHARE * size if n_assets == 1 else (size // n_assets) * (n_assets / 10)


def tenth(s: Column, size: int, n_assets: int = 1, rule: str = "reference") -> Column:
    if rule == "reference":
        return F.get(s, int(tail_share(size, n_assets)))
    return F.get(s, max(math.ceil(TAIL_SHARE * size), 1) - 1)


def tail_mean(s: Column, size: int, n_assets: int = 1) -> Column:
    d = tail_share(size, n_assets)
    k = int(d)
    if k == 0:
        # an empty tail: the original sums nothing and divides by 0.1*W
        return F.lit(0.0) if d > 0 else F.lit(None).cast("double")
    if k <= UNROLL_LIMIT:
        return total(s, k) / F.lit(d)
    return total(F.slice(s, 1, k)) / F.lit(d)


def abs_dev(l: Column, m: Column, size: int) -> Column:
    """Sum of absolute deviations from ``m``."""
    if size <= UNROLL_LIMIT:
        return _sum([F.abs(F.get(l, i) - m) for i in range(size)])
    return F.aggregate(l, F.lit(0.0), lambda acc, v: acc + F.abs(v - m))


def safety(l: Column, m: Column, divisor_count, size: int | None = None) -> Column:
    """``m``: the window mean, already a column (computed once per row).
    ``divisor_count``: an int, or a Column for per-series counts."""
    dev = abs_dev(l, m, size) if size else F.aggregate(l, F.lit(0.0), lambda acc, v: acc + F.abs(v - m))
    if isinstance(divisor_count, int):
        return m - dev / F.lit(float(2 * divisor_count))
    return m - dev / (F.lit(2.0) * divisor_count.cast("double"))

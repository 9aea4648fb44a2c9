"""Brute-force statistics in numpy, straight from the written semantics
(sorted samples, explicit indices). Small inputs only."""
import math

import numpy as np


def q(s, p):
    """Value at rank ceil(p*n) (1-based) of sorted s."""
    n = len(s)
    return s[min(max(math.ceil(p * n), 1), n) - 1]


def batch(x):
    x = np.asarray(x, dtype=float)
    n = len(x)
    s = np.sort(x)
    m = x.mean()
    k = int(0.1 * n)
    return {
        "mean": m,
        "median": round(float(q(s, (n // 2 + 1) / n) + q(s, 0.5)) / 2, 4),
        "tenth": q(s, 0.1),
        "tail_mean": s[:k].sum() / k if k else None,
        "safety": m - np.abs(x - m).sum() / (2 * n),
    }


def window(vals, n_full, n_assets=1, median="reference", quantile_index="reference", safety_divisor="history"):
    v = np.asarray(vals, dtype=float)
    size = len(v)
    s = np.sort(v)
    if median == "reference":
        med = (s[size // 2] + s[size // 2 + 1]) / 2
    else:
        med = s[size // 2] if size % 2 else (s[size // 2 - 1] + s[size // 2]) / 2
    share = 0.1 * size if n_assets == 1 else (size // n_assets) * (n_assets / 10)
    tenth = s[int(share)] if quantile_index == "reference" else s[max(math.ceil(0.1 * size), 1) - 1]
    m = v.mean()
    div = n_full * n_assets if safety_divisor == "history" else size
    return {
        "mean": m,
        "median": med,
        "tenth": tenth,
        "tail_mean": s[: int(share)].sum() / share,
        "safety": m - np.abs(v - m).sum() / (2 * div),
    }


def flag(w, b, thr=0.01):
    if b is None or w is None or math.isnan(b) or math.isnan(w):
        return 0
    if 1 + b == 0:
        return 1 if b > w else 0
    return 1 if (b - w) / (1 + b) >= thr else 0

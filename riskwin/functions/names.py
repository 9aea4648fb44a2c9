"""Output column names.

The original job names every statistic after asset and statistic; results
are compared by column name, so these spellings are fixed values.
"""

from __future__ import annotations

import re

from riskwin.config import PORTFOLIO

_ASSET_NUM = re.compile(r"^asset_(\w+)$")


def _short(asset: str) -> str:
    """'asset_3' -> '3'; other names are kept whole."""
    m = _ASSET_NUM.match(asset)
    return m.group(1) if m else asset


# --- fixed values: full-history statistic names ------------------------------
# asset:     mean_asset_i, median_asset_i, quant_asset_i,
#            mean_of_min_ten_percent_asset_i, safety_measure_of_asset_i
# portfolio: mean_full_portfolio, median_full_portfolio, quant_full_portfolio,
#            mean_of_min_ten_percent_for_portfolio, safety_measure_of_portfolio
def batch_name(target: str, stat: str) -> str:
    if target == PORTFOLIO:
        return {
            "mean": "mean_full_portfolio",
            "median": "median_full_portfolio",
            "tenth": "quant_full_portfolio",
            "tail_mean": "mean_of_min_ten_percent_for_portfolio",
            "safety": "safety_measure_of_portfolio",
        }[stat]
    return {
        "mean": f"mean_{target}",
        "median": f"median_{target}",
        "tenth": f"quant_{target}",
        "tail_mean": f"mean_of_min_ten_percent_{target}",
        "safety": f"safety_measure_of_{target}",
    }[stat]


# --- fixed values: rolling-window statistic names ----------------------------
# asset:     mean_of_asset_i_in_win, median_of_asset_i_in_win,
#            one_of_tenth_i_in_win, mean_of_min_ten_percent_i_in_win,
#            safety_measure_on_avgdev_i_in_win
# portfolio: mean_of_full_portfolio_in_win, median_of_full_portfolio_in_win,
#            one_of_tenth_full_portfolio_in_win,
#            mean_of_min_ten_percent_full_portfolio_in_win,
#            safety_measure_on_avgdev_full_portfolio_in_win
def window_name(target: str, stat: str) -> str:
    if target == PORTFOLIO:
        return {
            "mean": "mean_of_full_portfolio_in_win",
            "median": "median_of_full_portfolio_in_win",
            "tenth": "one_of_tenth_full_portfolio_in_win",
            "tail_mean": "mean_of_min_ten_percent_full_portfolio_in_win",
            "safety": "safety_measure_on_avgdev_full_portfolio_in_win",
        }[stat]
    s = _short(target)
    return {
        "mean": f"mean_of_{target}_in_win",
        "median": f"median_of_{target}_in_win",
        "tenth": f"one_of_tenth_{s}_in_win",
        "tail_mean": f"mean_of_min_ten_percent_{s}_in_win",
        "safety": f"safety_measure_on_avgdev_{s}_in_win",
    }[stat]


# --- fixed values: overrun flag names ----------------------------------------
# asset:     aN_mean_ovr, aN_median_ovr, aN_one_of_tenth_ovr,
#            aN_mean_of_min_ten_percent_ovr, aN_safety_measure_on_avgdev_ovr
# portfolio: full_portfolio_mean_ovr, full_portfolio_median_ovr,
#            full_portfolio_one_of_tenth_ovr,
#            full_portfolio_mean_of_min_ten_percent_ovr,
#            full_portfolio_safety_measure_ovr
def flag_name(target: str, stat: str) -> str:
    if target == PORTFOLIO:
        return {
            "mean": "full_portfolio_mean_ovr",
            "median": "full_portfolio_median_ovr",
            "tenth": "full_portfolio_one_of_tenth_ovr",
            "tail_mean": "full_portfolio_mean_of_min_ten_percent_ovr",
            "safety": "full_portfolio_safety_measure_ovr",
        }[stat]
    p = f"a{_short(target)}"
    return {
        "mean": f"{p}_mean_ovr",
        "median": f"{p}_median_ovr",
        "tenth": f"{p}_one_of_tenth_ovr",
        "tail_mean": f"{p}_mean_of_min_ten_percent_ovr",
        "safety": f"{p}_safety_measure_on_avgdev_ovr",
    }[stat]

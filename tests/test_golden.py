"""Golden values (FIXTURES.md section 3): Y1 and Y2 at sf0.01."""
import pytest

from conftest import SF_MID
from riskwin.config import PORTFOLIO, STATS
from riskwin.operators.overrun import overrun_counts
from riskwin.plans.monitor import run_monitor
from riskwin.sources import fixtures as fx

FULL = {
    "asset_1": (0.002165, 0.0018, -0.158757, -0.214852, -0.048829),
    "asset_4": (-0.004793, -0.0043, -0.158261, -0.208501, -0.053880),
    PORTFOLIO: (0.002412, 0.0015, -0.155639, -0.215129, -0.047507),
}
FIRST = {
    "mean_of_asset_1_in_win": 0.006761, "median_of_asset_1_in_win": -0.001794,
    "one_of_tenth_1_in_win": -0.158194, "mean_of_min_ten_percent_1_in_win": -0.175047,
    "safety_measure_on_avgdev_1_in_win": 0.003426,
    "median_of_full_portfolio_in_win": 0.002846, "one_of_tenth_full_portfolio_in_win": -0.171801,
    "mean_of_min_ten_percent_full_portfolio_in_win": -0.245073,
}
Y1_FLAGS = {
    "asset_1": (168, 105, 70, 157, 0), "asset_2": (158, 84, 127, 160, 0), "asset_3": (166, 130, 81, 169, 0),
    "asset_4": (169, 129, 156, 153, 0), "asset_5": (177, 126, 167, 187, 0), "asset_6": (130, 96, 73, 120, 0),
    PORTFOLIO: (57, 60, 111, 127, 0),
}
Y2_FLAGS = {
    "asset_1": (2429, 1563, 1642, 1336, 5), "asset_2": (0, 0, 0, 0, 0), "asset_3": (3, 6, 1073, 684, 0),
    "asset_4": (0, 0, 189, 215, 0), "asset_5": (21, 2432, 0, 0, 0), "asset_6": (31, 18, 4088, 1540, 0),
    PORTFOLIO: (0, 0, 47, 641, 0),
}


def _counts(m):
    return {(r["target"], r["stat"]): r["flagged"] for r in overrun_counts(m.flags, m.assets).collect()}


def test_y1_golden(spark):
    m = run_monitor(fx.wide_from_embeddings(spark, SF_MID), fx.asset_names(6))
    for t, vals in FULL.items():
        for s, v in zip(STATS, vals):
            assert m.baseline.get(t, s) == pytest.approx(v, abs=5e-7), (t, s)
    first = m.windows.where("window_index = 0").first()
    for k, v in FIRST.items():
        assert first[k] == pytest.approx(v, abs=5e-7), k
    assert m.windows.count() == 471
    c = _counts(m)
    for t, vals in Y1_FLAGS.items():
        assert tuple(c[(t, s)] for s in STATS) == vals, t


def test_y2_golden_flag_counts(spark):
    m = run_monitor(fx.wide_from_lineitem(spark, SF_MID), fx.asset_names(6))
    c = _counts(m)
    for t, vals in Y2_FLAGS.items():
        assert tuple(c[(t, s)] for s in STATS) == vals, t

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from riskwin.config import PORTFOLIO, STATS, RiskParams
from riskwin.functions.rounding import round_exact, round_exact_sql
from riskwin.operators.batch import (full_history_stats, history_frame, keyed_stats_frame, stats_long, stats_per_stat,
                                     stats_wide, target_stats)

ASSETS = ["asset_1", "asset_2", "asset_3"]


def wide_df(spark, arr):
    rows = [(i + 1, *map(float, r)) for i, r in enumerate(arr)]
    return spark.createDataFrame(rows, "ID long, " + ", ".join(f"{a} double" for a in ASSETS))


def check(st, arr):
    for j, a in enumerate(ASSETS):
        exp = brute.batch(arr[:, j])
        for s in STATS:
            assert st.get(a, s) == pytest.approx(exp[s], abs=1e-12), (a, s)
    exp = brute.batch(arr.reshape(-1))
    # the portfolio mean is the mean of the asset means (equal counts)
    exp["mean"] = float(np.mean([arr[:, j].mean() for j in range(len(ASSETS))]))
    exp["safety"] = exp["mean"] - np.abs(arr.reshape(-1) - exp["mean"]).sum() / (2 * arr.size)
    for s in STATS:
        assert st.get(PORTFOLIO, s) == pytest.approx(exp[s], abs=1e-12), (PORTFOLIO, s)


@pytest.mark.parametrize("n", [1, 9, 10, 29, 30, 31, 52, 200])
def test_batch_matches_brute_force(spark, n):
    rng = np.random.default_rng(n)
    arr = np.round(rng.normal(0, 0.05, size=(n, len(ASSETS))), 3)  # rounded: many ties
    st = full_history_stats(wide_df(spark, arr), ASSETS)
    if n < 10:
        assert st.get("asset_1", "tail_mean") is None  # k = int(0.1 n) = 0
        arr_k = None
    else:
        check(st, arr)
        arr_k = arr
    assert st.counts[PORTFOLIO] == n * len(ASSETS)
    del arr_k


@pytest.mark.parametrize("accuracy", [50, 200, 20_000])
def test_ranks_are_exact_at_any_accuracy(spark, accuracy):
    """Many ties, skewed values, and targets of all sizes, a NULL one among them."""
    rng = np.random.default_rng(accuracy)
    by = {"a": np.concatenate([rng.normal(size=3000), np.full(1500, 0.25), rng.integers(0, 5, 500) / 10]),
          "b": np.exp(rng.normal(size=1277) * 8), None: np.round(rng.normal(size=900), 1), "c": np.array([3.0] * 11)}
    df = spark.createDataFrame([(t, float(x)) for t, xs in by.items() for x in xs], "target string, x double")
    got = {r["target"]: r for r in target_stats(df, RiskParams(approx_accuracy=accuracy)).collect()}
    assert got.keys() == by.keys()
    for t, xs in by.items():
        exp = brute.batch(xs)
        assert got[t]["n"] == len(xs)
        for s in STATS:
            assert got[t][s] == pytest.approx(exp[s], rel=1e-12, abs=1e-12), (t, s)


def test_approximate_ranks(spark):
    rng = np.random.default_rng(2)
    xs = rng.normal(size=20_000)
    df = spark.createDataFrame([("a", float(x)) for x in xs] + [(None, 1.0)] * 5, "target string, x double")
    got = {r["target"]: r for r in target_stats(df, RiskParams(ranks="approx", approx_accuracy=1000)).collect()}
    exp, s = brute.batch(xs), np.sort(xs)
    assert abs(np.searchsorted(s, got["a"]["tenth"]) - 2000) <= 20
    assert abs(np.searchsorted(s, got["a"]["median"]) - 10_000) <= 21
    assert got["a"]["mean"] == pytest.approx(exp["mean"]) and got["a"]["safety"] == pytest.approx(exp["safety"])
    assert got["a"]["tail_mean"] == pytest.approx(exp["tail_mean"], abs=0.02)
    assert got[None]["tail_mean"] is None and got[None]["median"] == 1.0


def test_infinite_values(spark):
    xs = [float("-inf")] * 5 + [0.5 * i for i in range(90)] + [float("inf")] * 5
    r = target_stats(spark.createDataFrame([("a", x) for x in xs], "target string, x double")).first()
    assert r["tenth"] == sorted(xs)[9] and r["median"] == 22.25


def test_two_values_at_three_millions(spark):
    """Ranks on the border of two heavy values, at default parameters."""
    n = 3_000_000
    wide = spark.range(n).select((F.col("id") + 1).alias("ID"), F.when(F.col("id") % 2 == 0, -0.01).otherwise(0.01).alias("asset_1"))
    st = full_history_stats(wide, ["asset_1"])
    assert st.counts["asset_1"] == n
    assert (st.get("asset_1", "median"), st.get("asset_1", "tenth")) == (0.0, -0.01)
    assert st.get("asset_1", "tail_mean") == pytest.approx(-0.01)
    assert st.get("asset_1", "safety") == pytest.approx(-0.005)


def test_many_keys_need_no_driver_work(spark):
    long = spark.range(200_000).select((F.col("id") % 2000).alias("k"), (F.col("id") % 97 / 100).alias("v"))
    frame = keyed_stats_frame(long, "k", "v")
    rows = {r["k"]: r for r in frame.collect()}
    assert len(rows) == 2000
    for k in (0, 777, 1999):
        exp = brute.batch(np.array([i % 97 / 100 for i in range(k, 200_000, 2000)]))
        assert all(rows[k][s] == pytest.approx(exp[s], abs=1e-12) for s in STATS)


PAIRS = [0.00035, 0.00025, 0.00045, (0.0003 + 0.0004) / 2, -0.00035, 0.12345, 2.5e-5, -2.5e-5, 1.00005, 7.0, 0.0, 1e300,
         float("nan"), float("inf"), 0.5 + 1 / 32768]


def test_rounding_is_pythons(spark):
    rng = np.random.default_rng(5)
    xs = PAIRS + [float(x) for x in rng.integers(-20001, 20001, 4000) / 20000] + [float(x) for x in rng.normal(size=500)]
    xs += [k / 2 ** 14 for k in range(-64, 64)]  # exact ties among them
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(round_exact(F.col("x"), 4)).collect()]
    con = duckdb.connect()
    for x, g in zip(xs, got):
        want = round(x, 4) if math.isfinite(x) else x
        assert g == want or math.isnan(g) and math.isnan(want), x
        if abs(x) < 100:
            assert con.execute(f"SELECT {round_exact_sql(repr(x) + '::DOUBLE', 4)}").fetchone()[0] == want, x


def test_median_of_a_decimal_tie_is_the_same_in_all_forms(spark):
    rows = [(i, 0.0003 if i < 50 else 0.0004) for i in range(100)]
    wide = spark.createDataFrame([(i, v) for i, v in rows], "ID long, asset_1 double")
    keyed = wide.select(F.lit("k").alias("series"), "ID", F.col("asset_1").alias("yield"))
    want = round((0.0003 + 0.0004) / 2, 4)
    assert full_history_stats(wide, ["asset_1"]).get("asset_1", "median") == want
    assert keyed_stats_frame(keyed, "series", "yield").first()["median"] == want
    assert brute.batch(np.array([v for _, v in rows]))["median"] == want


def test_keyed_stats(spark):
    rng = np.random.default_rng(11)
    rows, by = [], {}
    for key, n in (("x", 40), ("y", 75), ("z", 12), (None, 60)):
        vals = np.round(rng.normal(size=n), 2)
        by[key] = vals
        rows += [(key, i, float(v)) for i, v in enumerate(vals)] + [(key, n, None), (key, n + 1, float("nan"))]
    long = spark.createDataFrame(rows, "series string, ID long, yield double")
    got = {r["series"]: r for r in keyed_stats_frame(long, "series", "yield").collect()}
    assert got.keys() == by.keys()
    for key, vals in by.items():
        exp = brute.batch(vals)
        for s in STATS:
            assert got[key][s] == pytest.approx(exp[s], abs=1e-12)


def test_views(spark):
    arr = np.arange(60, dtype=float).reshape(20, 3) / 100
    frame = history_frame(wide_df(spark, arr), ASSETS)
    targets = [*ASSETS, PORTFOLIO]
    wide = stats_wide(frame, targets)
    assert wide.count() == 1 and len(wide.columns) == 20
    assert "mean_of_min_ten_percent_for_portfolio" in wide.columns
    assert stats_long(frame).count() == 20
    assert frame.count() == 4
    per_stat = stats_per_stat(frame, targets)
    assert per_stat.count() == 5 and set(per_stat.columns) == {"stat", *ASSETS, PORTFOLIO}
    assert per_stat.where(F.col("stat") == "mean").first()[PORTFOLIO] == pytest.approx(arr.mean())
    empty = history_frame(wide_df(spark, arr).limit(0), ASSETS)
    assert stats_wide(empty, targets).collect() == [tuple([None] * 20)]


def test_records_with_holes_are_left_out(spark):
    arr = np.arange(60, dtype=float).reshape(20, 3) / 100
    holed = wide_df(spark, arr).unionByName(spark.createDataFrame(
        [(100, None, 1.0, 1.0), (101, 1.0, float("nan"), 1.0)], "ID long, " + ", ".join(f"{a} double" for a in ASSETS)))
    check(full_history_stats(holed, ASSETS), arr)


def test_ranks_with_a_hot_value(spark):
    """One value holds a third of all rows: ties collapse into one count."""
    rng = np.random.default_rng(21)
    xs = np.concatenate([np.full(9000, 0.25), np.round(rng.normal(size=18000), 2)])
    rng.shuffle(xs)
    arr = xs.reshape(-1, 3)
    for accuracy in (200, 20_000):
        check(full_history_stats(wide_df(spark, arr), ASSETS, RiskParams(approx_accuracy=accuracy)), arr)


def test_k_smallest_report_matches_sort(spark):
    from riskwin.operators.order_stats import k_smallest

    rng = np.random.default_rng(8)
    vals = np.round(rng.normal(size=400), 1)  # many ties
    rows = [("a" if i % 3 else "b", i, float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "target string, ID long, x double")
    got = k_smallest(df, 7, "target", "x", ("ID",)).collect()
    for t in ("a", "b"):
        exp = sorted((x, i) for tt, i, x in rows if tt == t)[:7]
        mine = sorted((r["rank"], r["x"], r["ID"]) for r in got if r["target"] == t)
        assert [(x, i) for _, x, i in mine] == exp
        assert [r for r, _, _ in mine] == list(range(1, 8))

import math

from pyspark.sql import functions as F

import brute
from riskwin.functions.overrun import overrun, overrun_vs_scalar
from riskwin.sinks.metrics import RULE, metrics_block, overrun_lines

CASES = [
    (0.5, 0.6), (0.594, 0.6), (0.6, 0.6), (0.7, 0.6),  # fall / no fall / rise
    (-2.0, -1.0), (0.0, -1.0), (-1.0, -1.0),           # 1 + baseline == 0
    (float("nan"), 0.1), (0.1, float("nan")),          # NaN never flags
    (float("inf"), float("inf")), (float("-inf"), float("inf")), (0.1, float("inf")), (0.1, float("-inf")), (float("-inf"), 0.1),
    (-0.02, 0.0), (-0.01, 0.0), (0.0, -0.5), (-0.51, -0.5), (3.0, -3.0), (-3.1, -3.0),
]


def test_overrun_predicate(spark):
    df = spark.createDataFrame(CASES, "w double, b double")
    rows = df.select("w", "b", overrun(F.col("w"), F.col("b"), 0.01).alias("f")).collect()
    for r in rows:
        assert r["f"] == brute.flag(r["w"], r["b"]), (r["w"], r["b"])
    for w, b in CASES:
        got = df.where((F.col("w").eqNullSafe(w)) if not math.isnan(w) else F.isnan("w")) \
            .where((F.col("b").eqNullSafe(b)) if not math.isnan(b) else F.isnan("b")) \
            .select(overrun_vs_scalar(F.col("w"), b, 0.01).alias("f")).first()["f"]
        assert got == brute.flag(w, b), (w, b)


def test_overrun_null_is_zero(spark):
    df = spark.createDataFrame([(None, 0.5)], "w double, b double")
    assert df.select(overrun(F.col("w"), F.col("b"), 0.01)).first()[0] == 0
    assert df.select(overrun_vs_scalar(F.col("w"), None, 0.01)).first()[0] == 0


def test_overrun_line_layout(spark):
    cols = ["a1_mean_ovr", "full_portfolio_mean_ovr"]
    flags = spark.createDataFrame([(0, 1, 0), (7, 0, 0)], "window_index long, " + ", ".join(f"{c} int" for c in cols))
    lines = overrun_lines(flags, ["asset_1"], ["mean"]).orderBy("window_index").collect()
    assert [r["line"] for r in lines] == ["0 [1, 0]", "7 [0, 0]"]


def test_metrics_block(spark):
    long = spark.createDataFrame(
        [(t, s, float(i)) for i, (t, s) in enumerate((t, s) for s in ("mean", "median", "tenth", "tail_mean", "safety")
                                                      for t in ("asset_1", "full_portfolio"))],
        "target string, stat string, value double")
    block = metrics_block(long, "FULL_PORTFOLIO_BATCH_DATA_PER_STAT", ["asset_1", "full_portfolio"])
    lines = [r["line"] for r in block.orderBy("seq").collect()]
    assert lines[0] == RULE and lines[-1] == RULE
    assert lines[1].startswith("Time of execution: ")
    assert lines[2] == "FULL_PORTFOLIO_BATCH_DATA_PER_STAT"
    assert lines[3] == "{'mean_asset_1': 0.0, 'mean_full_portfolio': 1.0}"
    assert len(lines) == 9
    per_asset = metrics_block(long, "PER_ASSET", ["asset_1", "full_portfolio"], by="target")
    lines = [r["line"] for r in per_asset.orderBy("seq").collect()]
    assert lines[3].startswith("{'mean_asset_1': 0.0, 'median_asset_1': 2.0")
    assert "'mean_of_min_ten_percent_for_portfolio': 7.0" in lines[4]

import os

import pytest

from riskwin.config import RiskParams
from riskwin.session import scratch_path
from riskwin.sources.text import parse_lines, read_yield_text, write_yield_text


def test_parse_lines_with_rejects(spark):
    lines = spark.createDataFrame([
        ('"1" 0.1 0.2 0.3 0.4 0.5 0.6',),
        ("2 -0.1 -0.2 -0.3 -0.4 -0.5 -0.6 extra tokens",),
        ("  3\t1e-3 2 3 4 5 6  ",),
        ("4 0.1 0.2",),
        ("5 NA 0.2 0.3 0.4 0.5 0.6",),
        ("",),
        ('"x" 0.1 0.2 0.3 0.4 0.5 0.6',),
        ("\t6 0.1 0.2 0.3 0.4 0.5 0.6\x0b",),
        ("\t",),
        (None,),
        ("7 0.1f 0.2d 0.3 0.4 0.5 0.6",),
    ], "value string")
    good, bad = parse_lines(lines, 6)
    rows = sorted(good.collect())
    assert [r["ID"] for r in rows] == [1, 2, 3, 6]
    assert rows[0]["asset_6"] == 0.6 and rows[2]["asset_1"] == 0.001
    reasons = sorted(r["reason"] for r in bad.collect())
    assert reasons == ["blank"] * 3 + ["not a number"] * 3 + ["too few tokens"]


@pytest.mark.parametrize("token", ["1", "-1.5", "+.5", "1.", "1e3", "-1E-3", "0.1f", "0.2d", "1_0", "", "abc", ".", "e5", "0x10", "inf", "-Infinity"])
def test_numbers_are_what_float_takes(spark, token):
    good, _ = parse_lines(spark.createDataFrame([(f"1 {token} 2",)], "value string"), 2)
    try:
        want = [float(token)] if "_" not in token and token else []
    except ValueError:
        want = []
    assert [r["asset_1"] for r in good.collect()] == want


def test_text_roundtrip(spark):
    df = spark.createDataFrame([(i, i / 7, -i / 3, 1e-9 * i, 0.0, 1.5, -2.25) for i in range(1, 50)],
                               "ID long, " + ", ".join(f"asset_{i} double" for i in range(1, 7)))
    path = scratch_path(spark, "test-text")
    write_yield_text(df, path, [f"asset_{i}" for i in range(1, 7)])
    assert any(f.startswith("part-") for f in os.listdir(path.removeprefix("file:")))
    good, bad = read_yield_text(spark, path, 6)
    assert bad.count() == 0
    assert sorted(good.collect()) == sorted(df.collect())


def test_split_invalid_and_monitor_ignores_bad_records(spark):
    from riskwin.plans.monitor import run_monitor
    from riskwin.sources.clean import split_invalid

    rows = [(i, 0.01 * ((i * 7) % 13) - 0.05, 0.02 * ((i * 5) % 11) - 0.1) for i in range(1, 61)]
    bad = [(61, None, 0.1), (62, float("nan"), 0.1), (None, 0.1, 0.1)]
    df = spark.createDataFrame(rows + bad, "ID long, asset_1 double, asset_2 double")
    valid, rejects = split_invalid(df, ["asset_1", "asset_2"])
    assert valid.count() == 60
    assert sorted(r["reason"] for r in rejects.collect()) == ["missing key", "missing or NaN yield",
                                                              "missing or NaN yield"]
    clean = spark.createDataFrame(rows, "ID long, asset_1 double, asset_2 double")
    a = run_monitor(df, ["asset_1", "asset_2"])
    b = run_monitor(clean, ["asset_1", "asset_2"])
    assert sorted(map(tuple, a.flags.collect())) == sorted(map(tuple, b.flags.collect()))
    assert a.rejects.count() == 3 and b.rejects.count() == 0
    for engine in ("blocks", "native"):
        m = run_monitor(df, ["asset_1", "asset_2"], params=RiskParams(engine=engine), persist=True)
        assert m.windows.count() == 31


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from riskwin.session import checkpoint_root

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(session)


def test_text_sinks_append(spark):
    from riskwin.sinks.metrics import append_flags, append_lines, append_scalar

    path = scratch_path(spark, "test-lines")
    lines = spark.createDataFrame([(2, "b"), (1, "a")], "seq long, line string")
    append_lines(lines, path, "seq")
    append_lines(lines, path, "seq")
    assert sorted(r[0] for r in spark.read.text(path).collect()) == ["a", "a", "b", "b"]
    scalar = scratch_path(spark, "test-scalar")
    append_scalar(spark, scalar, "BATCH", "mean_asset_1", 0.5)
    append_scalar(spark, scalar, "BATCH", "mean_asset_2", None)
    text = [r[0] for r in spark.read.text(scalar).collect()]
    assert len(text) == 10 and "mean_asset_1: 0.5" in text and "mean_asset_2: None" in text
    flags = scratch_path(spark, "test-flags")
    append_flags(lines, flags)
    append_flags(lines, flags)
    assert spark.read.parquet(flags).count() == 4


def test_append_stats_sink(spark):
    from riskwin.sinks.metrics import append_stats

    long = spark.createDataFrame([("asset_1", "mean", 0.5)], "target string, stat string, value double")
    path = scratch_path(spark, "test-sink")
    append_stats(long, path, "FULL_PORTFOLIO_BATCH_DATA_PER_STAT")
    append_stats(long, path, "FULL_PORTFOLIO_BATCH_DATA_PER_ASSET")
    out = spark.read.parquet(path)
    assert out.count() == 2 and {"run_ts", "header", "target", "stat", "value"} <= set(out.columns)

"""Appends that are repeated under a run's name."""
import pytest
from pyspark.sql import functions as F

from riskwin.sinks.metrics import append_flags, append_lines, append_scalar, append_stats
from riskwin.sinks.runs import manifest, read_runs, write_run


def flags_of(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "window_index long, flag int")


def test_a_repeated_run_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "flags")
    append_flags(flags_of(spark, 1, 2, 3), path, "007")
    append_flags(flags_of(spark, 9), path, "b")
    append_flags(flags_of(spark, 1, 2), path, "007")
    got = read_runs(spark, path)
    assert sorted((r["run_seq"], r["run_id"], r["flag"]) for r in got.collect()) == [(0, "007", 1), (0, "007", 2), (1, "b", 9)]
    assert spark.read.parquet(path).count() == 3
    assert sorted(map(tuple, manifest(spark, path).collect())) == [("007", 0, 2), ("b", 1, 1)]


def test_lines_keep_their_order(spark, tmp_path):
    path = str(tmp_path / "lines")
    lines = spark.range(3000).select("id", F.concat(F.lit("line "), "id").alias("line")).repartition(7)
    for run, n in (("x", 3000), ("y", 5), ("x", 3000)):
        append_lines(lines.where(F.col("id") < n), path, "id", run)
    for run, n in (("x", 3000), ("y", 5)):
        files = sorted((tmp_path / "lines" / f"run_id={run}").glob("part-*"))
        assert [row for f in files for row in f.read_text().splitlines()] == [f"line {i}" for i in range(n)]
    assert read_runs(spark, path, "text").count() == 3005


def test_a_run_that_broke_off(spark, tmp_path):
    path = str(tmp_path / "stats")
    rows = spark.createDataFrame([("a", "mean", 0.5)], "target string, stat string, value double")
    append_stats(rows, path, "Baseline", "r1")
    broken = rows.withColumn("value", F.raise_error(F.lit("lost")).cast("double"))
    for run in ("r2", "r1"):
        with pytest.raises(Exception, match="lost"):
            append_stats(broken, path, "Baseline", run)
    append_stats(rows, path, "Baseline", "r3")
    assert [r["run_id"] for r in read_runs(spark, path).collect()] == ["r3"]
    for run in ("r1", "r2"):
        append_stats(rows, path, "Baseline", run)
    assert sorted((r["run_seq"], r["run_id"]) for r in read_runs(spark, path).collect()) == [(0, "r1"), (1, "r2"), (2, "r3")]


def test_scalars_names_and_empty_runs(spark, tmp_path):
    path = str(tmp_path / "scalar")
    for _ in range(2):
        append_scalar(spark, path, "Baseline", "mean", 0.25, "once")
    assert read_runs(spark, path, "text").where("value = 'mean: 0.25'").count() == 1
    for name in ("", "a/b", "..", "_x", "a b"):
        with pytest.raises(ValueError):
            write_run(flags_of(spark, 1), path, name)
    empty = str(tmp_path / "empty")
    assert write_run(flags_of(spark, 1).limit(0), empty, "none") == 0
    assert write_run(flags_of(spark, 4), empty, "some") == 1
    assert [r["run_id"] for r in read_runs(spark, empty).collect()] == ["some"]


def test_without_a_name_rows_are_added(spark, tmp_path):
    path = str(tmp_path / "plain")
    for _ in range(2):
        append_flags(flags_of(spark, 1), path)
    assert spark.read.parquet(path).count() == 2

"""Plan shape: what the optimizer must (not) produce at scale."""
import pytest

import __spark_entry__ as se
from conftest import SF_SMALL
from riskwin.config import RiskParams
from riskwin.operators.batch import keyed_stats_frame
from riskwin.operators import index
from riskwin.operators.index import dense_index
from riskwin.operators.rolling import rolling_stats
from riskwin.sources import fixtures as fx


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("engine", ["blocks", "native"])
def test_window_plan_has_one_hash_exchange_and_no_single_partition(spark, engine):
    wide = fx.wide_from_embeddings(spark, SF_SMALL)
    idx = dense_index(wide, "ID", contiguous=True)  # no shuffle for the index
    p = plan(rolling_stats(idx.df, fx.asset_names(6), idx.n_rows, RiskParams(engine=engine)))
    assert "SinglePartition" not in p
    assert p.count("Exchange hashpartitioning(blk") == 1
    assert p.count("Exchange") == 1


@pytest.fixture
def many_buckets(monkeypatch):
    """The small test tables dealt like large ones."""
    monkeypatch.setattr(index, "LEAST_ROWS", 1)


def test_flagship_scan_is_pruned(spark, many_buckets):
    p = plan(se.entry(spark))
    scans = [line for line in p.splitlines() if "FileScan parquet" in line]
    assert scans and all("[vec_id" in s and "label" not in s for s in scans)
    assert "SinglePartition" not in p


def test_gapped_index_has_one_exchange_and_no_checkpoint(spark, many_buckets):
    y2 = fx.wide_from_lineitem(spark, SF_SMALL)
    p = plan(dense_index(y2, "ID").df)
    assert "ExistingRDD" not in p and "Join" not in p
    assert "SinglePartition" not in p
    assert p.count("Exchange hashpartitioning(_bucket") == 1


def test_history_has_no_literal_of_a_target(spark):
    long = fx.long_from_events(spark, SF_SMALL)
    p = plan(keyed_stats_frame(long, "series", "yield"))
    assert "click" not in p and "SinglePartition" not in p


def test_values_are_not_dealt_by_target(spark):
    """10^10 values of seven targets: the lookup is small, whatever the estimate."""
    from pyspark.sql import functions as F
    from riskwin.operators.batch import target_stats
    from riskwin.operators import batch, order_stats

    asked = []
    real = order_stats.attach

    def seen(rows, *more):
        asked.append(plan(real(rows, *more)))
        return real(rows, *more)

    small = spark.range(2000).select((F.col("id") % 7).cast("string").alias("target"), F.rand(1).alias("x"))
    order_stats.attach = batch.attach = seen
    try:
        target_stats(small)
        target_stats(small, stats=["mean", "safety"])
    finally:
        order_stats.attach = batch.attach = real
    assert len(asked) == 2 and all("BroadcastHashJoin" in p and "Exchange hash" not in p and "SortMergeJoin" not in p for p in asked)
    # a large table is looked up the same way: nothing is run here
    large = spark.range(10 ** 10).select((F.col("id") % 7).alias("target"), F.col("id").cast("double").alias("x"))
    heads = spark.createDataFrame([(i, 10 ** 9, 0.5) for i in range(7)], "of long, n long, mean double")
    assert "Exchange hash" not in plan(real(large, heads, "target", "of", "n"))


def test_many_targets_with_a_hot_one(spark, monkeypatch):
    from pyspark.sql import functions as F
    from riskwin.operators import lookup

    monkeypatch.setattr(lookup, "LOOKUP_ROWS", 5)
    monkeypatch.setattr(lookup, "KEY_ROWS", 50)
    values = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 40).alias("target"), F.col("id").cast("double").alias("x"))
    heads = values.groupBy(F.col("target").alias("of")).agg(F.count("*").alias("n"), F.sum("x").alias("s"))
    got = lookup.attach(values, heads, "target", "of", "n").groupBy("target", "n", "s").agg(F.count("*").alias("c"), F.sum("x").alias("t")).collect()
    assert len(got) == 41 and all(r["c"] == r["n"] and r["t"] == r["s"] for r in got)


def test_safety_needs_no_ranks(spark):
    wide = fx.wide_from_embeddings(spark, SF_SMALL)
    from riskwin.operators.batch import history_frame
    p = plan(history_frame(wide, fx.asset_names(6), stats=["safety"]))
    assert "percentile_approx" not in p and "Window" not in p

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from riskwin.config import STATS, RiskParams
from riskwin.operators.index import block_size, bucket_of, dense_index
from riskwin.operators.series import flags_by_series, rolling_by_series


def test_dense_index(spark):
    rng = np.random.default_rng(1)
    ids = rng.choice(1_000_000, size=5000, replace=False)
    df = spark.createDataFrame([(int(i),) for i in ids], "ID long").repartition(7)
    got = dense_index(df, "ID", bucket_rows=300)
    assert (got.n_rows, got.first_key, got.last_key) == (5000, ids.min(), ids.max())
    mapping = {r["ID"]: r["idx"] for r in got.df.collect()}
    assert len(mapping) == 5000
    for pos, i in enumerate(np.sort(ids)):
        assert mapping[int(i)] == pos


def test_repeated_ids_follow_their_columns(spark):
    """A repeat that balances a gap: 40 records, ID 10 twice, ID 11 missing."""
    rows = [(i if i != 11 else 10, float(-i)) for i in range(40)]
    for part in (1, 3):
        got = dense_index(spark.createDataFrame(rows, "ID long, x double").repartition(part), "ID", bucket_rows=5).df.collect()
        assert [(r["ID"], r["x"]) for r in sorted(got, key=lambda r: r["idx"])] == sorted(rows)
        assert sorted(r["idx"] for r in got) == list(range(40))


def test_a_hot_id(spark):
    rows = [(7, float(i % 9)) for i in range(600)] + [(i, 0.0) for i in range(20)]
    got = dense_index(spark.createDataFrame(rows, "ID long, x double"), "ID", bucket_rows=50).df.collect()
    assert [(r["ID"], r["x"]) for r in sorted(got, key=lambda r: r["idx"])] == sorted(rows)


def test_contiguous_ids_need_no_shuffle(spark):
    df = spark.range(10, 60).withColumnRenamed("id", "ID")
    got = dense_index(df, "ID", contiguous=True).df
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["ID"] - 10, r["idx"]) for r in got.collect()) == [(i, i) for i in range(50)]


def test_dense_index_of_nothing(spark):
    df = spark.createDataFrame([], "ID long, x double")
    got = dense_index(df, "ID")
    assert got.n_rows == 0 and got.df.count() == 0 and got.last_key is None


def test_dense_index_keyed(spark):
    rng = np.random.default_rng(2)
    rows = []
    for key, n in (("a", 400), ("b", 3), ("c", 1200), (None, 50)):
        ids = rng.choice(100_000, size=n, replace=False)
        rows += [(key, int(i)) for i in ids]
    df = spark.createDataFrame(rows, "series string, ID long")
    got = dense_index(df, "ID", keys=["series"], bucket_rows=100).df.collect()
    assert len(got) == len(rows)
    for key in ("a", "b", "c", None):
        mine = sorted((r["ID"], r["idx"]) for r in got if r["series"] == key)
        assert [i for _, i in mine] == list(range(len(mine)))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9])
def test_buckets_are_found_by_bisection(spark, n):
    cuts = [10 * i for i in range(n)]
    got = spark.range(-5, 100).select("id", bucket_of(F.col("id"), cuts).alias("b")).collect()
    assert all(r["b"] == sum(c <= r["id"] for c in cuts) for r in got)


def test_block_size_bounds():
    assert block_size(10, 30, 1_000_000, 8) == 480
    assert block_size(10**12, 30, 1_000_000, 8000) == 1_000_000
    assert block_size(10**7, 30, 1_000_000, 8) == 312_500


def _series(spark):
    rng = np.random.default_rng(4)
    rows, by = [], {}
    for key, n in (("k1", 95), ("k2", 31), ("k3", 12)):
        vals = np.round(rng.normal(size=n), 3)
        ids = np.sort(rng.choice(50_000, size=n, replace=False))
        by[key] = vals
        rows += [(key, int(i), float(v)) for i, v in zip(ids, vals)]
    perm = rng.permutation(len(rows))
    return spark.createDataFrame([rows[i] for i in perm], "series string, ID long, yield double"), by


@pytest.mark.parametrize("engine", ["blocks", "native"])
def test_rolling_by_series(spark, engine):
    long, by = _series(spark)
    got = rolling_by_series(long, RiskParams(block_rows=40, engine=engine)).collect()
    for key, vals in by.items():
        mine = sorted((r for r in got if r["series"] == key), key=lambda r: r["window_index"])
        assert len(mine) == max(len(vals) - 29, 0)
        for r in mine:
            i = r["window_index"]
            exp = brute.window(vals[i:i + 30], len(vals))
            for s in STATS:
                assert r[s] == pytest.approx(exp[s], abs=1e-12)


def test_flags_by_series(spark):
    long, by = _series(spark)
    got = flags_by_series(long, RiskParams(block_rows=40)).collect()
    for key, vals in by.items():
        base = brute.batch(vals)
        for r in (r for r in got if r["series"] == key):
            i = r["window_index"]
            w = brute.window(vals[i:i + 30], len(vals))
            for s in STATS:
                assert r[f"{s}_ovr"] == brute.flag(w[s], base[s])


def test_null_series_and_holes(spark):
    long, by = _series(spark)
    vals = [0.01 * (i % 7) for i in range(40)]
    more = spark.createDataFrame([(None, i, v) for i, v in enumerate(vals)] + [("k1", 60_000, None), ("k2", None, 1.0),
                                  ("k3", 60_001, float("nan"))], "series string, ID long, yield double")
    got = flags_by_series(long.unionByName(more)).collect()
    assert sum(r["series"] is None for r in got) == 11
    assert len(got) == 11 + sum(max(len(v) - 29, 0) for v in by.values())

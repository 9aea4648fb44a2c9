import glob
import os

import numpy as np
import pytest

import brute
from riskwin.config import PORTFOLIO, RiskParams
from riskwin.functions.names import window_name
from riskwin.operators.index import dense_index, halo_blocks
from riskwin.operators.rolling import rolling_stats

ASSETS = ["asset_1", "asset_2"]


def frame(spark, arr, ids=None):
    ids = ids if ids is not None else list(range(1, len(arr) + 1))
    rows = [(int(i), *map(float, r)) for i, r in zip(ids, arr)]
    return spark.createDataFrame(rows, "ID long, asset_1 double, asset_2 double")


def run(spark, arr, params, ids=None):
    df = frame(spark, arr, ids)
    idx = dense_index(df, "ID").df
    out = rolling_stats(idx, ASSETS, len(arr), params).orderBy("window_index").collect()
    return out


def expected(arr, params, order=None):
    W = params.window
    a = arr if order is None else arr[order]
    n = len(a)
    rows = []
    for i in range(n - W + 1):
        row = {}
        for j, asset in enumerate(ASSETS):
            st = brute.window(a[i:i + W, j], n, 1, params.median, params.quantile_index, params.safety_divisor)
            row.update({window_name(asset, s): v for s, v in st.items()})
        st = brute.window(a[i:i + W].reshape(-1), n, len(ASSETS), params.median, params.quantile_index,
                          params.safety_divisor)
        row.update({window_name(PORTFOLIO, s): v for s, v in st.items()})
        rows.append(row)
    return rows


ENGINES = ["blocks", "native"]


@pytest.mark.parametrize("engine", ENGINES)
@pytest.mark.parametrize("n,block", [(29, 64), (30, 64), (31, 64), (157, 29), (157, 40), (300, 1000)])
def test_halo_blocks_equal_global_window(spark, n, block, engine):
    rng = np.random.default_rng(n + block)
    arr = rng.normal(0, 0.05, size=(n, 2))
    params = RiskParams(block_rows=block, engine=engine)
    got = run(spark, arr, params)
    exp = expected(arr, params)
    assert len(got) == len(exp) == max(n - 29, 0)
    for g, e in zip(got, exp):
        for k, v in e.items():
            assert g[k] == pytest.approx(v, abs=1e-12), k
    assert [r["window_index"] for r in got] == list(range(len(exp)))


@pytest.mark.parametrize("engine", ENGINES)
@pytest.mark.parametrize("opts", [dict(median="true"), dict(quantile_index="disc"),
                                  dict(safety_divisor="window"), dict(window=7, block_rows=10)])
def test_options(spark, opts, engine):
    rng = np.random.default_rng(5)
    arr = rng.normal(0, 0.05, size=(80, 2))
    params = RiskParams(engine=engine, **opts)
    got = run(spark, arr, params)
    exp = expected(arr, params)
    assert len(got) == len(exp)
    for g, e in zip(got, exp):
        for k, v in e.items():
            assert g[k] == pytest.approx(v, abs=1e-12), k


@pytest.mark.parametrize("engine", ENGINES)
def test_gapped_shuffled_ids(spark, engine):
    rng = np.random.default_rng(9)
    n = 120
    ids = np.sort(rng.choice(10_000, size=n, replace=False)) + 5
    arr = rng.normal(0, 0.05, size=(n, 2))
    perm = rng.permutation(n)
    params = RiskParams(block_rows=33, engine=engine)
    got = run(spark, arr[perm], params, ids=ids[perm])
    exp = expected(arr, params)
    assert len(got) == len(exp)
    for g, e in zip(got, exp):
        for k, v in e.items():
            assert g[k] == pytest.approx(v, abs=1e-12), k


def test_halo_rows(spark):
    df = spark.range(100).withColumnRenamed("id", "idx")
    blocks = halo_blocks(df, 30, 40).collect()
    own = [r for r in blocks if r["own"]]
    halo = [r for r in blocks if not r["own"]]
    assert len(own) == 100
    # first 29 rows of blocks 1 and 2 are copied into the block before
    assert sorted(r["idx"] for r in halo) == list(range(40, 69)) + list(range(80, 100))
    assert all(r["blk"] == r["idx"] // 40 - 1 for r in halo)
    with pytest.raises(ValueError):
        halo_blocks(df, 30, 10)


def test_params_validation():
    for bad in (dict(window=0), dict(block_rows=10), dict(median="x"), dict(quantile_index="x"),
                dict(safety_divisor="x"), dict(engine="x")):
        with pytest.raises(ValueError):
            RiskParams(**bad)


def test_flatten_records_order_on_gapped_ids(spark):
    from riskwin.operators.reshape import flatten_records

    df = frame(spark, np.arange(8, dtype=float).reshape(4, 2), ids=[7, 3, 20, 11])
    flat = flatten_records(dense_index(df, "ID").df, ASSETS).orderBy("flat_idx").collect()
    assert [r["flat_idx"] for r in flat] == list(range(8))
    assert [(r["ID"], r["asset"]) for r in flat] == [(3, "asset_1"), (3, "asset_2"), (7, "asset_1"), (7, "asset_2"),
                                                     (11, "asset_1"), (11, "asset_2"), (20, "asset_1"), (20, "asset_2")]
    assert [r["full_portfolio"] for r in flat] == [2.0, 3.0, 0.0, 1.0, 6.0, 7.0, 4.0, 5.0]


@pytest.mark.parametrize("engine", ["blocks", "native"])
def test_portfolio_of_one_asset(spark, engine):
    """The portfolio's statistics and flags are the asset's."""
    from riskwin.config import PORTFOLIO, STATS, RiskParams
    from riskwin.functions.names import flag_name, window_name
    from riskwin.plans.monitor import run_monitor

    rows = [(i, float((i * 37) % 53) / 100 - 0.2) for i in range(90)]
    m = run_monitor(spark.createDataFrame(rows, "ID long, asset_1 double"), params=RiskParams(engine=engine))
    windows, flags = m.windows.collect(), m.flags.collect()
    assert len(windows) == len(flags) == 61
    for s in STATS:
        assert m.baseline.get("asset_1", s) == pytest.approx(m.baseline.get(PORTFOLIO, s))
        assert all(r[window_name("asset_1", s)] == pytest.approx(r[window_name(PORTFOLIO, s)]) for r in windows)
        assert all(r[flag_name("asset_1", s)] == r[flag_name(PORTFOLIO, s)] for r in flags)


def test_blocks_engine_streams_a_block(spark):
    # a worker's memory may not grow with the block: 200 000 records in one, 35 columns out
    def peak():
        """Largest peak, in MB, of the Python processes that this one's session started."""
        kids, most = {}, {}
        for status in glob.glob("/proc/[0-9]*/status"):
            try:
                with open(status) as f:
                    now = dict(line.split(":", 1) for line in f)
            except OSError:
                continue
            kids.setdefault(int(now["PPid"]), []).append(int(now["Pid"]))
            if now["Name"].strip().startswith("python"):
                most[int(now["Pid"])] = int(now["VmHWM"].split()[0]) / 1024 if "VmHWM" in now else 0
        todo, found = list(kids.get(os.getpid(), [])), [0]
        while todo:
            pid = todo.pop()
            todo += kids.get(pid, [])
            found.append(most.get(pid, 0))
        return max(found)

    assets = [f"asset_{i}" for i in range(1, 7)]
    df = spark.range(200_000).selectExpr("id as idx", *[f"sin(id * {i + 1}) as {a}" for i, a in enumerate(assets)])
    small = rolling_stats(df.where("idx < 2000"), assets, 2000, RiskParams(), n_rows=10**9)
    assert small.count() == 2000 - 29
    before = peak()
    out = rolling_stats(df, assets, 200_000, RiskParams(), n_rows=10**9)
    out.write.format("noop").mode("overwrite").save()
    assert peak() - before < 100
    rows = out.selectExpr("count(*)", "min(window_index)", "max(window_index)", "count(distinct window_index)").first()
    assert tuple(rows) == (200_000 - 29, 0, 200_000 - 30, 200_000 - 29)


def test_blocks_engine_keys_of_any_order(spark):
    # null keys, two key columns given in another order than the table's
    rows = [(k, s, i, float(i * i % 17)) for k in (None, 1) for s in ("x", None) for i in range(70)]
    df = spark.createDataFrame(rows, "k long, s string, idx long, y double")
    params = RiskParams(window=7, block_rows=20)
    blocks, native = (
        sorted((tuple(r) for r in rolling_stats(df, ["y"], 70, RiskParams(window=7, block_rows=20, engine=e), keys=["s", "k"],
                                                portfolio=False, names="plain", n_rows=280)
                .select("s", "k", "window_index", "mean", "median", "tenth", "tail_mean", "safety").collect()), key=str)
        for e in ENGINES)
    assert len(blocks) == len(native) == 4 * (70 - params.window + 1)
    for b, e in zip(blocks, native):
        assert b[:3] == e[:3] and b[3:] == pytest.approx(e[3:], abs=1e-12)

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskwin.config import RiskParams
from riskwin.operators.valuation import portfolio_value
from riskwin.plans.monitor import run_monitor
from riskwin.sources import fixtures as fx
from riskwin.streaming.count_window import stream_flags_from_table


def test_stream_equals_batch(spark):
    wide = fx.wide_from_embeddings(spark, SF_SMALL)
    assets = fx.asset_names(6)
    params = RiskParams(block_rows=64)
    streamed = stream_flags_from_table(spark, wide, assets, params, files=3)
    batch = run_monitor(wide, assets, params=params).flags
    s = sorted(map(tuple, streamed.select(*batch.columns).collect()))
    b = sorted(map(tuple, batch.collect()))
    assert len(s) == len(b) == 471
    assert s == b


def test_portfolio_value_carry_forward(spark):
    d = [dt.date(2020, m, 1) for m in range(1, 6)]
    prices = spark.createDataFrame([
        ("A", d[0], 10.0), ("A", d[1], 11.0), ("A", d[3], 13.0),
        ("B", d[1], 100.0), ("B", d[2], 90.0), ("B", d[4], 80.0),
    ], "asset string, month date, price double")
    holdings = spark.createDataFrame([("A", 2.0), ("B", 0.5)], "asset string, share double")
    rows = portfolio_value(prices, holdings).orderBy("month").collect()
    # month 1 lacks B; then A carries 11 into month 3, B carries 90 into month 4
    assert [r["month"] for r in rows] == d[1:]
    assert [r["portfolio_value"] for r in rows] == [72.0, 67.0, 71.0, 66.0]
    assert rows[0]["cumulative_return"] == 0.0
    assert rows[-1]["cumulative_return"] == pytest.approx(66.0 / 72.0 - 1)


def test_stream_drops_and_counts_late_records(spark):
    import numpy as np

    from riskwin.operators.batch import full_history_stats
    from riskwin.session import scratch_path
    from riskwin.streaming.count_window import CountWindowMonitor
    from riskwin.streaming.replay import run_stream

    assets = ["asset_1", "asset_2"]
    rng = np.random.default_rng(12)
    vals = rng.normal(0, 0.05, size=(90, 2))
    rows = [(i + 1, float(a), float(b)) for i, (a, b) in enumerate(vals)]
    schema = "ID long, asset_1 double, asset_2 double"
    full = spark.createDataFrame(rows, schema)
    params = RiskParams(block_rows=40)
    src = scratch_path(spark, "late-src")
    # three files in ID order; the third also repeats ID 10 (late)
    for chunk in (rows[:35], rows[35:60], rows[60:] + [(10, 9.0, 9.0)]):
        spark.createDataFrame(chunk, schema).coalesce(1).write.mode("append").parquet(src)
    base = full_history_stats(full, assets, params)
    sink, state = scratch_path(spark, "late-sink"), scratch_path(spark, "late-state")
    handler = CountWindowMonitor(spark, assets, base, 90, sink, state, params)
    run_stream(spark, src, full.schema, handler, scratch_path(spark, "late-ck"))
    streamed = spark.read.parquet(sink).drop("batch_id")
    batch = run_monitor(full, assets, params=params).flags
    assert sorted(map(tuple, streamed.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))
    assert handler.late_records() == 1


def test_stream_valuation_equals_batch(spark):
    from riskwin.operators.valuation import segment_holdings
    from riskwin.session import scratch_path
    from riskwin.streaming.replay import run_stream
    from riskwin.streaming.replay import write_in_order
    from riskwin.streaming.valuation_stream import ValuationMonitor, read_values

    prices = fx.segment_prices(spark, SF_SMALL).select("asset", "month", "price")
    holdings = segment_holdings(fx.table(spark, SF_SMALL, "customer"))
    src = scratch_path(spark, "val-src")
    write_in_order(prices, src, "month", 4)
    # a late observation in a final file: an early month again
    early = prices.orderBy("month").limit(1)
    unusable = early.withColumn("price", F.lit(None).cast("double")).unionByName(early.withColumn("month", F.lit(None).cast("date")))
    early.unionByName(unusable).coalesce(1).write.mode("append").parquet(src)
    sink, state = scratch_path(spark, "val-sink"), scratch_path(spark, "val-state")
    handler = ValuationMonitor(spark, holdings, sink, state)
    run_stream(spark, src, prices.schema, handler, scratch_path(spark, "val-ck"))
    streamed = {r["month"]: r for r in read_values(spark, sink).collect()}
    batch = {r["month"]: r for r in portfolio_value(prices, holdings).collect()}
    assert streamed.keys() == batch.keys() and len(batch) > 50
    for m, b in batch.items():
        s = streamed[m]
        assert s["assets_priced"] == b["assets_priced"]
        assert s["portfolio_value"] == pytest.approx(b["portfolio_value"], abs=0.011)
        assert s["cumulative_return"] == pytest.approx(b["cumulative_return"], abs=1e-9)
    assert handler.late_records() == 1 and handler.rejected_records() == 2


def test_stream_valuation_of_shuffled_observations(spark):
    from riskwin.operators.valuation import segment_holdings
    from riskwin.session import scratch_path
    from riskwin.streaming.replay import run_stream
    from riskwin.streaming.valuation_stream import ValuationMonitor, read_values

    prices = fx.segment_prices(spark, SF_SMALL).select("asset", "month", "price")
    some = prices.limit(3).withColumn("asset", F.lit("not held")).withColumn("month", F.to_date(F.lit("1900-01-01")))
    prices = prices.unionByName(some).unionByName(prices.limit(1).withColumn("price", F.lit(float("nan")))).checkpoint()
    holdings = segment_holdings(fx.table(spark, SF_SMALL, "customer"))
    want = {r["month"]: r for r in portfolio_value(prices, holdings).collect()}
    # moderately out of order; wholly shuffled (the month that returns refer to moves)
    place = F.pmod(F.xxhash64("asset", "month"), F.lit(3))
    for name, file in [("near", (F.months_between("month", F.lit("1990-01-01")) / 48 + place / 8).cast("int")), ("all", place)]:
        src, sink, state, ck = (scratch_path(spark, f"shuffled-{name}-{n}") for n in ("src", "sink", "state", "ck"))
        for i in range(4):
            part = prices.where(F.coalesce(file, F.lit(0)) == i)
            if part.count():
                part.coalesce(1).write.mode("append").parquet(src)
        handler = ValuationMonitor(spark, holdings, sink, state)
        run_stream(spark, src, prices.schema, handler, ck)
        got = {r["month"]: r for r in read_values(spark, sink).collect()}
        assert got.keys() == want.keys() and len(got) > 50
        for m, w in want.items():
            assert got[m]["assets_priced"] == w["assets_priced"]
            assert got[m]["portfolio_value"] == pytest.approx(w["portfolio_value"], abs=0.011)
            assert got[m]["cumulative_return"] == pytest.approx(w["cumulative_return"], abs=1e-9)
        assert handler.rejected_records() == 1 and handler.late_records() > 0


def test_replay_writes_chunks_of_several_files_in_order(spark):
    import glob
    import os

    from riskwin.session import scratch_path
    from riskwin.streaming.replay import write_in_order

    rows = spark.range(0, 5000).select((F.col("id") % 1700).alias("ID"), F.col("id").alias("x"))
    src = scratch_path(spark, "wide-replay").removeprefix("file:")
    together = write_in_order(rows, src, "ID", 2, rows_per_file=300)
    files = sorted(glob.glob(f"{src}/*.parquet"), key=os.path.getmtime)
    assert together == min(9, spark.sparkContext.defaultParallelism) and len(files) >= 17
    reach, seen = -1, 0
    for a in range(0, len(files), together):
        chunk = spark.read.parquet(*files[a:a + together])
        lo, hi, n = chunk.agg(F.min("ID"), F.max("ID"), F.count(F.lit(1))).first()
        assert lo > reach and spark.read.parquet(files[a]).count() <= 600
        reach, seen = hi, seen + n
    assert seen == 5000


def test_keyed_stream_windows_equal_batch(spark):
    from riskwin.operators.series import rolling_by_series
    from riskwin.streaming.keyed_windows import stream_rolling_by_series

    long = fx.long_from_events(spark, SF_SMALL)
    cols = ["series", "window_index", "mean", "median", "tenth", "tail_mean", "safety"]
    s = sorted(map(tuple, stream_rolling_by_series(spark, long, files=3).select(*cols).collect()))
    b = sorted(map(tuple, rolling_by_series(long).select(*cols).collect()))
    assert len(s) == len(b) > 800
    for rs, rb in zip(s, b):
        assert rs[:2] == rb[:2]
        assert rs[2:] == pytest.approx(rb[2:], abs=1e-12)


@pytest.mark.parametrize("as_text, files", [(True, 3), (False, 1)])
def test_text_stream_and_single_file(spark, as_text, files):
    wide = fx.wide_from_embeddings(spark, SF_SMALL).where("ID <= 90")
    assets = fx.asset_names(6)
    streamed = stream_flags_from_table(spark, wide, assets, files=files, as_text=as_text)
    batch = run_monitor(wide, assets).flags
    assert sorted(map(tuple, streamed.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))


def test_shuffled_arrival_equals_batch(spark):
    """Records up to 40 IDs out of order wait in the buffer; rejects and late
    ones are counted; the state keeps two slots."""
    import os

    import numpy as np

    from riskwin.operators.batch import full_history_stats
    from riskwin.session import scratch_path
    from riskwin.streaming.count_window import stream_flags

    rng = np.random.default_rng(3)
    assets = ["asset_1", "asset_2"]
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 0.05, (120, 2)))]
    full = spark.createDataFrame(rows, "ID long, asset_1 double, asset_2 double")
    mixed = sorted(rows, key=lambda r: r[0] + rng.integers(0, 30))
    src = scratch_path(spark, "mixed-src")
    chunks = [mixed[:40], mixed[40:70] + [(None, 1.0, 1.0), (500, None, 1.0)], mixed[70:],
              [(1, 9.0, 9.0), (2, 9.0, 9.0)]]
    for chunk in chunks:
        spark.createDataFrame(chunk, full.schema).coalesce(1).write.mode("append").parquet(src)
    base = full_history_stats(full, assets)
    flags, handler = stream_flags(spark, src, assets, base, 120, full.schema, max_delay=40)
    batch = run_monitor(full, assets).flags
    assert sorted(map(tuple, flags.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))
    assert handler.late_records() == 2 and handler.rejected_records() == 2
    folder = handler.state.folder.removeprefix("file:")
    assert all(sorted(os.listdir(f"{folder}/{t}")) == ["slot=0", "slot=1"] for t in os.listdir(folder))


def test_keyed_stream_counts_late_records_and_meets_new_series(spark):
    from riskwin.session import scratch_path
    from riskwin.streaming.keyed_windows import keyed_window_stream

    src, sink = scratch_path(spark, "kl-src"), scratch_path(spark, "kl-sink")
    schema = "series string, ID long, yield double"
    first = [("a", i, 0.1 * i) for i in range(40)] + [("new", i, 0.2) for i in range(30)]
    second = [("a", i, 0.1 * i) for i in range(35, 50)] + [(None, 1, 1.0)]
    for chunk in (first, second):
        spark.createDataFrame(chunk, schema).coalesce(1).write.mode("append").parquet(src)
    counts = spark.createDataFrame([("a", 50)], "series string, n long")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = keyed_window_stream(stream, counts).writeStream.format("parquet").option("path", sink).option(
        "checkpointLocation", scratch_path(spark, "kl-ck")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.parquet(sink).collect()
    assert sum(r["late"] for r in rows if r["series"] == "a") == 5
    windows = sorted(r["window_index"] for r in rows if r["series"] == "a" and r["window_index"] is not None)
    assert windows == list(range(21))
    new = [r for r in rows if r["series"] == "new"]
    assert len(new) == 1 and new[0]["safety"] is None and new[0]["mean"] == pytest.approx(0.2)


def test_keyed_stream_out_of_order_equals_batch(spark):
    """Records up to 25 IDs out of order, a series without a name, gaps in the IDs,
    unusable rows: all windows as in the batch job, and the rows left out counted."""
    from pyspark.sql import functions as F
    from riskwin.operators.series import flags_by_series, rolling_by_series
    from riskwin.streaming.keyed_windows import stream_flags_by_series, stream_windows

    rows = [((None, "a", "b")[i % 3], 2 * i, float((i * 7919) % 101) / 50 - 1) for i in range(360)]
    rows += [("a", None, 1.0), ("b", 11, None), ("b", 13, float("nan")), ("only bad", None, None), ("short", 5, 0.5)]
    long = spark.createDataFrame(rows, "series string, ID long, yield double")
    streamed = stream_windows(spark, long, files=6, max_delay=25).persist()
    want = sorted(map(str, rolling_by_series(long).collect()))
    assert sorted(map(str, streamed.where("window_index is not null").drop("late", "rejected").collect())) == want and want
    counted = {r["series"]: (r["l"], r["r"]) for r in streamed.groupBy("series").agg(F.sum("late").alias("l"), F.sum("rejected").alias("r")).collect()}
    assert counted == {None: (0, 0), "a": (0, 1), "b": (0, 2), "only bad": (0, 1)}
    streamed.unpersist()
    # the same arrival without a buffer loses records, and says so
    from riskwin.streaming import keyed_windows as K
    src, _ = K._replay(long, "series", "ID", "yield", 6, 25)
    counts = long.groupBy("series").agg(F.count("yield").alias("n"))
    late = K._run(K.keyed_window_stream(K._source(spark, src), counts), spark).agg(F.sum("late")).first()[0]
    assert late > 0
    flags = stream_flags_by_series(spark, long, files=3, max_delay=10)
    assert sorted(map(str, flags.collect())) == sorted(map(str, flags_by_series(long).collect()))


def test_holding_without_price_is_reported(spark):
    from riskwin.operators.valuation import unpriced_holdings

    d = [dt.date(2019, 12, 1), dt.date(2020, 1, 1), dt.date(2021, 5, 1)]
    prices = spark.createDataFrame([("A", d[0], 10.0), ("A", d[2], 12.0), ("B", d[1], 4.0), ("B", None, 1.0), ("C", d[0], None)],
                                   "asset string, month date, price double")
    holdings = spark.createDataFrame([("A", 1.0), ("B", 1.0), ("C", 1.0)], "asset string, share double")
    rows = portfolio_value(prices, holdings).orderBy("month").collect()
    assert [(r["month"], r["portfolio_value"]) for r in rows] == [(d[1], 14.0), (d[2], 16.0)]
    assert [r["asset"] for r in unpriced_holdings(prices, holdings).collect()] == ["C"]

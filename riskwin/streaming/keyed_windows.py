"""Count windows per series over a stream (STR2, STR3 for many series).

``groupBy(series).applyInPandasWithState``: the state of a series is the number
of its records released, its last released ID, the largest ID seen, its last
``W-1`` values and a buffer of the records that wait. Records may be out of order
by up to ``max_delay`` IDs: those above the series' watermark (the largest ID seen
less ``max_delay``) wait; those not above the last released ID are late. Late and
unusable records are counted and dropped. The windows that became complete are
computed with the same numpy reduction as the batch block engine, some thousand
frames at a time, and emitted in append mode. An end row (``END`` true, no ID)
releases what a series still holds.

The state is ``W-1`` values per series and what lies within the delay. It goes
after ``expire_after_ms`` without records, if that is given (for queries that run
on: with a time-out Spark never ends an ``availableNow`` run); a series that comes
back then starts anew. The shuffle is by series, so one series is one task per
micro-batch (micro-batches bound its size).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from riskwin.config import STATS, RiskParams
from riskwin.functions.overrun import overrun
from riskwin.operators.lookup import LOOKUP_ROWS
from riskwin.operators.rolling_blocks import CHUNK, _stats
from riskwin.operators.series import baseline_by_series
from riskwin.session import checkpoint_root, scratch_path
from riskwin.sources.clean import split_invalid
from riskwin.streaming.replay import write_in_order


#: Column that marks a row as the end of its series.
END = "_end"


def keyed_window_stream(stream: DataFrame, counts: DataFrame, params: RiskParams = RiskParams(),
                        key: str = "series", order: str = "ID", value: str = "yield",
                        expire_after_ms: int | None = None, max_delay: int = 0) -> DataFrame:
    """Streaming DataFrame (key, window_index, mean, median, tenth, tail_mean,
    safety, late, rejected). A row without a window index counts the late and the
    unusable records of a series in a micro-batch.

    ``counts``: table (key, n) of full-history record counts (the original
    safety divisor). A series that isn't in it has no history to be compared
    with: its ``safety`` is NULL."""
    W = params.window
    key_type = stream.schema[key].dataType
    out_schema = T.StructType([T.StructField(key, key_type), T.StructField("window_index", T.LongType())]
                              + [T.StructField(s, T.DoubleType()) for s in STATS]
                              + [T.StructField(c, T.LongType()) for c in ("late", "rejected")])
    state_schema = T.StructType(
        [T.StructField(c, T.LongType()) for c in ("seen", "last_id", "max_id")]
        + [T.StructField("tail", T.ArrayType(T.DoubleType())), T.StructField("held_ids", T.ArrayType(T.LongType())),
           T.StructField("held", T.ArrayType(T.DoubleType()))])
    safety_window = params.safety_divisor == "window"
    names = out_schema.fieldNames()

    def step(k, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen, last_id, max_id, tail, held_ids, held = state.get if state.exists else (0, None, None, [], [], [])
        every = pd.concat(list(pdfs))
        ended = bool(every["_ended"].any())
        rejected = int((~every["_usable"] & ~every["_ended"]).sum())
        rows = every[every["_usable"]]
        ids, vals = rows[order].to_numpy(np.int64), rows[value].to_numpy(np.float64)
        in_time = np.ones(len(ids), bool) if last_id is None else ids > last_id
        late = int((~in_time).sum())
        if late or rejected:
            yield pd.DataFrame([{key: k[0], "late": late, "rejected": rejected}], columns=names).astype(
                {"late": "int64", "rejected": "int64", "window_index": "Int64", **{s: "float64" for s in STATS}})
        ids = np.concatenate([np.asarray(held_ids, np.int64), ids[in_time]])
        vals = np.concatenate([np.asarray(held, np.float64), vals[in_time]])
        in_order = np.lexsort((vals, ids))
        ids, vals = ids[in_order], vals[in_order]
        if len(ids):
            max_id = max(int(ids[-1]), max_id if max_id is not None else int(ids[-1]))
        ready = len(ids) if ended or max_id is None else int(np.searchsorted(ids, max_id - max_delay, "right"))
        if ready:
            frames_of = np.concatenate([np.asarray(tail, dtype=np.float64), vals[:ready]])
            first_idx = seen - len(tail)
            if len(frames_of) >= W:
                every_frame = np.lib.stride_tricks.sliding_window_view(frames_of, W)
                history = every["_n"].iloc[0]
                nf = float(W) if safety_window else float(history) if pd.notna(history) else np.nan
                for c in range(0, len(every_frame), CHUNK):
                    frames = every_frame[c:c + CHUNK]
                    res = _stats(frames, frames.mean(axis=1), W, 1, np.full(len(frames), nf), params)
                    if np.isnan(nf):
                        res["safety"] = [None] * len(frames)
                    none = np.zeros(len(frames), dtype=np.int64)
                    out = {key: [k[0]] * len(frames), "late": none, "rejected": none,
                           "window_index": np.arange(first_idx + c, first_idx + c + len(frames), dtype=np.int64)}
                    yield pd.DataFrame(out | {s: pd.Series(res[s], dtype="float64") for s in STATS})[names]
            seen, last_id = seen + ready, int(ids[ready - 1])
            tail = frames_of[len(frames_of) - (W - 1):].tolist() if W > 1 else []
        state.update((seen, last_id, max_id, list(tail), ids[ready:].tolist(), vals[ready:].tolist()))
        if expire_after_ms:
            state.setTimeoutDuration(expire_after_ms)

    known = counts.select(F.col(key).alias("_key"), F.col("n").cast("double").alias("_n"))
    end = F.coalesce(F.col(END), F.lit(False)) if END in stream.columns else F.lit(False)
    usable = F.col(order).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    rows = stream.select(key, F.coalesce(order, F.lit(0)).cast("long").alias(order), F.col(value).cast("double").alias(value),
                         end.alias("_ended"), (usable & ~end).alias("_usable"))
    rows = rows.join(known, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    timeout = GroupStateTimeout.ProcessingTimeTimeout if expire_after_ms else GroupStateTimeout.NoTimeout
    return rows.groupBy(key).applyInPandasWithState(step, out_schema, state_schema, "append", timeout)


def keyed_flag_stream(windows: DataFrame, baseline: DataFrame, params: RiskParams = RiskParams(),
                      key: str = "series") -> DataFrame:
    """(key, window_index, <stat>_ovr...) of a stream of windows, each against its
    series' row of the static ``baseline`` (``series.baseline_by_series``)."""
    table = F.broadcast(baseline) if baseline.count() <= LOOKUP_ROWS else baseline
    joined = windows.where("window_index IS NOT NULL").join(table, F.col(key).eqNullSafe(F.col("_key")))
    return joined.select(key, "window_index", *[
        overrun(F.col(s), F.col(f"b_{s}"), params.threshold).alias(f"{s}_ovr") for s in STATS])


def _replay(long: DataFrame, key: str, order: str, value: str, files: int, max_delay: int) -> tuple[str, int]:
    """A table as files in the order of ``order``, each record moved by up to
    ``max_delay`` IDs; rows without an ID come first, an end row a series last.
    The folder, and the files of a micro-batch."""
    src, last = scratch_path(long.sparkSession, "keyed-src"), F.lit((1 << 62))
    rows = long.select(key, order, value, F.lit(False).alias(END))
    moved = F.coalesce(F.col(order) + F.pmod(F.xxhash64(order), F.lit(max_delay + 1)), F.lit(-(1 << 62)))
    together = write_in_order(rows.withColumn("_at", moved), src, "_at", files)
    ends = rows.select(key, F.lit(None).cast(dict(rows.dtypes)[order]).alias(order), F.lit(None).cast(dict(rows.dtypes)[value]).alias(value),
                       F.lit(True).alias(END), last.alias("_at")).dropDuplicates([key])
    ends.coalesce(1).write.mode("append").parquet(src)
    return src, together


def _run(out: DataFrame, spark: SparkSession) -> DataFrame:
    sink, ck = (scratch_path(spark, f"keyed-{n}") for n in ("sink", "ck"))
    (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ck)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(out.schema).parquet(sink)


def _source(spark: SparkSession, src: str, max_files: int = 1) -> DataFrame:
    schema = spark.read.parquet(src).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(src)


def stream_windows(spark: SparkSession, long: DataFrame, params: RiskParams = RiskParams(), files: int = 4, key: str = "series",
                   order: str = "ID", value: str = "yield", max_delay: int = 0) -> DataFrame:
    """Replay a long table as a file stream, out of order by up to ``max_delay``
    IDs; return all that is streamed, counts of late and unusable records too."""
    counts = split_invalid(long.select(key, order, value), [value], order)[0].groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    src, together = _replay(long, key, order, value, files, max_delay)
    return _run(keyed_window_stream(_source(spark, src, together), counts, params, key, order, value, max_delay=max_delay), spark)


def stream_rolling_by_series(spark: SparkSession, long: DataFrame, params: RiskParams = RiskParams(),
                             files: int = 4, key: str = "series", order: str = "ID",
                             value: str = "yield", max_delay: int = 0) -> DataFrame:
    """The streamed windows of ``stream_windows``."""
    return stream_windows(spark, long, params, files, key, order, value, max_delay).where(
        "window_index IS NOT NULL").drop("late", "rejected")


def stream_flags_by_series(spark: SparkSession, long: DataFrame, params: RiskParams = RiskParams(), files: int = 4,
                           key: str = "series", order: str = "ID", value: str = "yield", max_delay: int = 0) -> DataFrame:
    """Replay a long table as a file stream; flags of each series' windows against
    its own full history."""
    valid, _ = split_invalid(long.select(key, order, value), [value], order)
    checkpoint_root(spark)
    baseline = baseline_by_series(valid, params, key, value)
    counts = baseline.select(F.col("_key").alias(key), F.col("_n").alias("n"))
    src, together = _replay(long, key, order, value, files, max_delay)
    windows = keyed_window_stream(_source(spark, src, together), counts, params, key, order, value, max_delay=max_delay)
    return _run(keyed_flag_stream(windows, baseline, params, key), spark)

"""Count windows over a stream of yields (STR1-STR4).

Records arrive in files of a folder (Parquet, or lines of text). A micro-batch
alone cannot finish the windows that start in its last ``W-1`` records, so each
batch is joined with a *halo*: the last ``W-1`` records before it. Records may
be out of order by up to ``max_delay`` IDs: those above the watermark (the
largest ID seen less ``max_delay``) wait in a buffer. Per batch:

1. records without a usable ID or yield are counted as rejected; those not
   above the last released ID are late, counted and dropped;
2. the records up to the watermark are released and numbered after the ones
   before (``dense_index``);
3. the rolling statistics over halo + new records are flagged against the
   static full-history baseline (literals, no join);
4. flags go to ``<sink>/batch_id=<id>`` (overwrite, so a replayed batch
   rewrites itself); halo, buffer and counters to the state's slots.

Every window is emitted exactly once: windows starting in the halo were
incomplete in the batch before. The union of all batches, after ``flush`` has
released the buffer, equals the batch job's flags if no record was late.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwin.config import RiskParams
from riskwin.operators.batch import BatchStats, full_history_stats
from riskwin.operators.index import dense_index
from riskwin.operators.overrun import overrun_flags
from riskwin.operators.rolling import rolling_stats
from riskwin.session import scratch_path
from riskwin.sources.clean import split_invalid
from riskwin.sources.text import parse_lines, render_lines
from riskwin.streaming.replay import BatchState, run_stream, write_in_order

COUNTERS = "seen long, last_id long, max_id long, late long, rejected long"


class CountWindowMonitor:
    """``foreachBatch`` handler carrying halo and buffer between micro-batches.

    ``lines``: batches hold lines of text in a column ``value``."""

    def __init__(self, spark: SparkSession, assets: Sequence[str], baseline: BatchStats,
                 n_full: int, sink: str, state: str, params: RiskParams = RiskParams(),
                 max_delay: int = 0, lines: bool = False):
        self.spark, self.assets, self.baseline = spark, list(assets), baseline
        self.n_full, self.sink, self.params = n_full, sink, params
        self.max_delay, self.lines = max_delay, lines
        self.state, self.last_batch = BatchState(spark, state), -1
        values = [T.StructField(a, T.DoubleType()) for a in self.assets]
        self.row_schema = T.StructType([T.StructField("ID", T.LongType()), *values])
        self.halo_schema = T.StructType([T.StructField("ID", T.LongType()), T.StructField("idx", T.LongType()), *values])

    def late_records(self) -> int:
        """Records dropped so far because they came after the watermark."""
        return int(self.state.read_row(self.last_batch)["late"]) if self.last_batch >= 0 else 0

    def rejected_records(self) -> int:
        return int(self.state.read_row(self.last_batch)["rejected"]) if self.last_batch >= 0 else 0

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._step(batch, batch_id, flush=False)

    def flush(self) -> None:
        """Release the buffer: the stream has ended."""
        if self.last_batch >= 0 and self.max_delay:
            source = self.spark.createDataFrame([], "value string" if self.lines else self.row_schema)
            self._step(source, self.last_batch + 1, flush=True)

    def _step(self, batch: DataFrame, batch_id: int, flush: bool) -> None:
        empty_halo = self.spark.createDataFrame([], self.halo_schema)
        if batch_id == 0:
            halo, held = empty_halo, self.spark.createDataFrame([], self.row_schema)
            seen, last_id, max_id, late, rejected = 0, None, None, 0, 0
        else:
            _, seen, last_id, max_id, late, rejected = self.state.read_row(batch_id - 1)
            halo = self.state.read("halo", batch_id - 1, self.halo_schema)
            held = self.state.read("held", batch_id - 1, self.row_schema)
        if self.lines:
            parsed, bad_lines = parse_lines(batch, len(self.assets))
            rejected += bad_lines.count()
            batch = parsed.toDF("ID", *self.assets)
        valid, bad = split_invalid(batch.select("ID", *self.assets), self.assets)
        rejected += bad.count()
        new = valid.persist()
        in_time = new if last_id is None else new.where(F.col("ID") > F.lit(last_id))
        in_time_only = F.lit(True) if last_id is None else F.col("ID") > F.lit(last_id)
        n_late, top = new.agg(F.count_if(~in_time_only), F.max(F.when(in_time_only, F.col("ID")))).first()
        late += n_late
        max_id = max((x for x in (max_id, top) if x is not None), default=None)
        waiting = held.unionByName(in_time)
        mark = None if max_id is None else max_id if flush else max_id - self.max_delay
        released = waiting.where(F.col("ID") <= F.lit(mark)) if mark is not None else waiting.limit(0)
        indexed = dense_index(released, "ID")
        if indexed.n_rows:
            rows = indexed.df.withColumn("idx", F.col("idx") + F.lit(seen)).persist()
            both = halo.unionByName(rows.select(*self.halo_schema.fieldNames()))
            win = rolling_stats(both, self.assets, self.n_full, self.params, n_rows=indexed.n_rows + self.params.window)
            flags = overrun_flags(win, self.baseline, self.assets, self.params)
            flags.write.mode("overwrite").parquet(f"{self.sink}/batch_id={batch_id}")
            seen, last_id = seen + indexed.n_rows, indexed.last_key
            keep = both.where(F.col("idx") >= F.lit(seen - (self.params.window - 1)))
        else:
            rows, keep = None, halo
        self.state.write("halo", batch_id, keep)
        self.state.write("held", batch_id, waiting.where(F.col("ID") > F.lit(mark)) if mark is not None else waiting)
        self.state.write_row(batch_id, (seen, last_id, max_id, late, rejected), COUNTERS)
        self.last_batch = batch_id
        new.unpersist()
        if rows is not None:
            rows.unpersist()


def stream_flags(spark: SparkSession, source: str, assets: Sequence[str], baseline: BatchStats, n_full: int,
                 schema: T.StructType | None, params: RiskParams = RiskParams(), max_delay: int = 0,
                 max_files: int = 1) -> tuple[DataFrame, CountWindowMonitor]:
    """Flags of all files in a folder, and the handler with its counters.
    Without a schema the files are lines of text."""
    sink, state, ck = (scratch_path(spark, f"stream-{n}") for n in ("sink", "state", "ck"))
    handler = CountWindowMonitor(spark, assets, baseline, n_full, sink, state, params, max_delay, schema is None)
    run_stream(spark, source, schema, handler, ck, max_files)
    handler.flush()
    return spark.read.parquet(sink).drop("batch_id"), handler


def stream_flags_from_table(spark: SparkSession, wide: DataFrame, assets: Sequence[str],
                            params: RiskParams = RiskParams(), files: int = 5, as_text: bool = False) -> DataFrame:
    """Replay a table as a file stream and return the streamed flags.

    The baseline is the table's full history (as the batch job)."""
    wide, _ = split_invalid(wide.select("ID", *assets), assets)
    baseline = full_history_stats(wide, assets, params)
    src = scratch_path(spark, "stream-src")
    if as_text:
        together = write_in_order(render_lines(wide, assets, keep_id=True), src, "ID", files, as_text=True)
    else:
        together = write_in_order(wide, src, "ID", files)
    flags, _ = stream_flags(spark, src, assets, baseline, baseline.counts[assets[0]],
                            None if as_text else wide.schema, params, max_files=together)
    return flags

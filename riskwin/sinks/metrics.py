"""Sinks for statistics and flags (SNK1-SNK4).

Structured first: the long statistics table gets ``run_ts`` and ``header``
columns and is appended as Parquet. The original's text layouts are
renderings of the same DataFrames (``write.text``), never built on the
driver:

* metrics block: a rule of 80 dashes, ``Time of execution: <ts>``, the
  header, one line per record, a closing rule;
* overrun line: ``<window_index> [f1, f2, ..., f35]``.

Appends that name their run go through ``sinks/runs.py``: a run that is repeated
replaces its own rows. Without a name every call adds rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskwin.config import STATS
from riskwin.functions.names import batch_name
from riskwin.operators.overrun import flag_columns
from riskwin.sinks.runs import write_run

RULE = "-" * 80


def overrun_lines(flags: DataFrame, assets: Sequence[str], stats: Sequence[str] = STATS) -> DataFrame:
    """(window_index, line) in the original text layout."""
    cols = flag_columns(assets, stats)
    body = F.concat_ws(", ", *[F.col(c).cast("string") for c in cols])
    return flags.select(
        "window_index",
        F.concat(F.col("window_index").cast("string"), F.lit(" ["), body, F.lit("]")).alias("line"),
    )


def with_run_columns(long_stats: DataFrame, header: str) -> DataFrame:
    return long_stats.select(F.current_timestamp().alias("run_ts"), F.lit(header).alias("header"), "*")


def append_stats(long_stats: DataFrame, path: str, header: str, run_id: str | None = None) -> None:
    """SNK1 as data: append one run's statistics to a Parquet table."""
    _append(with_run_columns(long_stats, header), path, "parquet", run_id)


def _append(rows: DataFrame, path: str, kind: str, run_id: str | None) -> None:
    if run_id is None:
        rows.write.mode("append").format(kind).save(path)
    else:
        write_run(rows, path, run_id, kind)


def metrics_block(long_stats: DataFrame, header: str, targets: Sequence[str],
                  by: str = "stat", digits: int | None = None, stamp: bool = True) -> DataFrame:
    """SNK2/SNK3 rendering as (seq, line): ``by='stat'`` gives one line per
    statistic listing every target, ``by='target'`` one line per target
    listing every statistic; framed like the original block. A single
    ``append_lines(..., 'seq')`` writes it in order. ``digits`` fixes the
    decimal places; without ``stamp`` the time line is left out."""
    names = []
    for t in targets:
        for st in STATS:
            names += [F.lit(f"{t}|{st}"), F.lit(batch_name(t, st))]
    name = F.element_at(F.create_map(*names), F.concat_ws("|", "target", "stat"))
    t_pos = F.array_position(F.array(*[F.lit(t) for t in targets]), F.col("target"))
    s_pos = F.array_position(F.array(*[F.lit(st) for st in STATS]), F.col("stat"))
    inner, outer = (t_pos, s_pos) if by == "stat" else (s_pos, t_pos)
    shown = F.col("value").cast("string") if digits is None else F.format_string(f"%.{digits}f", "value")
    entry = F.concat(F.lit("'"), name, F.lit("': "), shown)
    body = (
        long_stats.select(outer.alias("grp"), inner.alias("pos"), entry.alias("e"))
        .groupBy("grp")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "e"))).alias("es"))
        .select((F.col("grp") + 2).cast("long").alias("seq"),
                F.concat(F.lit("{"), F.concat_ws(", ", F.col("es.e")), F.lit("}")).alias("line"))
    )
    spark = long_stats.sparkSession
    frame = spark.createDataFrame([(0, RULE), (2, header), (10 ** 9, RULE)], "seq long, line string")
    if stamp:
        frame = frame.unionByName(time_line(spark))
    return frame.unionByName(body.select((F.col("seq") + 1).alias("seq"), "line"))


def time_line(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        F.lit(1).cast("long").alias("seq"),
        F.concat(F.lit("Time of execution: "), F.current_timestamp().cast("string")).alias("line"))


def append_scalar(spark: SparkSession, path: str, header: str, name: str, value: float | None,
                  run_id: str | None = None) -> None:
    """SNK1 as text: one framed statistic added to a folder of text files."""
    rows = [(0, RULE), (2, header), (3, f"{name}: {value}"), (4, RULE)]
    append_lines(spark.createDataFrame(rows, "seq long, line string").unionByName(time_line(spark)), path, "seq", run_id)


def append_flags(flags: DataFrame, path: str, run_id: str | None = None) -> None:
    """SNK4 as data: add a run's flags to a Parquet table."""
    _append(flags, path, "parquet", run_id)


def append_lines(lines: DataFrame, path: str, order_col: str, run_id: str | None = None) -> None:
    """Add lines to a folder of text files, in order: one file per range
    partition, names in order within a run."""
    _append(lines.orderBy(order_col).select("line"), path, "text", run_id)

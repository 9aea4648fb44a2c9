"""Replaying a table as a file stream, and the state between micro-batches."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwin.operators.index import ascending_cuts, bucket_of
from riskwin.session import scratch_path

#: Rows of a file, and so of a writing task, at most about.
ROWS_PER_FILE = 1_000_000


def write_in_order(df: DataFrame, path: str, order_col: str, chunks: int = 1, as_text: bool = False,
                   rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write a table as about ``chunks`` chunks that arrive in the order of
    ``order_col``; returns the files of a chunk (the last may have fewer).

    A chunk is one file, or one a core where that would be over ``rows_per_file``
    rows (then there are as many chunks as it takes). One pass deals the rows into
    files' ranges; the ranges of a chunk are then moved to the stream's folder in
    parallel, chunk after chunk, so that files of different chunks never arrive in
    the wrong order. ``as_text``: the other column is a line of text."""
    spark = df.sparkSession
    n, least = df.agg(F.count(F.lit(1)), F.min(order_col)).first()
    wanted = max(math.ceil(n / rows_per_file), 1)
    together = min(math.ceil(wanted / chunks), spark.sparkContext.defaultParallelism)
    # each cut is a value of the table above the least, so no range is empty
    cuts = [c for c in ascending_cuts(df, F.col(order_col), max(chunks * together, wanted) - 1) if c != least]
    staged = scratch_path(spark, "replay")
    ranged = df.withColumn("_range", bucket_of(F.col(order_col), cuts).cast("int"))
    ranged.repartitionById(len(cuts) + 1, "_range").write.partitionBy("_range").parquet(staged)
    ranges = spark.read.parquet(staged)
    for first in range(0, len(cuts) + 1, together):
        last = min(first + together, len(cuts) + 1)
        chunk = ranges.where(F.col("_range").between(first, last - 1)).repartitionById(last - first, F.col("_range") - first)
        if as_text:
            chunk.drop("_range", order_col).write.mode("append").text(path)
        else:
            chunk.select(*df.columns).write.mode("append").parquet(path)
    return together


def run_stream(spark: SparkSession, source: str, schema: T.StructType | None, handler: Callable, checkpoint: str,
               max_files: int = 1) -> None:
    """Feed the files of a folder to a ``foreachBatch`` handler, some at a time,
    until all are read. Without a schema the files are lines of text."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    stream = reader.schema(schema).parquet(source) if schema is not None else reader.text(source)
    (stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


class BatchState:
    """Tables that a handler leaves for the next micro-batch.

    Two slots are written in turn, so the state never grows, and a micro-batch
    that is run again finds what the one before it left."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str, batch_id: int) -> str:
        return f"{self.folder}/{name}/slot={batch_id % 2}"

    def write(self, name: str, batch_id: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self.path(name, batch_id))

    def read(self, name: str, batch_id: int, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name, batch_id))

    def write_row(self, batch_id: int, row: tuple, schema: str) -> None:
        """The counters; written last, they mark the batch as done."""
        table = self.spark.createDataFrame([(batch_id, *row)], f"batch_id long, {schema}")
        self.write("counters", batch_id, table.coalesce(1))

    def read_row(self, batch_id: int):
        row = self.spark.read.parquet(self.path("counters", batch_id)).first()
        if row["batch_id"] != batch_id:
            raise RuntimeError(f"the state of batch {batch_id} is gone; found that of {row['batch_id']}")
        return row

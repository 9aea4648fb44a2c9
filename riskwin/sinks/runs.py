"""Tables of runs: a run that is repeated replaces what it wrote before.

A run has a folder of its own, ``run_id=<name>``, and a row in the manifest
(``_runs``: name, number in the order of first runs, rows; no rows while it is being
written). A run that broke off isn't read, and its repetition writes the folder anew
under the number that the run has. One writer a table at a time.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

MANIFEST = "run_id string, run_seq long, n_rows long"
#: Names of runs are names of folders.
NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, run_seq, n_rows) of all runs; no ``n_rows``: it broke off."""
    try:
        return spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").parquet(f"{path}/_runs")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def write_run(rows: DataFrame, path: str, run_id: str, kind: str = "parquet") -> int:
    """Write the rows of a run and give their number; rows that the run has there
    already are replaced."""
    if not NAME.fullmatch(run_id):
        raise ValueError(f"not a name for a run: {run_id!r}")
    spark = rows.sparkSession
    own = F.col("run_id") == run_id
    seq, last = manifest(spark, path).agg(F.max(F.when(own, F.col("run_seq"))), F.max("run_seq")).first()
    if seq is None:
        seq = 0 if last is None else last + 1
    _enter(spark, path, (run_id, seq, None))
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").format(kind).save(f"{path}/run_id={run_id}")
    n = seen.get["n"]
    _enter(spark, path, (run_id, seq, n))
    return n


def _enter(spark: SparkSession, path: str, entry: tuple) -> None:
    spark.createDataFrame([entry], MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/_runs/entry-{entry[0]}")


def read_runs(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """The rows of all whole runs, with ``run_id`` and ``run_seq``."""
    found = spark.read.format(kind).load(path).schema
    # names like 007 stay names
    named = T.StructType([f for f in found if f.name != "run_id"] + [T.StructField("run_id", T.StringType())])
    rows = spark.read.format(kind).schema(named).load(path)
    whole = manifest(spark, path).where("n_rows IS NOT NULL")
    return rows.join(whole.select("run_id", "run_seq"), "run_id")

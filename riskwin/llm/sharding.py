"""Global shuffle into shards, in two passes.

Pass one scatters the records by a seeded hash into buckets of about
``BUCKET_BYTES``, so that each fits in memory. Pass two takes a bucket at a
time, shuffles it (Fisher-Yates, seeded by the bucket) and writes it. Buckets
are uniform, so their shuffles one after the other are a shuffle of the whole.
The places from 0 to N - 1 are cut into shards whose counts differ by one row
at most.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwin.session import scratch_path

#: Bytes of a bucket on average. A pass-two task holds one, twice over.
BUCKET_BYTES = 8 << 20
MAX_PARTITIONS = 20_000
SEED = 20240607


def record_bytes(text_col: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 16."""
    return F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long") + 16


def _bucket(key: Column, seed: int, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(n)).cast("int")


def _shuffle_bucket(seed: int) -> Callable:
    def task(group: pa.Table) -> pa.Table:
        bucket, first = group["bucket"][0].as_py(), group["first"][0].as_py()
        # a stated order first: rows arrive in the order of the network
        order = np.argsort(group["key"].to_numpy(), kind="stable")
        np.random.default_rng([seed, bucket]).shuffle(order)
        return pa.table({"row": group["row"].take(pa.array(order)), "place": first + np.arange(len(order))})

    return task


def shuffle_to_shards(df: DataFrame, shards: int, seed: int = SEED, id_col: str = "doc_id",
                      text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0, gapless).

    The order depends on id, text, seed and number of rows alone. Null ids and
    texts are values like any other; rows equal in id and text are told apart
    by nothing, so any of them may take any of their places. A bucket that
    repeated rows overfill is scattered anew by row number. Columns of ``df``
    named shard or slot are replaced. An empty table gives no rows.
    """
    spark = df.sparkSession
    key = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    keyed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), key.alias("key"),
                      record_bytes(text_col).alias("size"))
    n_rows, total = keyed.agg(F.count("*"), F.sum("size")).first()
    n = max(-(-(total or 0) // bucket_bytes), 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = keyed.withColumn("bucket", _bucket(F.col("key"), seed + 1, n))
    loads = keyed.groupBy("bucket").agg(F.sum("size").alias("load"), F.count("*").alias("n"))
    over = loads.filter((F.col("load") > 8 * bucket_bytes) & (F.col("n") > 8)).select("bucket", F.lit(True).alias("over"))
    if not over.isEmpty():
        again = _bucket(F.monotonically_increasing_id(), seed + 2, n)
        keyed = (
            keyed.withColumn("again", again).join(over, "bucket", "left")
            .withColumn("bucket", F.when(F.col("over"), F.col("again")).otherwise(F.col("bucket")))
            .select("row", "key", "size", "bucket")
        )
        loads = keyed.groupBy("bucket").agg(F.count("*").alias("n"))
    firsts = loads.select("bucket", F.coalesce(F.sum("n").over(
        Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    schema = T.StructType([keyed.schema["row"], T.StructField("place", T.LongType())])
    # a partition for each bucket, as far as Spark's scheduler bears it
    dealt = keyed.select("bucket", "key", "row").repartition(min(n, MAX_PARTITIONS), "bucket")
    placed = (
        dealt.join(firsts, "bucket")
        .groupBy("bucket").applyInArrow(_shuffle_bucket(seed), schema)
    )
    return _cut(placed, n_rows, shards, df.columns)


def _cut(placed: DataFrame, n_rows: int, shards: int, columns: list[str]) -> DataFrame:
    """Places to shards: shard s has those from s * N / shards on, rounded down."""
    shard = F.expr(f"(place * {shards} + {shards - 1}) div {max(n_rows, 1)}").cast("int")
    # the largest s with floor(s * N / shards) <= place
    slot = F.col("place") - F.expr(f"shard * {n_rows}L div {shards}")
    return placed.withColumn("shard", shard).select("row", "shard", slot.alias("slot")).select(
        *[F.col("row").getField(c).alias(c) for c in columns if c.lower() not in ("shard", "slot")], "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard (``shard=N``), Parquet, rows of a file in slot order."""
    sharded.write.partitionBy("shard").parquet(path)


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 shards, written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = scratch_path(spark, "shards")
    write_shards(shuffle_to_shards(docs, 40), path)
    back = spark.read.parquet(path)
    return back.select(
        "doc_id", record_bytes().alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("shard").cast("int"), "slot", F.lit(None).cast("int").alias("grown_shard"))

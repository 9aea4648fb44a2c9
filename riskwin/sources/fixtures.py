"""Yield tables derived from the given parquet tables.

Every builder reads whole tables and returns a lazy DataFrame:

* ``wide_from_embeddings`` (Y1): one record per vector, the first
  ``n_assets`` coordinates as assets, contiguous ``ID``.
* ``wide_from_lineitem`` (Y2): one record per order key (gapped ``ID``),
  six per-order aggregates shifted to return-like ranges.
* ``long_from_events`` (Y3): one series per ``event_type``, ordered by
  ``event_id``.
* ``segment_prices`` (Y4): average order price per market segment and month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def asset_names(n: int) -> list[str]:
    return [f"asset_{i}" for i in range(1, n + 1)]


def wide_from_embeddings(spark: SparkSession, sf_dir: str, n_assets: int = 6) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        (F.col("vec_id") + 1).alias("ID"),
        *[F.col("embedding")[i].cast("double").alias(a)
          for i, a in enumerate(asset_names(n_assets))],
    )


# fixed values: the Y2 fixture definition (aggregate and shift per asset)
def wide_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("ID")).agg(
        (F.sum("l_quantity") / 1000 - 0.1).alias("asset_1"),
        (F.sum("l_extendedprice") / 1e7).alias("asset_2"),
        (F.avg("l_discount") - 0.05).alias("asset_3"),
        (F.avg("l_tax") - 0.04).alias("asset_4"),
        (F.min("l_discount") - 0.03).alias("asset_5"),
        (F.max("l_tax") - 0.06).alias("asset_6"),
    )


def long_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("series"),
        F.col("event_id").alias("ID"),
        F.col("value").alias("yield"),
    )


def segment_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return (
        orders.join(cust, orders.o_custkey == cust.c_custkey)
        .groupBy(
            F.col("c_mktsegment").alias("asset"),
            F.date_trunc("month", "o_orderdate").cast("date").alias("month"),
        )
        .agg(F.avg("o_totalprice").alias("price"))
    )

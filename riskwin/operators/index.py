"""Dense record index and halo blocks: ordered windows without one task.

``dense_index`` numbers records 0..N-1 in key order (per series when keys
are given), repeated keys included. Key values cut from a sketch split the
records into buckets of similar size; the cuts enter the plan as literals, so
the buckets are the same in every pass and need no checkpoint. A count per
bucket gives its offset; a row's index is the offset plus its place in the
bucket.

``halo_blocks`` cuts the index into blocks of ``B`` records and copies the
first ``W-1`` records of every block into the block before it, so a
forward frame of ``W`` rows partitioned by block sees exactly what a frame
over the whole ordered table sees. Overhead: ``(W-1)/B`` extra rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Records of a bucket at most, on average.
BUCKET_ROWS = 1_000_000
#: Records that are worth a bucket, and so a task, of their own.
LEAST_ROWS = 10_000
#: Accuracy of the cuts.
CUT_ACCURACY = 20_000


@dataclass
class Indexed:
    """``df`` with its index column, the number of its rows and the least and
    largest key (None without rows)."""

    df: DataFrame
    n_rows: int
    first_key: int | None = None
    last_key: int | None = None


def bucket_of(key: Column, cuts: Sequence) -> Column:
    """Number of ``cuts`` (ascending, distinct) that are not above the key, by
    bisection in the plan."""
    if not cuts:
        return F.lit(0)
    size = 1 << (len(cuts).bit_length() - 1)
    steps = [size >> i for i in range(size.bit_length())]
    table = F.array(*[F.lit(c) for c in cuts])
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when((at + step <= len(cuts)) & (F.get(table, at + step - 1) <= key), at + step).otherwise(at))


def ascending_cuts(df: DataFrame, key: Column, n: int) -> list:
    """Up to ``n`` distinct values of the key that split the rows evenly."""
    if n < 1:
        return []
    found = df.agg(F.percentile_approx(key, [i / (n + 1) for i in range(1, n + 1)], max(CUT_ACCURACY, 4 * n))).first()[0]
    return sorted(set(found or []))


def _tie_order(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """Records with the same key follow each other in the order of their other
    columns; those alike in all columns may follow in any order."""
    return [F.col(c) for c, kind in df.dtypes if c not in used and "map<" not in kind]


def dense_index(df: DataFrame, order_col: str = "ID", keys: Sequence[str] = (), idx_col: str = "idx",
                contiguous: bool = False, bucket_rows: int = BUCKET_ROWS, n_rows: int | None = None) -> Indexed:
    """Records numbered in the order of ``order_col``, then their other columns.

    ``contiguous``: the caller vouches that the keys are distinct and without
    gaps; the index is then the key less the smallest, without a shuffle."""
    keys, order = list(keys), F.col(order_col)
    lo, hi, n = df.agg(F.min(order), F.max(order), F.count(F.lit(1))).first()
    if contiguous and not keys:
        return Indexed(df.withColumn(idx_col, (order - F.lit(lo)).cast("long")), int(n), lo, hi)
    parallel = df.sparkSession.sparkContext.defaultParallelism
    n_buckets = max(min(parallel, n // LEAST_ROWS), math.ceil(n / bucket_rows))
    cuts = ascending_cuts(df, order, n_buckets - 1)
    placed = df.withColumn("_bucket", bucket_of(order, cuts))
    counts = placed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    in_bucket = Window.partitionBy(*keys, "_bucket").orderBy(order, *_tie_order(df, [*keys, order_col]))
    if keys:
        earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(
            *[F.col(k).alias(f"_{k}") for k in keys], F.col("_bucket").alias("_of"),
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
        same = F.col("_bucket") == F.col("_of")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        numbered = placed.withColumn("_place", F.row_number().over(in_bucket)).join(offsets, same)
        index = F.col("_before") + F.col("_place") - 1
    else:
        # one row a bucket; a single bucket has all rows
        per = {r["_bucket"]: r["_n"] for r in counts.collect()} if cuts else {0: n}
        before, total = [], 0
        for b in range(len(cuts) + 1):
            before.append(total)
            total += per.get(b, 0)
        numbered = placed.withColumn("_place", F.row_number().over(in_bucket))
        index = F.get(F.array(*[F.lit(x) for x in before]), F.col("_bucket")) + F.col("_place") - 1
    return Indexed(numbered.select(*df.columns, index.cast("long").alias(idx_col)), int(n), lo, hi)


def block_size(n_rows: int, window: int, block_rows: int, parallelism: int) -> int:
    """Records per halo block: at most ``block_rows``, small enough that every
    core gets several blocks, and at least ``16*W`` so the halo stays a few
    percent of the data."""
    per_task = math.ceil(max(n_rows, 1) / (4 * max(parallelism, 1)))
    return max(window - 1, 1, min(block_rows, max(per_task, 16 * window)))


def halo_blocks(indexed: DataFrame, window: int, block_rows: int, idx_col: str = "idx") -> DataFrame:
    """Adds ``blk`` (the block a copy belongs to) and ``own`` (the copy in the
    record's own block). One scan: halo copies come from ``explode``."""
    if block_rows < window - 1:
        raise ValueError("block_rows must be >= window - 1")
    own_blk = F.floor(F.col(idx_col) / F.lit(block_rows)).cast("long")
    is_halo = (F.col(idx_col) % F.lit(block_rows) < F.lit(window - 1)) & (own_blk > 0)
    blks = F.when(is_halo, F.array(own_blk, own_blk - 1)).otherwise(F.array(own_blk))
    return indexed.select("*", F.explode(blks).alias("blk")).withColumn("own", F.col("blk") == own_blk)

"""Exact order statistics over (target, x) without sorting everything.

Two passes over the values, for any number of targets and values:

1. a grouped sketch (``percentile_approx``) brackets the wanted ranks of every
   target by values a little below and above them;
2. the brackets are looked up where the values are (``lookup.attach``: values are
   not dealt by target), and one aggregation counts, in the tasks first, the
   values between brackets and, inside them, every distinct value;
3. running counts over these cells place every rank.

Brackets and cells, both small, are checkpointed; nothing about a target is in the
plan. The running counts go bucket by bucket through each bracket, so a task
holds a small part of the candidates of a target only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskwin.operators.lookup import attach
from riskwin.session import checkpoint_root

#: Buckets that a bracket's values are cut into for the running counts.
BUCKETS = 64


def history_cells(values: DataFrame, shares: tuple[float, ...], accuracy: int = 20_000) -> DataFrame:
    """Cells of ``values`` (target, x; no NULL or NaN in x), in the order of x:

    (target, n, mean, v, c, sx, sd, upto). A cell is a distinct value ``v``
    near one of the ``shares`` of the target's values, or (``v`` NULL) all
    values between two of these regions. ``c`` counts its values, ``sx`` sums
    them, ``sd`` sums their distances from the mean, ``upto`` counts the values
    up to and with the cell; ``n`` and ``mean`` are the target's. A target may be NULL.
    """
    checkpoint_root(values.sparkSession)
    margin = 4.0 / accuracy
    at = [p for s in sorted(shares) for p in (max(0.0, s - margin), min(1.0, s + margin))]
    heads = values.groupBy("target").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.percentile_approx("x", at, accuracy).alias("q"))
    # with few values the margin is under a rank: all of them are candidates
    few = F.col("n") * margin < 4
    ends = [F.when(few, F.lit(float("-inf") if i % 2 == 0 else float("inf"))).otherwise(F.get("q", i)).alias(f"q{i}")
            for i in range(len(at))]
    heads = heads.select(F.col("target").alias("of"), "n", "mean", *ends).checkpoint()
    x = F.col("x")
    zone, bucket = F.lit(len(at)), F.lit(0)
    for i in reversed(range(0, len(at), 2)):
        lo, hi = F.col(f"q{i}"), F.col(f"q{i + 1}")
        inside = F.when(hi - lo < F.lit(float("inf")), F.least(
            F.floor(F.try_divide(x - lo, hi - lo) * BUCKETS), F.lit(BUCKETS - 1))).otherwise(F.lit(0))
        zone = F.when(x < lo, i).when(x <= hi, i + 1).otherwise(zone)
        bucket = F.when(x < lo, 0).when(x <= hi, F.coalesce(inside, F.lit(0))).otherwise(bucket)
    placed = attach(values, heads, "target", "of", "n").select(
        "target", "n", "mean", "x", zone.alias("zone"), bucket.cast("int").alias("bucket"))
    cells = placed.groupBy("target", "n", "mean", "zone", "bucket", F.when(F.col("zone") % 2 == 1, x).alias("v")).agg(
        F.count(F.lit(1)).alias("c"), F.sum("x").alias("sx"), F.sum(F.abs(x - F.col("mean"))).alias("sd"))
    return _running(cells.checkpoint())


def _running(cells: DataFrame) -> DataFrame:
    parts = cells.groupBy("target", "zone", "bucket").agg(F.sum("c").alias("part"))
    earlier = Window.partitionBy("target").orderBy("zone", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(F.col("target").alias("of"), F.col("zone").alias("of_zone"), F.col("bucket").alias("of_bucket"),
                          F.coalesce(F.sum("part").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("target", "zone", "bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    same = (F.col("target").eqNullSafe(F.col("of")) & (F.col("zone") == F.col("of_zone"))
            & (F.col("bucket") == F.col("of_bucket")))
    return cells.withColumn("own", F.sum("c").over(within)).join(before, same).select(
        "target", "n", "mean", "v", "c", "sx", "sd", (F.col("before") + F.col("own")).alias("upto"))


def value_at(rank: Column) -> Column:
    """Aggregate over a target's cells: the value at a 1-based rank (NULL for
    rank 0). Fails if the rank is outside the candidates, which the sketch's
    error bound rules out."""
    hit = (F.col("upto") - F.col("c") < rank) & (rank <= F.col("upto"))
    found = F.max(F.when(hit, F.col("v")))
    lost = F.max(hit & F.col("v").isNull())
    return F.when(lost, F.raise_error(F.lit("a rank lies outside its bracket")).cast("double")).otherwise(found)


def k_smallest(long: DataFrame, k: int, target_col: str = "target", value_col: str = "x",
               tie_cols: tuple[str, ...] = ()) -> DataFrame:
    """The ``k`` smallest values per target with their rank (a top-k report).

    ``row_number <= k`` lets Spark insert a per-partition group limit before
    the shuffle, so only ``k`` rows per target and map task move."""
    w = Window.partitionBy(target_col).orderBy(F.col(value_col), *[F.col(c) for c in tie_cols])
    return long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

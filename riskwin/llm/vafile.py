"""Exact top-k by inner product with vector-approximation files.

The approximation file holds a packed row a vector: six bits a component (the
number of its cell, ``2 ** shift`` values wide) and the vector's shift. The cell's
middle gives a score to within half a cell times the sum of the query's absolute
components.

1. The cells, not the vectors, meet the queries, block by block. A block passes on
   the vectors whose upper bound reaches the block's k-th best lower bound; of
   these, the query's k-th best lower bound over all blocks leaves the survivors.
2. Exact vectors are joined to survivors in the order of their upper bounds: first
   to ``FIRST`` times k a query, then to those whose upper bound reaches the k-th
   exact score of the first; no other vector can be among the k best.

Of the copies of one vector only those of the k + 1 smallest ids can be among any
query's k best, so the others are left out before the file is made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskwin.session import checkpoint_root

#: Rows of a block of queries and of vectors.
QUERY_BLOCK = 8_192
VECTOR_BLOCK = 16_384
#: Bits of a cell's number.
CELL_BITS = 6
#: Bounds held at once in a task.
TILE = 1 << 21
#: Survivors of a query read in the first round, in multiples of k.
FIRST = 2
#: Keys of survivors up to this number (16 bytes each) are broadcast to find their
#: vectors; more are joined.
BROADCAST_KEYS = 1_000_000
_MOST = float(1 << 63)


def usable(vector: Column) -> Column:
    """Not null, and all components finite."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                                                    & (F.abs(x) != F.lit(float("inf")))), F.lit(False))


def pack(codes: np.ndarray) -> np.ndarray:
    """Rows of numbers below 64 as rows of bytes, four numbers in three."""
    n, dim = codes.shape
    wide = np.zeros((n, -(-dim // 4) * 4), np.uint32)
    wide[:, :dim] = codes
    a, b, c, d = (wide[:, i::4] for i in range(4))
    word = a | b << 6 | c << 12 | d << 18
    return np.stack([word & 255, word >> 8 & 255, word >> 16], axis=2).astype(np.uint8).reshape(n, -1)


def unpack(packed: np.ndarray, dim: int) -> np.ndarray:
    n = len(packed)
    word = packed.reshape(n, -1, 3).astype(np.uint32) @ np.array([1, 1 << 8, 1 << 16], np.uint32)
    return np.stack([word >> 6 * i & 63 for i in range(4)], axis=2).reshape(n, -1)[:, :dim]


def approximate(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shift, packed cells) of each row of longs."""
    reach = np.where(vectors < 0, ~vectors, vectors).max(axis=1, initial=0)
    bits = np.frexp(reach.astype(float))[1]
    shift = np.maximum(0, bits + 1 - CELL_BITS).astype(np.int64)
    return shift, pack((vectors >> shift[:, None]) + (1 << CELL_BITS - 1))


def block_bounds(queries: np.ndarray, query_ids: np.ndarray, shift: np.ndarray, packed: np.ndarray, ids: np.ndarray,
                 k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, lower, upper) of the vectors of other ids whose
    upper bound reaches the query's k-th best lower bound in the block. Bounds
    beyond a long are held at its ends."""
    dim = queries.shape[1]
    half = (2.0 ** shift - 1) / 2
    middle = (unpack(packed, dim).astype(float) - 32) * (2.0 ** shift)[:, None] + half[:, None]
    most = max(int(queries.max(initial=0)), -int(queries.min(initial=0)))
    wide = (32 << int(shift.max(initial=0))) * most * max(1, dim)
    # sums of halves are exact in float32 up to 2 ** 22, in float64 up to 2 ** 51
    kind, margin = (np.float32, 0.0) if wide < 1 << 22 else (np.float64, wide * 2.0 ** -40 if wide >= 1 << 51 else 0.0)
    middle_t = np.ascontiguousarray(middle.astype(kind).T)
    order = np.argsort(ids, kind="stable")
    in_order, out = ids[order], []
    step = max(1, TILE // max(1, len(ids)))
    for a in range(0, len(queries), step):
        part = queries[a:a + step]
        slack = np.abs(part.astype(float)).sum(axis=1)[:, None] * half + margin
        middle_score = part.astype(kind) @ middle_t
        lower, upper = (np.clip(middle_score + s, -_MOST, _MOST) for s in (-slack, slack))
        own = query_ids[a:a + step]
        for i, (x, y) in enumerate(zip(np.searchsorted(in_order, own, "left"), np.searchsorted(in_order, own, "right"))):
            lower[i, order[x:y]] = upper[i, order[x:y]] = -np.inf
        kth = np.partition(lower, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(part), -np.inf)
        q, v = np.nonzero((upper >= kth[:, None]) & (upper > -np.inf))
        out.append((q + a, v, lower[q, v], upper[q, v]))
    if not out:
        return np.array([], int), np.array([], int), np.array([]), np.array([])
    return tuple(np.concatenate(x) for x in zip(*out))


def exact_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner product of each row of one with that of the other, held at the ends
    of a long."""
    most = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (queries, vectors)]
    if most[0] * most[1] * max(1, queries.shape[1]) < 1 << 63:
        return np.einsum("ij,ij->i", queries, vectors)
    sums = [sum(a * b for a, b in zip(q, v)) for q, v in zip(queries.tolist(), vectors.tolist())]
    return np.array([max(-(1 << 63), min((1 << 63) - 1, s)) for s in sums], dtype=np.int64)


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(np.int64)


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Parts of batches whose vectors are of one length (column ``dim``)."""
    for b in batches:
        dims = b.column("dim").to_numpy()
        for dim in np.unique(dims):
            yield b.filter(pa.array(dims == dim)), int(dim)


def approximation_file(rows: DataFrame) -> DataFrame:
    """(dim, id, row, shift, cells) of rows (dim, id, row, v)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, _ in _by_length(batches):
            shift, packed = approximate(_matrix(b.column("v")))
            yield pa.RecordBatch.from_arrays(
                [b.column("dim"), b.column("id"), b.column("row"), pa.array(shift, pa.int64()),
                 pa.array([p.tobytes() for p in packed], pa.binary())], ["dim", "id", "row", "shift", "cells"])

    return rows.select("dim", "id", "row", "v").mapInArrow(task, "dim int, id long, row long, shift long, cells binary")


BOUNDS = "query_id long, query_row long, id long, row long, lower double, upper double"


def _compare(k: int) -> Callable:
    def task(queries: pa.Table, cells: pa.Table) -> pa.Table:
        names = [x.split()[0] for x in BOUNDS.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.float64()] * 2
        if not len(queries) or not len(cells):
            return pa.table([pa.array([], t) for t in kinds], names=names)
        packed = np.frombuffer(b"".join(cells["cells"].to_pylist()), np.uint8).reshape(len(cells), -1)
        q_ids, q_rows, ids, rows = (t.to_numpy() for t in (queries["id"], queries["row"], cells["id"], cells["row"]))
        q, v, lower, upper = block_bounds(_matrix(queries["v"].combine_chunks()), q_ids, cells["shift"].to_numpy(), packed, ids, k)
        columns = (q_ids[q], q_rows[q], ids[v], rows[v], lower, upper)
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return task


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b, _ in _by_length(batches):
        score = exact_scores(_matrix(b.column("q")), _matrix(b.column("v")))
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("query_id", "query_row", "id")), pa.array(score, pa.int64())],
                                         ["query_id", "query_row", "id", "score"])


QUERY = ["query_id", "query_row"]


def survivors(queries: DataFrame, cells: DataFrame, k: int, query_block: int, vector_block: int) -> DataFrame:
    """(query_id, query_row, id, row, upper, place) of the vectors that the bounds
    of all blocks leave to a query; ``place`` is theirs in the order of upper bounds."""
    parallel = cells.sparkSession.sparkContext.defaultParallelism
    n_v = max(-(-cells.count() // vector_block), parallel, 1)
    n_q = max(-(-queries.count() // query_block), 1)
    left = queries.select("dim", "id", "row", "v", F.pmod("row", F.lit(n_q)).cast("int").alias("q_block"),
                          F.explode(F.sequence(F.lit(0), F.lit(n_v - 1))).alias("v_block"))
    number = F.pmod(F.xxhash64("row", F.monotonically_increasing_id()), F.lit(n_v)).cast("int")
    right = cells.select("*", number.alias("v_block"), F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("q_block"))
    own = ["dim", "q_block", "v_block"]
    near = left.groupBy(*own).cogroup(right.groupBy(*own)).applyInArrow(_compare(k), BOUNDS).checkpoint()
    best = Window.partitionBy(*QUERY).orderBy(F.desc("lower"))
    least = near.select(*QUERY, "lower").withColumn("_at", F.row_number().over(best)).where(F.col("_at") <= k).groupBy(*QUERY).agg(
        F.when(F.count(F.lit(1)) >= k, F.min("lower")).otherwise(F.lit(float("-inf"))).alias("least"))
    left_over = near.join(least, QUERY).where(F.col("upper") >= F.col("least"))
    place = F.row_number().over(Window.partitionBy(*QUERY).orderBy(F.desc("upper"), "id", "row"))
    # copies of a row come back with the row
    return left_over.select(*QUERY, "id", "row", "upper").dropDuplicates([*QUERY, "id", "row"]).withColumn("place", place).checkpoint()


def read_exactly(pairs: DataFrame, queries: DataFrame, rows: DataFrame) -> DataFrame:
    """(query_id, query_row, id, score) of pairs (query_id, query_row, id, row)."""
    keys = pairs.select("id", "row").distinct()
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    wanted = rows.select("dim", "id", "row", "v").join(F.broadcast(keys) if few else keys, ["id", "row"], "left_semi")
    own = queries.select(F.col("id").alias("query_id"), F.col("row").alias("query_row"), F.col("v").alias("q"))
    return pairs.select(*QUERY, "id", "row").join(wanted, ["id", "row"]).join(own, QUERY).select(
        "dim", *QUERY, "id", "q", "v").mapInArrow(_score, "query_id long, query_row long, id long, score long")


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "vector",
               query_block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` highest inner products of
    each row where ``is_query`` holds with all rows of other ids.

    ``vector_col``: array of longs. Null ids, null vectors and vectors with a null
    component take no part, and only vectors of the query's length are compared
    with it. A repeated row counts as often as it is there; a query id with several
    different vectors gets the ranks of each. Scores beyond a long are held at its
    ends. Ties go to the smaller id. Empty tables give no rows.
    """
    checkpoint_root(vectors.sparkSession)
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<long>").alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("is_query")).filter(
        "id is not null and v is not null and size(v) > 0 and forall(v, x -> x is not null)")
    rows = rows.withColumn("dim", F.size("v")).withColumn("row", F.xxhash64("id", "v"))
    queries = rows.filter("is_query").select("dim", "id", "row", "v").dropDuplicates(["id", "row"]).checkpoint()
    copies = Window.partitionBy(F.xxhash64("v"), "v").orderBy("id")
    rows = rows.select("dim", "id", "row", "v").withColumn("_copy", F.dense_rank().over(copies)).where(
        F.col("_copy") <= k + 1).drop("_copy").checkpoint()
    cells = approximation_file(rows).checkpoint()
    left = survivors(queries, cells, k, query_block, vector_block)
    first = read_exactly(left.where(F.col("place") <= FIRST * k), queries, rows).checkpoint()
    ranked = F.row_number().over(Window.partitionBy(*QUERY).orderBy(F.desc("score"), "id"))
    kth = first.withColumn("rank", ranked).where(F.col("rank") <= k).groupBy(*QUERY).agg(F.min("score").alias("kth"))
    rest = left.where(F.col("place") > FIRST * k).join(kth, QUERY).where(F.col("upper") >= F.col("kth").cast("double"))
    scores = first.unionByName(read_exactly(rest, queries, rows))
    return scores.withColumn("rank", ranked).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score")


def op5_topk(spark, sf_dir: str) -> DataFrame:
    """The 20 best partners of every 20th vector, components as floor(64 * x)."""
    raw = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    vector = F.transform("embedding", lambda x: F.floor(F.lit(64.0) * x.cast("double")))
    rows = raw.filter(usable(F.col("embedding"))).select("vec_id", vector.alias("vector"))
    return exact_topk(rows, F.col("vec_id") % 20 == 0)


TOPK_SQL = """WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""

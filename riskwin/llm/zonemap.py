"""Centroid clustering of integer vectors over Hilbert-ordered zone maps.

The vectors are put in the order of a Hilbert curve through all dimensions and
cut into blocks; a block keeps its vectors and the least and largest value of
every component (its box). A round then needs only the boxes to rule out
centroids: one whose least squared distance from the box is above the smallest
of all centroids' largest squared distances from it is nearest to none of the
block's vectors. The others are the block's candidates and are compared exactly,
all vectors of the block at once.

The blocks are written once, and every round reads them in one stage: tasks send
a count and component sums for each centroid, Spark adds them up, and the driver
gets the ``k`` new centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwin.llm.vafile import usable
from riskwin.session import checkpoint_root

#: Vectors of a block.
BLOCK = 256
#: Bits of a component on the curve.
CURVE_BITS = 4
#: Sums of squares below this are exact in double precision.
_EXACT = 1 << 22
_LONG = (1 << 63) - 1
_BLOCKS = "ids array<long>, width int, dim int, data binary"


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place on the Hilbert curve of points (rows) of unsigned coordinates below
    ``2 ** bits``, as bytes that sort like the place."""
    x = cells.astype(np.uint32).copy()
    n = x.shape[1]
    for level in range(bits - 1, 0, -1):
        side, below = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(n):
            flip = (x[:, i] & side) != 0
            swap = np.where(flip, np.uint32(0), (x[:, 0] ^ x[:, i]) & below)
            x[:, 0] ^= np.where(flip, below, swap)
            x[:, i] ^= swap
    x = np.bitwise_xor.accumulate(x, axis=1)
    turn = np.zeros(len(x), np.uint32)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, -1] & np.uint32(1 << level), np.uint32((1 << level) - 1), np.uint32(0))
    x ^= turn[:, None]
    planes = (x[:, None, :] >> np.arange(bits - 1, -1, -1, dtype=np.uint32)[None, :, None]) & np.uint32(1)
    packed = np.packbits(planes.reshape(len(x), -1).astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1).astype(np.int64)


def hilbert_blocks(rows: DataFrame, block: int = BLOCK, bits: int = CURVE_BITS) -> DataFrame:
    """Zone-mapped blocks of ``rows`` (id long, v array<long> of one length), in
    the order of the curve. Equal vectors are told apart by a hash of the row,
    so that a vector with very many copies fills several partitions."""
    checkpoint_root(rows.sparkSession)
    lo, hi = rows.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    wide = 1.0 if lo is None else float(hi) - float(lo) + 1.0

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                v = _matrix(b.column(1), len(b)).astype(float)
                cells = np.clip(np.floor((v - float(lo)) / wide * (1 << bits)), 0, (1 << bits) - 1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(hilbert_keys(cells, bits), pa.binary())], ["id", "v", "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_ids: list = []
        held = None

        def out(ids: list, v: np.ndarray) -> pa.RecordBatch:
            reach = int(max(-int(v.min()), int(v.max())))
            width = next(w for w in (1, 2, 4, 8) if w == 8 or reach < 1 << (8 * w - 1))
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([width], pa.int32()), pa.array([v.shape[1]], pa.int32()),
                 pa.array([v.astype(f"<i{width}").tobytes()], pa.binary())], ["ids", "width", "dim", "data"])

        for b in batches:
            if not len(b):
                continue
            v = _matrix(b.column(1), len(b))
            held = v if held is None else np.concatenate([held, v])
            held_ids += b.column(0).to_pylist()
            while len(held_ids) >= block:
                yield out(held_ids[:block], held[:block])
                held_ids, held = held_ids[block:], held[block:]
        if held_ids:
            yield out(held_ids, held)

    keyed = rows.select("id", "v").mapInArrow(key, "id long, v array<long>, place binary")
    keyed = keyed.withColumn("apart", F.xxhash64("id", F.monotonically_increasing_id()))
    ordered = keyed.repartitionByRange("place", "apart").sortWithinPartitions("place", "apart")
    return ordered.select("id", "v").mapInArrow(cut, _BLOCKS).checkpoint()


def _read(ids: pa.Array, width: int, dim: int, data: bytes) -> tuple[list, np.ndarray]:
    return ids.as_py(), np.frombuffer(data, f"<i{width}").reshape(-1, dim).astype(np.int64)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Centroids that may be nearest to a point of the box ``low`` to ``high``
    (ties included), by distance bounds."""
    c = centroids.astype(float)
    lo, hi = low.astype(float), high.astype(float)
    gap = np.maximum(np.maximum(lo - c, c - hi), 0.0)
    reach = np.maximum(np.abs(c - lo), np.abs(hi - c))
    least, most = (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)
    # bounds are exact for small values; for others allow for rounding
    return np.flatnonzero(least * (1 - 1e-9) <= most.min() * (1 + 1e-9))


def nearest(vectors: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, list, int]:
    """For a block: (number of the nearest centroid, ties to the smaller; squared
    distances; centroids compared)."""
    reach = max([abs(x) for c in centroids for x in c] + [int(np.abs(vectors.astype(float)).max(initial=0))])
    table = np.array(centroids, dtype=object)
    near = candidates(vectors.min(axis=0), vectors.max(axis=0), table)
    if reach < _EXACT and vectors.shape[1] <= 64:
        v, c = vectors.astype(float), table[near].astype(float)
        distance = (v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)[None, :]
        best = np.argmin(distance, axis=1)
        return near[best], distance[np.arange(len(v)), best].astype(np.int64).tolist(), len(near)
    v = vectors.astype(object)
    distance = np.stack([((v - table[i]) ** 2).sum(axis=1) for i in near], axis=1)
    best = [min(range(len(near)), key=lambda j: (row[j], j)) for row in distance]
    return near[best], [row[j] for row, j in zip(distance, best)], len(near)


def _sums(blocks: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Count and component sums of the vectors nearest to each centroid."""
    k, dim = len(centroids), len(centroids[0])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [0] * k
        total = [np.zeros(dim, dtype=object) for _ in range(k)]
        for b in batches:
            for row in zip(*(b.column(i) for i in range(4))):
                _, v = _read(row[0], *(x.as_py() for x in row[1:]))
                own, _, _ = nearest(v, centroids)
                small = np.abs(v.astype(float)).max(initial=0) < 1 << 50
                for c in np.unique(own):
                    mine = v[own == c]
                    count[c] += len(mine)
                    total[c] += mine.sum(axis=0).astype(object) if small else mine.astype(object).sum(axis=0)
        used = [c for c in range(k) if count[c]]
        if used:
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array([count[c] for c in used], pa.int64()),
                 pa.array([[str(x) for x in total[c]] for c in used], pa.list_(pa.string()))], ["cluster", "n", "sums"])

    parts = blocks.mapInArrow(task, "cluster int, n long, sums array<string>")
    found = parts.select("cluster", "n", F.posexplode("sums").alias("pos", "x")).groupBy("cluster", "pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("total")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(found, key=lambda r: (r["cluster"], r["pos"])):
        out.setdefault(r["cluster"], (r["n"], []))[1].append(int(r["total"]))
    return out


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, id_col: str = "vec_id", vector_col: str = "vector",
            seed: str = "1:", block: int = BLOCK) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every
    vector of ``vector_col`` (array<long>, all of one length, no nulls).

    The first centroids are the ``k`` vectors with the smallest SHA-256 of
    ``seed`` and the id; each round assigns every vector to the nearest centroid
    (squared Euclidean distance, ties to the smaller number) and replaces it by
    the floor of its vectors' mean. A centroid without vectors stays. With fewer
    than ``k`` vectors there are as many centroids. A null id comes last among
    the seeds; repeated rows count and come back as often as they are there;
    distances and sums beyond a long are held at its end. An empty table gives
    no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("v"))
    out = T.StructType([T.StructField("id", T.LongType()), T.StructField("cluster", T.IntegerType()),
                        T.StructField("distance", T.LongType())])
    rank = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    seeds = [list(r["v"]) for r in rows.orderBy(rank.asc_nulls_last(), "v").limit(k).collect()]
    if not seeds:
        none = spark.createDataFrame([], out)
        return none.select("*", F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"),
                           F.lit("").alias("centroid_sha256"))
    blocks, centroids = hilbert_blocks(rows, block), seeds
    for _ in range(rounds):
        found = _sums(blocks, centroids)
        centroids = [[t // found[c][0] for t in found[c][1]] if c in found else old for c, old in enumerate(centroids)]
    final = centroids

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*(b.column(i) for i in range(4))):
                ids, v = _read(row[0], *(x.as_py() for x in row[1:]))
                own, distance, _ = nearest(v, final)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(own.astype(np.int32)),
                     pa.array([min(d, _LONG) for d in distance], pa.int64())], ["id", "cluster", "distance"])

    assigned = blocks.mapInArrow(assign, out).checkpoint()
    held = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    every = min(sum(held.values()), _LONG)
    of_cluster = [(c, min(s, _LONG), every, hashlib.sha256(",".join(map(str, final[c])).encode()).hexdigest())
                  for c, s in sorted(held.items())]
    facts = spark.createDataFrame(of_cluster, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(  # at most k rows
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def whole_vectors(raw: DataFrame, dim: int = 64) -> DataFrame:
    """(vec_id, vector) of the vectors with ``dim`` components, none null or not
    finite, as floor(64 * x); beyond a long, the end of its range."""
    kept: Column = usable(F.col("embedding")) & (F.size("embedding") == dim)
    return raw.filter(kept).select("vec_id", F.transform(
        "embedding", lambda x: F.floor(F.lit(64.0) * x.cast("double"))).alias("vector"))


def op13_clusters(spark, sf_dir: str) -> DataFrame:
    """Cluster and distance of every vector: 16 centroids, 3 rounds."""
    rows = whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return cluster(rows).withColumnRenamed("id", "vec_id")


def clusters_sql(k: int = 16, rounds: int = 3, dim: int = 64) -> str:
    """DuckDB SQL of the query: one assignment and one update a round."""
    parts = [f"""WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
long AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM kept),
seeds AS (SELECT vec_id, CAST(row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR))) - 1 AS INTEGER) AS cluster
  FROM kept QUALIFY cluster < {k}),
c0 AS (SELECT cluster, pos, x AS c FROM seeds JOIN long USING (vec_id))"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS (SELECT vec_id, cluster, d FROM (
  SELECT vec_id, cluster, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM long JOIN c{i} USING (pos) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1)""")
        if i < rounds:
            parts.append(f"""u{i} AS (SELECT cluster, pos, sum(x) AS s, count(*) AS n FROM a{i} JOIN long USING (vec_id) GROUP BY ALL),
c{i + 1} AS (SELECT cluster, pos, CASE WHEN n IS NULL THEN c ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS c
  FROM c{i} LEFT JOIN u{i} USING (cluster, pos))""")
    parts.append(f"h AS (SELECT cluster, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY pos)) AS sha FROM c{rounds} GROUP BY cluster)")
    return ",\n".join(parts) + f"""
SELECT vec_id, cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha AS centroid_sha256 FROM a{rounds} JOIN h USING (cluster)"""

"""Centroid clustering against brute force and SQL."""
import hashlib
from itertools import product

import numpy as np
import pytest
from compare import compare, duck
from conftest import SF_MID

from riskwin.llm import zonemap as Z


def brute(rows, k, rounds):
    """rows: (id, vector of ints). List of (id, cluster, distance), centroids."""
    def rank(r):
        return (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])

    centroids = [list(v) for _, v in sorted(rows, key=rank)[:k]]

    def assign():
        out = []
        for i, v in rows:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((i, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (_, o, _) in zip(rows, own) if o == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return assign(), centroids


def check(spark, rows, k, rounds, **more):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, vector array<long>, id string, cluster int")
    got = Z.cluster(df, k, rounds, **more).collect()
    want, centroids = brute(rows, k, rounds)
    key = lambda t: (t[0] is None, t[0] or 0, *t[1:])
    top = (1 << 63) - 1
    assert sorted(((r["id"], r["cluster"], r["distance"]) for r in got), key=key) == sorted(
        ((i, c, min(d, top)) for i, c, d in want), key=key)
    for r in got:
        assert r["cluster_inertia"] == min(top, sum(min(d, top) for _, c, d in want if c == r["cluster"]))
        assert r["inertia"] == min(top, sum(min(d, top) for _, _, d in want))
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()


def test_curve_visits_every_point_by_unit_steps():
    for n, bits in ((2, 3), (3, 2), (5, 2)):
        points = np.array(list(product(range(1 << bits), repeat=n)), np.uint32)
        keys = Z.hilbert_keys(points, bits)
        assert len(set(keys)) == len(points)
        walk = points[sorted(range(len(points)), key=keys.__getitem__)].astype(int)
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("scale", [1, 30, 1 << 21, 1 << 40])
def test_boxes_lose_no_nearest_centroid(scale):
    rng = np.random.default_rng(scale % 97)
    centroids = rng.integers(-scale, scale + 1, (16, 6)).tolist()
    for spread in (1, 3, 50):
        v = rng.integers(-scale, scale + 1, 6) // 2 + rng.integers(-(scale // spread) - 1, scale // spread + 2, (40, 6))
        own, distance, _ = Z.nearest(v, centroids)
        want = [min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centroids)) for x in v.tolist()]
        assert list(zip(distance, own)) == want


def test_boxes_rule_centroids_out():
    low, high = np.array([0, 0]), np.array([3, 3])
    far = np.array([[1, 1], [100, 100], [2, 2], [-50, 0]], dtype=object)
    assert Z.candidates(low, high, far).tolist() == [0, 2]


def test_rounds_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(0, 5) * 20 + rng.integers(-6, 7, 4)).tolist()) for i in range(300)]
    check(spark, rows, 7, 3, block=16)
    check(spark, rows, 1, 2, block=1000)


def test_awkward_rows(spark):
    copies = [(i, [5, 5]) for i in range(60)] + [(200, [1, 2])] * 3  # many copies, repeated rows
    check(spark, [*copies, (None, [9, -9]), (None, [0, 0]), (300, [-7, 1])], 5, 3, block=8)
    check(spark, [(1, [3, 3]), (2, [-4, 3])], 16, 3)  # fewer vectors than centroids
    big = 1 << 62
    check(spark, [(1, [big, -big]), (2, [-big, big]), (3, [big - 1, 1]), (4, [0, 0])], 2, 2)
    none = spark.createDataFrame([], "vec_id long, vector array<long>")
    assert Z.cluster(none).collect() == []


def test_what_is_kept(spark):
    nan, inf = float("nan"), float("inf")
    raw = [(1, [0.5, -0.01]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0]), (7, []), (None, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "x") for r in raw], "vec_id long, embedding array<float>, vector string")
    assert {(r["vec_id"], *r["vector"]) for r in Z.whole_vectors(df, 2).collect()} == {(1, 32, -1), (None, 64, 128)}


def test_sql(spark):
    r = compare(Z.op13_clusters(spark, SF_MID), duck(SF_MID), Z.clusters_sql())
    assert r["cols"] and r["rows"][0] == r["rows"][1] and r["hash"]

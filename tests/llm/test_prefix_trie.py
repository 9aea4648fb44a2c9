"""The prefix trie against brute force and SQL."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from compare import compare, duck
from conftest import SF_SMALL

from riskwin.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """rows: (conv, turn, role, text). The eight columns of every node, sorted."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts, key=lambda t: t[0])] for c, ts in own.items()}
    members, ends = {}, {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = own.get(c - (abs(c) % 5) * (1 if c >= 0 else -1), [])
        seq = tuple(base[:h] + mine[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    leaves, saved, children = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, cs in members.items():
        gain = (len(cs) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += gain
    return sorted((min(cs), len(n), min(members[n[:-1]]) if n else -1, len(cs), children[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest()) for n, cs in members.items())


def trie(spark, rows, limit=P.LIMIT, block_bits=16):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", conv long, digest string")
    got = P.prefix_trie(*P.rebuilt(P.ordered_turns(df)), limit, block_bits)
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], *r[3:]) for r in got.collect())


def random_rows(seed, convs, words=3, longest=9):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "bot"]), "é" * rng.randrange(words)) for c in range(convs) for t in range(rng.randrange(1, longest))]


@pytest.mark.parametrize("shape", ["chain", "star", "random", "comb"])
def test_decomposition_of_a_forest(shape):
    rng = np.random.default_rng(5)
    n = 3000
    parent = {"chain": np.arange(n) - 1, "star": np.zeros(n, int), "random": np.array([rng.integers(0, max(1, i)) for i in range(n)]),
              "comb": np.array([i - 1 if i % 2 else max(0, i - 2) for i in range(n)])}[shape].astype(np.int64)
    parent[0] = -1
    parent[n // 2:][parent[n // 2:] < n // 2] = -1  # a second component (or many tops)
    own = rng.integers(0, 50, (n, 2))
    extra = rng.integers(1, 4, n)
    weight, want = extra.copy(), own.copy()
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            weight[parent[i]] += weight[i]
            want[parent[i]] += want[i]
    assert (P.decompose(parent, weight, own) == want).all()
    order = rng.permutation(n)
    place = np.argsort(order)
    shuffled = np.where(parent[order] < 0, -1, place[parent[order]])
    assert (P.decompose(shuffled, weight[order], own[order]) == want[order]).all()


def test_random_conversations(spark):
    rows = random_rows(1, 150)
    want = brute(rows)
    assert trie(spark, rows) == want
    assert trie(spark, rows, limit=7, block_bits=2) == want  # split by joins, chunks of lists


def test_long_and_hot_conversations(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 16)
    monkeypatch.setattr(P, "HOT_CHILDREN", 5)
    rows = [(0, t, "user", f"turn {t % 7}") for t in range(300)]  # one conversation with half of all rows
    rows += [(c, t, "user", f"turn {t % 7}") for c in range(1, 40) for t in range(c % 12 + 1)]  # its beginnings, many copies
    rows += [(c, 0, "user", f"first {c}") for c in range(100, 130)]
    want = brute(rows)
    assert trie(spark, rows, limit=10, block_bits=3) == want
    assert trie(spark, rows) == want


def test_awkward_rows(spark):
    rows = [(7, None, "user", "b"), (7, 3, None, None), (7, 0, "user", ""), (None, 1, "user", "x"), (5, 0, "a", "bc"), (6, 0, "ab", "c"),
            (8, 0, "user", "z" * 200_000), (9, 0, "user", "z" * 200_000), (-3, 1, "user", "n"), (-5, 1, "user", "m"), (11, 2, "r", "t")]
    assert trie(spark, rows) == brute(rows)
    # rows of the same turn have an order of their own, whatever the order they come in; repeated rows all count
    same = [(1, 0, "u", "b"), (1, 0, "u", "a"), (1, 0, "u", "a"), (2, 0, "u", "c")]
    assert trie(spark, same) == trie(spark, same[::-1]) and len(trie(spark, same)) >= 2
    assert trie(spark, []) == []


def test_sql(spark):
    r = compare(P.op11_prefix_trie(spark, SF_SMALL), duck(SF_SMALL), P.TRIE_SQL)
    assert r["cols"] and r["rows"][0] == r["rows"][1] and r["hash"]

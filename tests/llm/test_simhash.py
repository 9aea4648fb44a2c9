"""SimHash near-dedup against an all-pairs version."""
import random

import numpy as np
import pytest
import xxhash
from conftest import SF_MID
from llm.fixtures import awkward, clashing, docs_of, table

from riskwin.llm import simhash as S
from riskwin.llm.components import connected_components


def plain_fingerprint(text):
    import re

    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, bits=4):
    """{(doc_id, fingerprint)} to the smallest id reachable."""
    fps = sorted({f for _, f in rows})
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin(a ^ b).count("1") <= bits:
                parent[find(a)] = find(b)
    least = {}
    for d, f in rows:
        if d is not None:
            r = find(f)
            least[r] = min(least.get(r, d), d)
    return {(d, f): least.get(find(f)) for d, f in rows}


def result(df):
    return sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("text", ["", None, "one", "One TWO three", "a b c d", "Ä b c d e f\x0bg", "x " * 5000])
def test_fingerprint(text):
    assert S.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_a_segment_differs_in_one_bit_at_most():
    for d in range(0, 8):
        segs = S.segments(d)
        assert sum(w for _, w in segs) == 64 and 2 * len(segs) > d


def test_documents_against_all_pairs(spark):
    got = S.op3_simhash(spark, SF_MID).collect()
    rows = [(d, plain_fingerprint(t)) for d, t in table(SF_MID, "documents", "doc_id, text")]
    want = brute_components(rows)
    assert {(r["doc_id"], int(r["fingerprint"], 16)): r["component_id"] for r in got} == want
    assert len(got) == len(rows) and all(len(r["fingerprint"]) == 16 for r in got)


@pytest.mark.parametrize("run", [2048, 24, 5])
def test_dense_groups_and_long_runs(spark, run):
    rng = random.Random(run)
    centre = rng.getrandbits(64)
    near = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 6))) for _ in range(150)}
    far = {rng.getrandbits(64) for _ in range(50)}
    fps = np.array(sorted(near | far), dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {r["node"]: r["root"] for r in connected_components(S.links(df, 4, run)).collect()}
    want = brute_components([(f, f % (1 << 64)) for f in fps])
    groups = {}
    for f in fps:
        groups.setdefault(roots.get(f, f), set()).add(f)
    expected = {}
    for (f, _), c in want.items():
        expected.setdefault(c, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_awkward_rows(spark):
    docs = clashing(awkward(spark), ["fp", "keep_id", "component_id", "times"])
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    want = sorted(((d, f, brute_components(rows)[d, f]) for d, f in rows), key=str)
    groups = S.simhash_groups(docs)
    assert result(groups) == want


def test_one_of_each_loses_no_other_text(spark):
    apart = ["the cat sat on the mat and looked at birds", "quite another matter is dealt with here in full", "a third text that has nothing to do with them"]
    near = apart[2]
    rows = [(1, apart[0]), (1, apart[1]), (2, near), (3, near), (3, near), (None, apart[0]), (None, "no other row has this text at all"),
            (None, "no other row has this text at all"), (5, apart[1])]
    docs = clashing(docs_of(spark, rows), ["keep", "keep_of", "fp"])
    kept = S.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(1, apart[0]), (1, apart[1]), (2, near), (None, "no other row has this text at all")], key=str)
    assert S.one_of_each(docs.limit(0)).count() == 0


def test_one_of_each_awkward_rows(spark):
    docs = clashing(awkward(spark), ["fp", "keep", "component_id", "times"])
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    kept = [plain_fingerprint(r["text"]) for r in S.one_of_each(docs).collect()]
    # one row for each component of fingerprints
    of = brute_components([(i, f) for i, (_, f) in enumerate(rows)])
    assert len(kept) == len(set(of.values())) and set(kept) <= {f for _, f in rows}


def test_empty_table(spark):
    empty = docs_of(spark, [(1, "x")]).limit(0)
    groups = S.simhash_groups(empty)
    assert groups.count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100 + 7 * i, 100) for i in range(40)] + [(3, 3)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    assert got == {x: find(x) for x in parent}

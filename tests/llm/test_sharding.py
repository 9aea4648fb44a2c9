"""Two-pass shuffle: whole, even, gapless, seeded, uniform."""
import zlib
from collections import Counter

import pytest
from conftest import SF_MID
from llm.fixtures import awkward, clashing, docs_of, table

from riskwin.llm import sharding as H


def check_places(rows, n, shards):
    counts = Counter(r["shard"] for r in rows)
    assert len(rows) == n and max(counts.values(), default=0) - min((counts[s] for s in range(shards)), default=0) <= 1
    for s, c in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(c))


def test_documents(spark):
    texts = dict(table(SF_MID, "documents", "doc_id, text"))
    rows = H.op10_sharding(spark, SF_MID).collect()
    check_places(rows, len(texts), 40)
    for r in rows:
        b = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(b) + 16, zlib.crc32(b), "rows", None)
    assert len({r["doc_id"] for r in rows}) == len(texts)


def places(df):
    return {r["doc_id"]: (r["shard"], r["slot"]) for r in df.collect()}


@pytest.mark.parametrize("n, shards", [(0, 3), (1, 3), (3, 3), (100, 7), (101, 40)])
def test_counts(spark, n, shards):
    docs = docs_of(spark, [(i, f"text {i}") for i in range(n)]) if n else docs_of(spark, [(1, "x")]).limit(0)
    check_places(H.shuffle_to_shards(docs, shards).collect(), n, shards)


def test_order_depends_on_the_seed_alone(spark):
    docs = docs_of(spark, [(i, f"text {i}") for i in range(200)])
    one = places(H.shuffle_to_shards(docs, 4, seed=1))
    assert one == places(H.shuffle_to_shards(docs.repartition(5).orderBy("text"), 4, seed=1))
    assert one != places(H.shuffle_to_shards(docs, 4, seed=2))


def test_places_are_uniform(spark):
    docs = docs_of(spark, [(i, f"t{i}") for i in range(40)])
    firsts = Counter()
    total = 0
    for seed in range(25):
        got = places(H.shuffle_to_shards(docs, 2, seed=seed, bucket_bytes=100))
        firsts.update(d for d, (s, _) in got.items() if s == 0)
        total += sum(abs(d / 40 - (s * 20 + p) / 40) for d, (s, p) in got.items())
    assert max(firsts.values()) <= 23 and min(firsts[i] for i in range(40)) >= 3
    assert 0.29 < total / (25 * 40) < 0.38  # a third for a random order


def test_awkward_rows(spark):
    docs = clashing(awkward(spark), ["shard", "Slot", "row", "bucket", "key", "place", "first"])
    got = H.shuffle_to_shards(docs, 3)
    assert got.columns == [c for c in docs.columns if c not in ("shard", "Slot")] + ["shard", "slot"]
    rows = got.collect()
    check_places(rows, docs.count(), 3)
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in docs.collect())


def test_repeated_rows_overfill_no_bucket(spark):
    docs = docs_of(spark, [(1, "the same text")] * 3000 + [(i, f"t{i}") for i in range(100)])
    rows = H.shuffle_to_shards(docs, 5, bucket_bytes=2000).collect()
    check_places(rows, 3100, 5)
    assert Counter(r["doc_id"] for r in rows)[1] == 3001


def test_written_shards_are_read_back(spark):
    from riskwin.session import scratch_path

    path = scratch_path(spark, "shards-test")
    H.write_shards(H.shuffle_to_shards(docs_of(spark, [(i, "x") for i in range(50)]), 4), path)
    check_places(spark.read.parquet(path).collect(), 50, 4)


def test_query_against_the_table(spark):
    """Every column of the query by plain Python from the documents."""
    texts = dict(table(SF_MID, "documents", "doc_id, text"))
    rows = H.op10_sharding(spark, SF_MID).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "rows", None)
    per = Counter(r["shard"] for r in rows)
    assert set(per) == set(range(40)) and max(per.values()) - min(per.values()) <= 1
    for shard, n in per.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    # the order has nothing to do with that of the ids
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    rises = sum(a < b for a, b in zip(order, order[1:]))
    assert 0.4 * len(order) < rises < 0.6 * len(order)

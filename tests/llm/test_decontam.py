"""Decontamination against exact containment and full edit distances."""
import random
import time

import numpy as np
import pytest
from conftest import SF_MID
from llm.fixtures import awkward, clashing, docs_of, table

from riskwin.llm import decontam as D

WORD = D.word_chars()


def normal(text):
    return "".join(chr(c) for c in D.normal_codes([text], WORD)[0][:-1])


def brute_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.mark.parametrize("text, want", [
    ("Hello,  World!", "hello world"), ("", ""), ("!!", ""), ("  a--b_c ", "a b c"), ("ÄÖ 1\n2", "äö 1 2"), ("x\0y", "x y"),
])
def test_normal(text, want):
    assert normal(text) == want


def test_several_texts_keep_their_places():
    codes, places, owner = D.normal_codes(["A b", "", "..c"], WORD)
    assert "".join(chr(c) if c else "|" for c in codes) == "a b||c|"
    assert owner.tolist() == [0, 0, 0, 0, 1, 2, 2] and places.tolist()[:3] == [0, 1, 2] and places[5] == 2


def test_banded_distance():
    rng = random.Random(1)
    for _ in range(200):
        item = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 9)))
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 14)))
        a, b = (np.array([ord(c) for c in x], np.uint64) for x in (item, text))
        assert D.banded_distance(a, b, -20, 20)[0] == brute_distance(item, text)


def edit(rng, text, n):
    for _ in range(n):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + rng.choice("xyz") + text[i + 1:], text[:i] + rng.choice("xyz") + text[i:],
                           text[:i] + text[i + 1:]])
    return text


@pytest.mark.parametrize("seed", range(4))
def test_edited_items_against_brute_force(seed):
    rng = random.Random(seed)
    items = [(i, "".join(rng.choice("abcdefg") for _ in range(rng.choice([6, 12, 30, 90])))) for i in range(8)]
    texts = []
    for _ in range(30):
        i, item = rng.choice(items)
        k = D.edit_budget(len(item))
        body = edit(rng, item, rng.randrange(0, k + 3))
        side = "".join(rng.choice("hijk ") for _ in range(20))
        texts.append(f"{side} {body} {side[::-1]}")
    index = D.ItemIndex.build(items)
    got = {(t, index.ids[i]): e for t, i, e, *_ in D.search(texts, index, WORD)}
    for t, text in enumerate(texts):
        for i, item in items:
            m, plain = len(item), normal(text)
            if m < D.Q:
                want = 0 if f" {item} " in f" {plain} " else None
            else:
                d = brute_distance(item, plain)
                want = d if d <= D.edit_budget(m) else None
            assert got.get((t, i)) == want, (text, item)


def test_documents_hold_items_exactly(spark):
    docs = [(d, normal(t or "")) for d, t in table(SF_MID, "documents", "doc_id, text")]
    items = [(i, normal(t)) for i, t in table(SF_MID, "benchmark", "item_id, text")]
    exact = {(d, i) for d, t in docs for i, p in items if p in t}
    rows = D.op8_decontam(spark, SF_MID).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert exact and exact <= got and len(rows) == len(got)
    assert {(r["doc_id"], r["item_id"]) for r in rows if r["edits"] == 0} == exact
    texts = dict(table(SF_MID, "documents", "doc_id, text"))
    names = dict(items)
    for r in rows:
        if r["edits"] == 0:
            assert names[r["item_id"]] in normal(texts[r["doc_id"]][r["start"]:r["end"]])


def test_passes_give_the_same(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").filter(F.col("doc_id") < 300)
    items = spark.read.parquet(f"{SF_MID}/benchmark.parquet")
    one, many = (sorted(map(tuple, D.matches(docs, items, pass_chars=n).collect())) for n in (10 ** 6, 3000))
    assert one == many and one


def test_awkward_rows(spark):
    docs = clashing(awkward(spark), ["bad_id", "item_id", "edits"])
    items = spark.createDataFrame([("x", "The cat sat on the mat!"), ("y", None), ("z", ""), ("s", "cat"), ("t", "zzz"),
                                   ("u", "the cat sat on the mat")], "item_id string, text string")
    found = D.matches(docs, items)
    got = sorted((r["doc_id"], r["item_id"]) for r in found.collect())
    assert got == sorted([(d, i) for d in (1, 1, 2) for i in "xus"])
    left = D.without_items(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - 3
    with_null = D.matches(docs, spark.createDataFrame([("n", "text without an id")], "item_id string, text string"))
    assert [r["doc_id"] for r in with_null.collect()] == [None]


def test_clean_rows_stay_whatever_their_id(spark):
    docs = clashing(docs_of(spark, [(1, "so the cat sat on the mat again"), (1, "a clean text"), (None, "the cat sat on the mat"), (None, "clean too"),
                                    (None, None), (2, ""), (3, "another clean text")]), ["own", "bad", "doc"])
    items = spark.createDataFrame([("x", "The cat sat on the mat!")], "item_id string, text string")
    left = D.without_items(docs, items)
    assert left.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(
        [(1, "a clean text"), (None, "clean too"), (None, None), (2, ""), (3, "another clean text")], key=str)


def test_empty_tables(spark):
    docs, items = docs_of(spark, [(1, "a b")]), spark.createDataFrame([], "item_id long, text string")
    assert D.matches(docs, items).count() == 0
    assert D.matches(docs.limit(0), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0


OPENING = "choose the one correct answer to the following question"


def exam(seed, items, passages):
    rng = random.Random(seed)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(n))

    asked = [(i, f"{OPENING} {words(12)}") for i in range(items)]
    return asked, [f"{OPENING} {words(6)}" for _ in range(passages)]


def test_items_with_one_opening():
    """500 items and 400 passages begin alike: 200 000 bands reach the count."""
    items, passages = exam(1, 500, 400)
    held = {40: 7, 200: 311, 399: 499}
    rng = random.Random(2)
    for at, i in held.items():
        passages[at] = edit(rng, items[i][1], D.edit_budget(len(items[i][1])) // 2)
    began = time.process_time()
    got = D.search([" ".join(passages), "zzz"], D.ItemIndex.build(items), WORD)
    assert time.process_time() - began < 60
    assert sorted(item for _, item, *_ in got) == sorted(held.values())


def test_one_opening_against_brute_force(monkeypatch):
    items, passages = exam(3, 6, 5)
    passages[2] = items[4][1][:70] + "x" + items[4][1][72:]
    index = D.ItemIndex.build(items)
    got = D.search(passages, index, WORD)
    want = [(t, i, d) for t, p in enumerate(passages) for i, item in items
            if (d := brute_distance(item, p)) <= D.edit_budget(len(item))]
    assert [g[:3] for g in got] == want and want
    for hits, cells in ((1, 1), (60, 3000)):
        monkeypatch.setattr(D, "HITS", hits)
        monkeypatch.setattr(D, "CELLS", cells)
        assert D.search(passages, index, WORD) == got


def test_one_item_with_very_many_hits(monkeypatch):
    monkeypatch.setattr(D, "HITS", 500)
    items = [(0, "a" * 60), (1, "b" * 30 + "a" * 30)]
    texts = ["a" * 300, "b" * 30 + "a" * 28, "b" * 12]
    got = [g[:3] for g in D.search(texts, D.ItemIndex.build(items), WORD)]
    assert got == [(t, i, d) for t, p in enumerate(texts) for i, item in items
                   if (d := brute_distance(item, p)) <= D.edit_budget(len(item))]

"""Toxicity lexicon: folding, matching, exceptions, held-out accuracy."""
import zlib

import numpy as np
import pytest
from conftest import SF_MID
from llm.fixtures import awkward, clashing, docs_of, table

from riskwin.llm import toxicity as X


@pytest.mark.parametrize("raw, folded", [
    ("1D10T", " idiot "), ("іdіоt", " idiot "), ("ｍｏｒｏｎ!", " moroni "), ("st​upid", " stupid "),
    ("you, $cum.", " you scum "), ("", " "), (None, " "), (" \n", " "),
    ("ídiot", " idiot "), ("i\u0301diot", " idiot "), ("𝐈𝒅iot", " idiot "), ("In 2024 l0ser 7", " in 2024 loser 7 "),
])
def test_fold(raw, folded):
    assert X.fold(raw) == folded


def brute_matches(folded, weights, exceptions):
    words, out, at = folded.split(), [], 1
    places = []
    for w in words:
        places.append(at)
        at += len(w) + 1
    shields = [(i, i + len(p) + 1) for p in exceptions for i in range(len(folded)) if folded.startswith(f" {p} ", i)]
    for w, p in zip(words, places):
        hits = [t for t in weights if (w + " ").startswith(t)]
        if hits and not any(a <= p - 1 < b for a, b in shields):
            t = max(hits, key=len)
            out.append((p, p + len(t), weights[t]))
    return out


@pytest.mark.parametrize("text", ["clown fish and a clown", "idiotic idiot", "no", "", "sad clown fish idiot clown", "clown"])
def test_matches_against_brute_force(text):
    model = X.ToxicityModel({"clown": 3.0, "idiot": 2.0, "idiot ": 4.0}, ["clown fish", "sad clown"])
    folded = X.fold(text)
    found, _ = X.matches(folded, model.automaton())
    assert found == brute_matches(folded, model.weights, model.exceptions)


def test_length_lowers_and_exceptions_lift_the_score():
    model = X.ToxicityModel({"clown": 3.0}, ["clown fish"])
    auto = model.automaton()
    short, long = X.score_text("clown", model, auto), X.score_text("clown" + " word" * 5000, model, auto)
    none = X.score_text("word", model, auto)
    assert short > long > none == X.score_text("a clown fish", model, auto) == X.score_text("", model, auto)


def test_learned_terms_and_exceptions(spark):
    rows = [(f"text number w{i} dumbo{'s' * (i % 3)} x{i}", 1) for i in range(60)]
    rows += [(f"plain words here for w{i} and x{i}", 0) for i in range(300)]
    rows += [(f"we saw dumbo movie at w{i}", 0) for i in range(6)]
    rows += [("copied strangeword text", 1)] * 200  # one context only
    model = X.fit(spark.createDataFrame(rows, "text string, toxic int"))
    assert any(t.startswith("dumb") for t in model.weights)
    assert not any(t.startswith("stran") or t.startswith("copi") for t in model.weights)
    assert "dumbo movie" in model.exceptions


def test_held_out_accuracy(spark):
    toxic = dict(table(SF_MID, "labels", "doc_id, toxic"))
    rows = X.op1_toxicity(spark, SF_MID).collect()
    assert len(rows) == len(table(SF_MID, "documents", "doc_id"))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in toxic]
    assert sum(r["predicted"] == toxic[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_recall_on_held_out_rows(spark):
    toxic = dict(table("/root/testdata/sf0.1", "labels", "doc_id, toxic"))
    held = [r for r in X.op1_toxicity(spark, "/root/testdata/sf0.1").collect() if r["held_out"] and r["doc_id"] in toxic]
    hits = [r["predicted"] for r in held if toxic[r["doc_id"]] == 1]
    alarms = [r["predicted"] for r in held if toxic[r["doc_id"]] == 0]
    assert len(hits) > 50 and sum(hits) >= 0.9 * len(hits) and sum(alarms) <= 0.01 * len(alarms)


def test_small_tables_learn_terms(spark):
    """There is no least count: rarer terms need wider bounds."""
    toxic = dict(table("/root/testdata/sf0.001", "labels", "doc_id, toxic"))
    rows = [r for r in X.op1_toxicity(spark, "/root/testdata/sf0.001").collect() if r["doc_id"] in toxic]
    assert sum(r["predicted"] for r in rows if toxic[r["doc_id"]] == 1) >= 5
    assert not any(r["predicted"] for r in rows if toxic[r["doc_id"]] == 0)


def test_weighted_curve_is_that_of_repeated_rows():
    x, y, n = (np.array(v, float) for v in ([0, 1, 2, 0, 3], [0, 0, 1, 1, 1], [50, 3, 7, 1, 9]))
    times = n.astype(int)
    once = X.logistic(np.repeat(x, times), np.repeat(y, times), np.ones(times.sum()))
    assert X.logistic(x, y, n) == pytest.approx(once)


def test_awkward_rows_and_empty_tables(spark):
    docs = clashing(awkward(spark), ["toxicity", "scored", "term"])
    model = X.ToxicityModel({"thing": 3.0}, [])
    got = X.score(docs, model)
    assert got.columns == [c for c in docs.columns if c != "toxicity"] + ["toxicity", "toxic_terms"]
    rows = got.collect()
    assert len(rows) == docs.count() and {r["toxic_terms"] for r in rows} == {0, 20_000}
    empty = docs_of(spark, [(1, "x")]).limit(0)
    assert X.score(empty, model).count() == 0
    none = X.fit(empty.selectExpr("text", "1 as toxic"))
    assert none.weights == {} and all(r["toxicity"] < 0.5 for r in X.score(docs, none).collect())
    odd = spark.createDataFrame([("a", None), (None, 1), ("b", 7), ("c", 0)], "text string, toxic int")
    assert X.fit(odd).weights == {}

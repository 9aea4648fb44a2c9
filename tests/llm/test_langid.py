"""Language filters: Bloom behaviour, correction, held-out accuracy."""
import zlib

import numpy as np
from conftest import SF_MID
from llm.fixtures import awkward, clashing, docs_of, table

from riskwin.llm import langid as L


def codes_of(*texts):
    return L.grams([L.normal(t) for t in texts])


def test_grams_stay_within_a_text():
    codes, owner = codes_of("ab cd", "ab cd", "x")
    assert (codes[owner == 0] == codes[owner == 1]).all() and (owner == 0).sum() == len(" ab cd ") - L.GRAM + 1
    assert (owner == 2).sum() == 0


def test_no_false_negative_and_corrected_counts():
    rng = np.random.default_rng(1)
    own = [rng.integers(0, 1 << 62, n).astype(np.uint64) for n in (4000, 1000, 4000)]
    f = L.LanguageFilters.build(["a", "b", "c"], own, slot_bits=14)
    for i, codes in enumerate(own):
        total, held = f.counts(codes, np.zeros(len(codes), int), 1)
        assert total[0] == len(codes) and held[0, i] >= len(codes) * 0.999
    other = rng.integers(0, 1 << 62, 50_000).astype(np.uint64)
    raw_false = f.false_positive * len(other)
    _, held = f.counts(other, np.zeros(len(other), int), 1)
    assert raw_false.max() > 1000 and (held < 0.02 * len(other)).all()


def test_more_than_64_languages():
    codes = [np.arange(i * 100, i * 100 + 50, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for i in range(70)]
    f = L.LanguageFilters.build([f"l{i:02}" for i in range(70)], codes)
    assert f.table.shape[0] == 2
    for i in (0, 63, 64, 69):
        assert np.argmax(f.counts(codes[i], np.zeros(50, int), 1)[1]) == i


def test_held_out_accuracy(spark):
    langs = dict(table(SF_MID, "documents", "doc_id, lang"))
    rows = L.op2_langid(spark, SF_MID).collect()
    assert len(rows) == len(langs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.99 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_awkward_rows(spark):
    docs = clashing(awkward(spark), ["lang_pred", "language", "code"])
    model = L.fit(docs.select("text", "lang"), min_count=1)
    assert model.languages == ["en"]
    got = L.identify(docs, model)
    assert got.columns == [c for c in docs.columns if c != "lang_pred"] + ["lang_pred", "lang_score", "lang_share"]
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        letter = r["text"] is not None and any(map(str.isalpha, r["text"]))
        assert r["lang_pred"] == ("en" if letter else "und")
        assert letter or r["lang_score"] == 0


def test_empty_tables(spark):
    empty = docs_of(spark, [(1, "x", "en")]).limit(0)
    model = L.fit(empty.select("text", "lang"))
    assert model.languages == [] and L.identify(empty, model).count() == 0
    assert {r["lang_pred"] for r in L.identify(awkward(spark), model).collect()} == {"und"}


def test_sample_is_bounded(spark):
    df = spark.range(20_000)
    assert 800 < L.hash_sample(df, 1000, "id").count() < 1200
    assert L.hash_sample(df, 30_000, "id").count() == 20_000


def test_small_languages_are_learned_beside_large_ones(spark):
    rng = np.random.default_rng(2)

    def text(letters):
        words = ["".join(rng.choice(list(letters), rng.integers(3, 7))) for _ in range(12)]
        return " ".join(words)

    rows = [(i, text("abcdefgh"), "xx") for i in range(3000)]
    rows += [(3000 + i, "рстуф рсту", "rr") for i in range(400)]  # one text, over the bound of 200
    rows += [(4000 + i, "ικλμνο πιστ κλμν", "gr") for i in range(2)]
    rows += [(5000, "שלוםעו לםשל", "he")]
    docs = docs_of(spark, rows)
    model = L.fit(docs.select("text", "lang"), fit_rows=200)
    assert model.languages == ["gr", "he", "rr", "xx"]
    got = {r["doc_id"]: r for r in L.identify(docs, model).collect()}
    assert all(got[i]["lang_pred"] == lang and got[i]["lang_share"] > 0.9 for i, _, lang in rows if lang != "xx")


def test_sample_is_bounded_within_each_language(spark):
    df = spark.range(6000).selectExpr("cast(id as string) as text", "if(id < 5500, 'a', 'b') as lang")
    n = {r["lang"]: r["count"] for r in L.sample_by_language(df, 1000).groupBy("lang").count().collect()}
    assert 800 < n["a"] < 1200 and n["b"] == 500


def test_query_against_plain_sets(spark):
    """The whole query by exact sets of n-grams in plain Python: the same languages,
    scores within what the filters' false positives leave."""
    from collections import Counter

    docs = table(SF_MID, "documents", "doc_id, text, lang")
    counted = {}
    for d, text, lang in docs:
        if zlib.crc32(str(d).encode()) % 3 != 1 and text is not None and lang is not None:
            plain = L.normal(text)
            counted.setdefault(lang, Counter()).update(plain[i:i + L.GRAM] for i in range(len(plain) - L.GRAM + 1))
    total = {x: sum(c.values()) for x, c in counted.items()}
    most = Counter()
    for lang, c in counted.items():
        for g, n in c.items():
            most[g] = max(most[g], n / total[lang])
    held = {lang: {g for g, n in c.items() if n >= min(L.MIN_COUNT, 1 + total[lang] // L.FEW_GRAMS) and n / total[lang] >= L.MIN_SHARE * most[g]}
            for lang, c in counted.items()}
    assert all(len(s) <= L.CAPACITY for s in held.values())
    want = {}
    for d, text, _ in docs:
        plain = L.normal(text or "")
        if not plain:
            want[d] = (L.UNDETERMINED, 0.0)
            continue
        own = [plain[i:i + L.GRAM] for i in range(len(plain) - L.GRAM + 1)]
        n = {lang: sum(g in s for g in own) for lang, s in sorted(held.items())}
        best = max(n, key=lambda x: n[x])
        top = sorted(n.values(), reverse=True)[:2]
        want[d] = (best, top[0] / sum(top) if top[0] else 0.0)
    rows = L.op2_langid(spark, SF_MID).collect()
    assert len(rows) == len(want)
    wrong = [r for r in rows if r["lang_pred"] != want[r["doc_id"]][0] and want[r["doc_id"]][1] > 0.55]
    assert not wrong
    long = {d for d, t, _ in docs if t and len(t) > 200}
    assert all(abs(r["score"] - want[r["doc_id"]][1]) < 0.05 for r in rows if r["doc_id"] in long)

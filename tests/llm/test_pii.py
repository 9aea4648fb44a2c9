"""Personal data: patterns against plain regular expressions, disclosure
against counts made by hand."""
import hashlib
import math
import random
import re
import time

from conftest import SF_MID, SF_SMALL
from llm.fixtures import awkward, clashing, docs_of, table

from riskwin.llm import pii as P

# The patterns as the contract gives them.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    s = 0
    for i, c in enumerate(d[::-1]):
        s += int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))
    return s % 10 == 0


def brute(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub(r"[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]


def test_patterns_against_plain_ones():
    rng = random.Random(3)
    parts = ["a", "b.c", "@", "1", "22", "4", ".", " ", "-", "+", "(", ")", "é", "255", "256", "@x.y", "0000", "٣",
             "4111111111111111", "5500 0000 0000 0004", "+1 (386) 555-3733", "10.0.0.1"]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 25)))
        assert P.base_spans(t) == brute(t), t


def test_long_runs_take_linear_time():
    t = time.time()
    P.base_spans("a" * 1_000_000 + " " + "1" * 1_000_000 + "@" * 100_000 + "1.1." * 100_000)
    assert time.time() - t < 10


def test_documents(spark):
    texts = dict(table(SF_MID, "documents", "doc_id, text"))
    rows = P.op6_pii(spark, SF_MID).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r["doc_id"]] or "")
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(s[0] == k for s in spans) for k in P.KINDS]
        assert r["base_sha256"] == hashlib.sha256(P.joined(spans).encode()).hexdigest()
        assert P.parsed(r["spans"])[:len(spans)] == spans
        assert all(k == P.TERM for k, _, _ in P.parsed(r["spans"])[len(spans):])


def corpus(spark):
    rows = [(i, f"contact zorblatt about it{i} at jo@x.org today") for i in range(6)]
    rows += [(i, f"zorblatt is not alone number{i}") for i in range(6, 7)]
    rows += [(i, f"plain words today about nothing number{i}") for i in range(7, 60)]
    rows += [(i, "copy of quuxly at only@once.org") for i in range(60, 70)]  # one text, ten copies
    return rows, docs_of(spark, rows)


def test_disclosure_by_hand(spark):
    rows, docs = corpus(spark)
    n = len({t for _, t in rows})
    found = P.detect(docs)
    texts = docs.selectExpr("xxhash64(text) as hash", "text")
    for few in (P.BROADCAST_TERMS, 0):
        got = {(r["entity"], r["term"]): r["disclosure"] for r in P.disclosures(found, texts, at_least=-9.0, broadcast_terms=few).collect()}
        want = {t: 1 + math.log(6 / n_t) / math.log(n / 6) for t, n_t in {"contact": 6, "zorblatt": 7, "about": 59, "today": 59}.items()}
        assert {t: v for (e, t), v in got.items()} == {t: __import__("pytest").approx(v) for t, v in want.items()}
        assert {e for e, _ in got} == {"email:jo@x.org"}


def test_terms_are_generalised_or_removed(spark):
    rows, docs = corpus(spark)
    found = P.personal_data(docs)
    clean = {r["doc_id"]: r["sanitised"] for r in P.sanitised(docs, found).collect()}
    assert len(clean) == len(rows)
    assert clean[0] == " zor* about it0 at <EMAIL> today".replace(" zor", " zor", 1)
    assert clean[6] == "zorblatt is not alone number6"
    assert clean[60] == "copy of quuxly at <EMAIL>"


def test_sanitise_overlaps():
    text = "call +1 (386) 555-3733 or 4111 1111 1111 1111"
    spans = P.joined(P.base_spans(text))
    assert P.sanitise_text(text, spans, "") == "call <PHONE> or <CARD>"
    assert P.sanitise_text("", "", "") == ""


def test_awkward_rows(spark):
    docs = clashing(awkward(spark), ["hash", "spans", "terms", "row", "base"])
    found = P.personal_data(docs)
    rows = found.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in docs.collect())
    assert all(r["spans"] == "" for r in rows)
    clean = P.sanitised(docs, found)
    assert clean.columns == [*docs.columns, "sanitised"] and clean.count() == docs.count()
    empty = docs_of(spark, [(1, "x")]).limit(0)
    assert P.personal_data(empty).count() == 0


def test_near_words_are_counted_by_place():
    text = "far " + "1" * 900 + " abcdefgh" + "9" * 792 + " at jo@x.org" + " " * 900 + "behind " + "www " * 19 + "last"
    assert P.near_terms(text, P.base_spans(text)) == [{"entity": "email:jo@x.org", "terms": ["abcdefgh", "behind", "far", "www"]}]
    text = " ".join(f"{chr(97 + i)}aa" for i in range(25)) + " jo@x.org jo@x.org " + "zzz jo@x.org zzzz"
    got = P.near_terms(text, P.base_spans(text))
    assert got == [{"entity": "email:jo@x.org", "terms": sorted([f"{chr(97 + i)}aa" for i in range(5, 25)] + ["zzz", "zzzz"])}]


def test_query_generalises_terms_of_entities_in_one_text(spark):
    texts = [t for _, t in table(SF_SMALL, "documents", "doc_id, text")]
    words, near, held = {}, {}, {}
    for t in set(t or "" for t in texts):
        for w in {w for w, _, _ in P.terms_in(t)}:
            words[w] = words.get(w, 0) + 1
        spans = brute(t)
        for x in P.near_terms(t, spans) if spans else []:
            held[x["entity"]] = held.get(x["entity"], 0) + 1
            for w in x["terms"]:
                near[x["entity"], w] = near.get((x["entity"], w), 0) + 1
    n = len(set(texts))
    shown = {k for k, n_te in near.items() if n > held[k[0]]
             and 1 + math.log(n_te / words[k[1]]) / math.log(n / held[k[0]]) >= P.GENERALISE_AT - 1e-12}
    want = {}
    for t in set(texts):
        spans = brute(t or "")
        own = {w for e in {P.entity(k, t[a:b]) for k, a, b in spans} for x, w in shown if x == e}
        want[hashlib.sha256((t or "").encode()).hexdigest()] = [
            (P.TERM, a, b) for w, a, b in P.terms_in(t or "") if w in own and not any(x <= a < y or x < b <= y for _, x, y in spans)]
    got, by_id = P.op6_pii(spark, SF_SMALL).collect(), dict(table(SF_SMALL, "documents", "doc_id, text"))
    assert sum(map(len, want.values())) > 0
    for r in got:
        t = by_id[r["doc_id"]] or ""
        assert [s for s in P.parsed(r["spans"]) if s[0] == P.TERM] == want[hashlib.sha256(t.encode()).hexdigest()]

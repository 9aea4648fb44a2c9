"""The Jaccard join against all pairs and SQL."""
import random
import re

import numpy as np
from compare import compare, duck
from conftest import SF_SMALL
from llm.fixtures import awkward, clashing, docs_of

from riskwin.llm import token_groups as G

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset([" ".join(w)] if 0 < len(w) < k else [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)])


def brute(rows, per_cent=80, k=5):
    """[(doc_id, size, component)] of rows (doc_id, text), by all pairs."""
    sets = [plain_set(t, k) for _, t in rows]
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= per_cent * len(a | b):
                lo, hi = sorted((root[i], root[j]))
                root = [lo if r == hi else r for r in root]
    least = {}
    for (d, _), r in zip(rows, root):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(s), least.get(r) if s else d) for (d, _), s, r in zip(rows, sets, root)), key=str)


def run(spark, rows, **more):
    return sorted((tuple(r) for r in G.jaccard_groups(docs_of(spark, rows), **more).collect()), key=str)


def near_copies(rng, n, words, changes):
    """``n`` texts, each the last one or the first with some words changed."""
    first = [f"w{rng.randrange(400)}" for _ in range(words)]
    out = [first]
    for _ in range(n - 1):
        t = list(rng.choice([first, out[-1]]))
        for _ in range(rng.randrange(changes + 1)):
            t[rng.randrange(len(t))] = f"w{rng.randrange(400)}"
        out.append(t)
    return [" ".join(t) for t in out]


def test_shingles_of_a_text():
    words = G._WordHashes()
    for text in ("", " \t\n", "a", "A b", "a b c d", "a b c d e", "A b\tc d  e f g\x0bh", "x " * 30, "É é É é É é", "a\xa0b c d e f"):
        assert len(G.shingle_set(text, words)) == len(plain_set(text))
    same = [G.shingle_set(t, words).tolist() for t in ("a B c d e f", "A b C d\ne\tf")]
    assert same[0] == same[1] and G.shingle_set(None, words).tolist() == []
    # fewer words than a shingle never look like a shingle of five
    assert not set(G.shingle_set("a b c d", words)) & set(G.shingle_set("a b c d e", words))


def test_bound_holds_for_linked_sets():
    rng = random.Random(2)
    for _ in range(300):
        a = set(rng.sample(range(60), rng.randrange(1, 50)))
        b = {x for x in a if rng.random() < 0.95} | set(rng.sample(range(60, 80), rng.randrange(3)))
        if not b or not G.linked(len(a & b), len(a), len(b), 80):
            continue
        first = [set(sorted(s)[:len(s) - G.least_shared(len(s), 80) + 1]) for s in (a, b)]
        c = len(first[0] & first[1])
        assert c >= 1
        assert c + max(len(a), len(b)) * 0.8 >= (len(a) + len(b)) * 80 / 180 - 1e-6


def test_random_texts(spark):
    rng = random.Random(4)
    rows, texts = [], []
    for words, changes in ((120, 6), (40, 2), (15, 1), (7, 1), (400, 25), (60, 9)):
        texts += near_copies(rng, 14, words, changes)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [" ".join(f"w{rng.randrange(400)}" for _ in range(80)) + " " + passage for _ in range(25)]  # a passage that many share
    texts += [passage + f" {i % 3}" for i in range(9)]
    texts += texts[:20]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    want = brute(rows)
    assert run(spark, rows, slot_bits=16) == want
    assert len({c for _, _, c in want}) < len(rows) - 50


def test_chunks_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(G, "CHUNK", 4)
    monkeypatch.setattr(G, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(G, "HOT_COPIES", 10)
    rng = random.Random(9)
    rows = list(enumerate(near_copies(rng, 90, 60, 3) + ["one text that has very many copies of it"] * 40))
    assert run(spark, rows) == brute(rows)


def test_frequent_tokens_are_dealt_out(spark, monkeypatch):
    # every token counts as frequent: shares of 2 ** 3, first sets among first sets
    monkeypatch.setattr(G, "slot_levels", lambda docs, bits, k: np.full(1 << bits, 3, np.uint8))
    rows = list(enumerate(near_copies(random.Random(1), 60, 50, 2)))
    assert run(spark, rows) == brute(rows)


def test_first_shared_token_bounds_sizes():
    rng = random.Random(6)
    seen = 0
    for _ in range(2000):
        a = set(rng.sample(range(60), rng.randrange(1, 50)))
        b = {x for x in a if rng.random() < 0.95} | set(rng.sample(range(80), rng.randrange(3)))
        if b and G.linked(len(a & b), len(a), len(b), 80):
            i, j = (sorted(s).index(min(a & b)) for s in (a, b))
            assert len(b) <= (100 * len(a) - 180 * i) // 80 and len(a) <= (100 * len(b) - 180 * j) // 80
            seen += i + j > 0
    assert seen > 50


def test_pairs_around_one_text_do_not_grow_with_their_square(spark, monkeypatch):
    # two words changed: linked with the first text only; three: with none
    rng, base, texts = random.Random(3), [f"b{i}" for i in range(100)], []
    for t in range(240):
        words = list(base)
        for at in rng.sample(range(5, 95, 6), 2 + t % 2):
            words[at] = f"own{t}x{at}"
        texts.append(" ".join(words))
    texts.insert(150, " ".join(base))
    rows, asked, opened = list(enumerate(texts)), [], G.opened

    def counted(pairs, *more):
        asked.append(pairs.count())
        return opened(pairs, *more)

    monkeypatch.setattr(G, "opened", counted)
    got = run(spark, rows, slot_bits=16)
    assert got == brute(rows)
    assert len({c for _, _, c in got}) == 121
    assert sum(asked) < 4 * len(rows)


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = G.jaccard_groups(clashing(df, ["sid", "h", "n", "grp", "th", "comp"]))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    assert G.jaccard_groups(df.limit(0)).collect() == []


def test_sql(spark):
    r = compare(G.op12_jaccard(spark, SF_SMALL), duck(SF_SMALL), G.JACCARD_SQL)
    assert r["cols"] and r["rows"][0] == r["rows"][1] and r["hash"]

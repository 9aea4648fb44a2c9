"""Benchmark decontamination by the q-gram lemma.

A text region within ``k`` edits of a benchmark item of ``m`` characters shares
at least ``m - q + 1 - k * q`` character q-grams with it, and these lie on
diagonals (place in the text minus place in the item) at most ``k`` apart. So:

* the q-grams of a text are looked up in an index of the items' q-grams;
* hits are counted by document, item and diagonal band; bands are twice as wide
  as their distance, which is over ``k``, so an alignment is whole in one band;
* bands that reach the lemma's count are verified by banded alignments, many
  bands at a time; a band is dropped once its best is over the budget.

Where many items share an opening, a passage with it reaches the count of each, so
hits are counted for a group of items at a time, and memory stays bounded.

Texts and items are compared in lower case, with one space for every run of
characters that are neither letters nor digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwin.llm.batches import small_batches
from riskwin.llm.columns import fresh, row_key
from riskwin.llm.langid import chunks

#: Characters of a q-gram.
Q = 10
#: Edits allowed, as a part of the item's length.
EDIT_RATE = 0.08
#: Characters of benchmark items that one pass over the texts looks for; more
#: items take more passes. The index of a pass is broadcast.
PASS_CHARS = 4_000_000
CHUNK = 250_000
#: Hits of q-grams that are counted at once, and cells of alignments held at once.
HITS = 1_000_000
CELLS = 1 << 20
#: Rows of an alignment between two looks at which bands are still within budget.
LOOK = 8
#: A character that no text or item has.
_NONE = -1


def word_chars() -> np.ndarray:
    """Whether each code point is a letter or digit."""
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def normal_codes(texts: list[str], is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised characters of some texts, a 0 after each; the place of each
    in its text; and the index of its text."""
    lowered = [t.lower().replace("\0", " ") for t in texts]
    # a few characters change their number when lower-cased; these texts keep
    # the places of the lower-cased form
    codes = np.frombuffer(("\0".join(lowered) + "\0").encode("utf-32-le", "surrogatepass"), "<u4")
    end = codes == 0
    owner = np.cumsum(end) - end
    starts = np.r_[0, np.flatnonzero(end)[:-1] + 1]
    word = is_word[codes]
    solid = word | end
    before = np.r_[False, solid[:-1] & ~end[:-1]]  # a space only right after a letter or digit
    kept = np.flatnonzero(solid | before)
    out = codes[kept].astype(np.uint64)
    out[~solid[kept]] = 32
    # no space at the end of a text
    trailing = np.r_[(out[:-1] == 32) & (out[1:] == 0), False]
    kept, out = kept[~trailing], out[~trailing]
    return out, kept - starts[owner[kept]], owner[kept]


def window_hash(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of every window of ``q`` characters, doubled up from shorter ones."""
    if q == 1:
        return codes
    if q % 2:
        shorter = window_hash(codes, q - 1)
        return shorter[:len(codes) - q + 1] * np.uint64(0x100000001B3) + codes[q - 1:]
    half = window_hash(codes, q // 2)
    return half[:max(0, len(codes) - q + 1)] * np.uint64(0x9E3779B97F4A7C15) + half[q // 2:]


def edit_budget(m: int, q: int = Q, rate: float = EDIT_RATE) -> int:
    """Edits allowed for an item: the rate's, but so that one q-gram is left."""
    return max(0, min(int(rate * m), (m - q) // q))


@dataclass
class ItemIndex:
    """q-grams of the items of one pass: ``grams`` sorted, with the places
    ``at[first[i]:first[i + 1]]`` in ``codes``, which joins all items."""

    ids: list
    codes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    at: np.ndarray
    seen: np.ndarray
    budgets: np.ndarray
    q: int

    @classmethod
    def build(cls, items: list[tuple], q: int = Q, rate: float = EDIT_RATE) -> "ItemIndex":
        """From (id, text); items without a letter or digit are left out. Those
        shorter than ``q`` are padded in front by zeros, which match nothing, and
        are found by ``short_items``."""
        codes, _, owner = normal_codes([t for _, t in items], word_chars())
        lengths = np.bincount(owner, minlength=len(items)) - 1
        starts = np.r_[0, np.cumsum(lengths + 1)[:-1]].astype(np.int64)
        hashes = window_hash(codes, q) if len(codes) >= q else np.array([], np.uint64)
        place = np.arange(len(hashes))
        inside = place + q <= (starts + lengths)[owner[:len(hashes)]] if len(hashes) else np.array([], bool)
        place, hashes = place[inside], hashes[inside]
        order = np.argsort(hashes, kind="stable")
        grams, first = np.unique(hashes[order], return_index=True)
        seen = np.zeros(1 << 22, bool)
        seen[grams >> np.uint64(42)] = True
        return cls([i for i, _ in items], codes, starts, lengths, grams, np.r_[first, len(hashes)], place[order], seen,
                   np.array([edit_budget(int(m), q, rate) for m in lengths], dtype=np.int64), q)

    def short_items(self) -> list[int]:
        return [i for i, m in enumerate(self.lengths) if 0 < m < self.q]

    def item_codes(self, item: int) -> np.ndarray:
        return self.codes[self.starts[item]:self.starts[item] + self.lengths[item]]


def banded_distances(index: "ItemIndex", codes: np.ndarray, item: np.ndarray, begin: np.ndarray, end: np.ndarray,
                     low: np.ndarray, width: int, budgets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item and stretch ``codes[begin:end]``: the least edits between the
    item and any part of the stretch, on alignments whose diagonals (place in the
    stretch minus place in the item) are ``width`` from ``low`` on; and where the
    part ends. Those over the budget may come back as any number over it.

    Diagonals run down a column of a table, bands side by side; a row of the
    alignment is a step for all bands."""
    n, lengths = len(item), index.lengths[item]
    rows = int(lengths.max(initial=0))
    kind = np.int16 if rows + width < 1 << 13 else np.int32
    far = np.iinfo(kind).max // 2
    best, stop = np.full(n, far, np.int64), np.zeros(n, np.int64)
    size = end - begin
    # text[r + x] is the character that ends at place low + r + x + 1
    place = low + np.arange(rows + width)[:, None]
    text = np.where((place >= 0) & (place < size), codes[np.clip(begin + place, 0, len(codes) - 1)].astype(np.int64), _NONE)
    at = np.arange(rows)[:, None]
    items = np.where(at < lengths, index.codes[np.minimum(index.starts[item] + at, len(index.codes) - 1)].astype(np.int64), _NONE)
    text, items = text.astype(np.int32), items.astype(np.int32)
    steps = np.arange(width, dtype=kind)[:, None]
    inner = bool(((low >= 0) & (low + rows + width - 1 <= size)).all())
    live, j = np.arange(n), low + np.arange(width)[:, None]
    row = np.where((j >= 0) & (j <= size), 0, far).astype(kind)
    for i in range(1, rows + 1):
        new = row + (text[i - 1:i - 1 + width] != items[i - 1])
        np.minimum(new[:-1], row[1:] + 1, out=new[:-1])
        if not inner:
            j = j + 1
            out = (j < 0) | (j > size[live])
            new[out] = far
            np.copyto(new, np.minimum(new, kind(i)), where=j == 0)
        new -= steps
        np.minimum.accumulate(new, axis=0, out=new)
        new += steps
        if not inner:
            new[out] = far
        row = new
        done = lengths[live] == i
        if done.any():
            ended, low_of = live[done], row[:, done]
            where = low_of.argmin(axis=0)
            best[ended] = low_of[where, np.arange(len(ended))]
            stop[ended] = low[ended] + i + where
        if done.any() or i % LOOK == 0:
            kept = ~done & (row.min(axis=0) <= budgets[live])
            if not kept.any():
                break
            if kept.sum() < 0.8 * len(kept):
                live, row, text, items = live[kept], row[:, kept], text[:, kept], items[:, kept]
                j = j[:, kept]
    return best, stop


def banded_distance(item: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int]:
    """``banded_distances`` of one item and text, without a budget."""
    index = ItemIndex([0], np.asarray(item), np.array([0]), np.array([len(item)]), *[np.array([])] * 4, np.array([0]), Q)
    one = [np.array([x]) for x in (0, 0, len(text), low)]
    best, stop = banded_distances(index, np.r_[np.asarray(text), 0], *one, high - low + 1, np.array([len(item) + 1]))
    return int(best[0]), int(stop[0])


def search(texts: list[str], index: ItemIndex, is_word: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """(text, item, edits, shared q-grams, from, to) of the best region for each
    text and item that match; from and to are places in the text."""
    codes, places, owner = normal_codes(texts, is_word)
    found: dict[tuple[int, int], tuple] = {}
    starts = np.searchsorted(owner, np.arange(len(texts) + 1))

    def take(doc: int, item: int, edits: int, shared: int, begin: int, end: int) -> None:
        if end > begin and ((doc, item) not in found or found[doc, item][0] > edits):
            found[doc, item] = (edits, shared, int(places[begin]), int(places[end - 1]) + 1)

    for item in index.short_items():
        pattern = index.item_codes(item)
        hits = np.flatnonzero(window_hash(codes, len(pattern)) == window_hash(pattern, len(pattern))[0])
        for h in hits:
            e = h + len(pattern)
            if (codes[h:e] == pattern).all() and (h == 0 or codes[h - 1] in (0, 32)) and codes[e] in (0, 32):
                take(int(owner[h]), item, 0, 1, int(h), int(e))
    for bands in _bands(codes, owner, index):
        for doc, item, edits, shared, begin, end in _verified(codes, starts, index, *bands):
            take(doc, item, edits, shared, begin, end)
    return [(doc, item, *v) for (doc, item), v in sorted(found.items())]


def _verified(codes: np.ndarray, starts: np.ndarray, index: ItemIndex, doc: np.ndarray, item: np.ndarray, shared: np.ndarray,
              low: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(text, item, edits, shared q-grams, first and last place) of the bands with an
    alignment within the budget, in the order given."""
    k, m = index.budgets[item], index.lengths[item]
    begin, end = starts[doc], starts[doc + 1] - 1
    # the band's diagonals, relative to the item, in the stretch it can reach
    first = low + index.starts[item] - k
    width = 2 * (k + 1) + 2 * k
    a, b = np.maximum(begin, first), np.minimum(end, first + width - 1 + m)
    edits, stop = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
    clipped = (a > first) | (b < first + width - 1 + m)
    order = np.lexsort((clipped, m, k))
    at = 0
    while at < len(order):
        # bands of one width; those that reach over an end of the text apart
        alike = (k[order[at:]] == k[order[at]]) & (clipped[order[at:]] == clipped[order[at]]) & (m[order[at:]] == m[order[at]])
        some = len(alike) if alike.all() else int(alike.argmin())
        some = min(some, max(1, CELLS // int(m[order[at]] + width[order[at]])))
        own = order[at:at + some]
        edits[own], stop[own] = banded_distances(index, codes, item[own], a[own], b[own], (first - a)[own], int(width[own[0]]), k[own])
        at += some
    for i in np.flatnonzero(edits <= k):
        yield (int(doc[i]), int(item[i]), int(edits[i]), int(shared[i]), int(max(a[i], a[i] + stop[i] - m[i])), int(a[i] + stop[i]))


def _bands(codes: np.ndarray, owner: np.ndarray, index: ItemIndex) -> Iterator[tuple[np.ndarray, ...]]:
    """(texts, items, shared q-grams, lowest diagonals) of the bands that reach the
    lemma's count, a group of items at a time. Diagonals are places in ``codes``
    minus places in the joined items."""
    if len(codes) < index.q or not len(index.grams):
        return
    hashes = window_hash(codes, index.q)
    maybe = np.flatnonzero(index.seen[hashes >> np.uint64(42)])
    i = np.minimum(np.searchsorted(index.grams, hashes[maybe]), len(index.grams) - 1)
    hit = index.grams[i] == hashes[maybe]
    by_gram = np.argsort(i[hit], kind="stable")
    at, gram = maybe[hit][by_gram], i[hit][by_gram]
    if not len(at):
        return
    # the places in items of each q-gram that the texts have, in the order of items
    grams, begin, seen = np.unique(gram, return_index=True, return_counts=True)
    places, which = _ranges(index.first[grams], index.first[grams + 1] - index.first[grams])
    place = index.at[places]
    item = np.searchsorted(index.starts, place, side="right") - 1
    order = np.argsort(item, kind="stable")
    place, item, which = place[order], item[order], which[order]
    ends = np.cumsum(seen[which])
    item_end = np.flatnonzero(np.r_[item[1:] != item[:-1], True]) + 1
    start = 0
    while start < len(item):
        before = ends[start - 1] if start else 0
        fits = item_end[(item_end > start) & (ends[item_end - 1] - before <= HITS)]
        stop = int(fits[-1]) if len(fits) else int(item_end[item_end > start][0])
        yield _counted(owner, index, at, begin, seen, which, place, item, ends, start, stop)
        start = stop


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of some ranges, one range after the other, and each one's range."""
    which = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[which], which


def _counted(owner, index, at, begin, seen, which, place, item, ends, start, stop) -> tuple[np.ndarray, ...]:
    """The bands of the places ``start:stop`` that reach the count. An item with more
    hits than ``HITS`` is counted in parts, whose counts are added."""
    parts = []
    while start < stop:
        before = ends[start - 1] if start else 0
        upto = min(stop, max(start + 1, int(np.searchsorted(ends, before + HITS, "right"))))
        hits, own = _ranges(begin[which[start:upto]], seen[which[start:upto]])
        own += start
        doc, of, diagonal = owner[at[hits]], item[own], at[hits] - place[own]
        band = diagonal // (index.budgets[of] + 1)
        parts.append(_summed(np.r_[doc, doc], np.r_[of, of], np.r_[band, band - 1], None))
        start = upto
    doc, of, band, count = parts[0] if len(parts) == 1 else _summed(*(np.concatenate(x) for x in zip(*parts)))
    k = index.budgets[of]
    enough = count >= index.lengths[of] - index.q + 1 - k * index.q
    return doc[enough], of[enough], count[enough], band[enough] * (k[enough] + 1)


def _summed(doc: np.ndarray, item: np.ndarray, band: np.ndarray, count: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """Counts by text, item and band, in their order."""
    order = np.lexsort((band, item, doc))
    doc, item, band = doc[order], item[order], band[order]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])])
    total = np.diff(np.r_[first, len(doc)]) if count is None else np.add.reduceat(count[order], first)
    return doc[first], item[first], band[first], total


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_id_col: str = "item_id", item_text_col: str = "text", q: int = Q, rate: float = EDIT_RATE,
            pass_chars: int = PASS_CHARS) -> DataFrame:
    """Documents that hold a benchmark item: one row for each document and item,
    (doc_id, item_id, edits, shared, start, end), of the best region.

    Null texts and items hold nothing; items without a letter or digit are never
    found, and items shorter than ``q`` characters only as they are. Repeated
    documents come back repeated, items with the same text all count. The items
    are looked for in passes of at most ``pass_chars`` characters (or one item).
    """
    small_batches(docs.sparkSession)
    items = benchmark.select(F.col(f"`{item_id_col}`").cast("string").alias("id"), F.col(f"`{item_text_col}`").alias("text")
                             ).filter("text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-chars // max(1, pass_chars // 2)))
    id_type = dict(benchmark.dtypes)[item_id_col]
    rows = docs.filter(F.col(f"`{text_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = None
    for part in range(passes):
        own = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == part) if passes > 1 else items
        part_rows = _one_pass(rows, [(r["id"], r["text"]) for r in own.collect()], q, rate)
        found = part_rows if found is None else found.unionByName(part_rows)
    return found.withColumn("item_id", F.col("item_id").cast(id_type))


def _one_pass(rows: DataFrame, items: list[tuple], q: int, rate: float) -> DataFrame:
    index = ItemIndex.build(items, q, rate)
    fields = list(ItemIndex.__dataclass_fields__)
    shared = rows.sparkSession.sparkContext.broadcast([getattr(index, f) for f in fields])
    kind = dict(rows.dtypes)["doc_id"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, is_word = ItemIndex(*shared.value), word_chars()
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            for i, j in chunks(texts, CHUNK):
                if hits := search(texts[i:j], own, is_word):
                    doc, item, *rest = zip(*hits)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array([i + d for d in doc])), pa.array([own.ids[x] for x in item], pa.string()),
                         *(pa.array(x, pa.int64()) for x in rest)],
                        ["doc_id", "item_id", "edits", "shared", "start", "end"])

    return rows.mapInArrow(task, f"doc_id {kind}, item_id string, edits long, shared long, start long, end long")


def without_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """Rows of ``docs`` whose text holds no benchmark item. Rows are told apart by
    id and text: a clean one stays whatever its id, null and repeated ids too.
    ``more``: parameters of ``matches``."""
    name = fresh(docs, "own")
    marked = docs.withColumn(name, row_key(docs, id_col, text_col))
    of = fresh(marked, "bad")
    bad = matches(marked, benchmark, name, text_col, **more).select(F.col("doc_id").alias(of)).distinct()
    return marked.join(bad, F.col(name) == F.col(of), "left_anti").drop(name)


def op8_decontam(spark, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, and where."""
    return matches(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

"""Near duplicates by SimHash, found through deletion variants.

A 64-bit fingerprint takes, for every bit, the majority over the hashes of a
text's word shingles. Fingerprints at most ``d`` bits apart are linked:

* the bits are cut into ``d // 2 + 1`` segments, so at least one segment of a
  linked pair differs in at most one bit (two bits in each would be over ``d``);
* every distinct fingerprint is indexed under its segment variants, one for
  each bit of the segment with that bit deleted, 64 keys in all;
* fingerprints that share a key meet in one sorted run and are verified by
  counting the differing bits.

A long run gives the edges of its own components (a star each) rather than all
its pairs, which keeps connectivity: two linked fingerprints always meet in
some run and get the same component there. A run longer than ``RUN``
fingerprints is passed on and compared block by block in a second stage, so
memory is bounded by two blocks and no candidate is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskwin.llm.batches import small_batches
from riskwin.llm.columns import fresh, row_key
from riskwin.llm.components import connected_components
from riskwin.session import checkpoint_root

#: Fingerprints compared at once; longer runs are cut into blocks of this size.
RUN = 2048
#: Runs up to this size give their verified pairs directly.
SMALL_RUN = 16
SEED = 42


def fingerprint(text: str | None, shingle: int = 4, seed: int = SEED) -> int:
    """SimHash of one text, as a signed 64-bit integer.

    ASCII letters are lower-cased and words are runs of anything but ASCII
    white space. Fewer words than ``shingle`` form one shingle; none (or a null
    text) gives zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(line, seed)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        hashes = [digest(line[a:b - 1], seed) for a, b in zip([0, *ends], ends[shingle - 1:])]
    bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big", signed=True)


def simhash(text: Column, shingle: int = 4) -> Column:
    """The fingerprint of a text column (long)."""
    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t if isinstance(t, str) else None, shingle) for t in texts],
                         dtype="int64")

    return fingerprints(text)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment: one of them differs in at most one
    bit between fingerprints at most ``max_bits`` apart."""
    n = max_bits // 2 + 1
    cuts = [round(i * 64 / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def variants(fp: Column, max_bits: int) -> Column:
    """Array of 64 keys: for every bit, its segment with the bit deleted.

    A key is hashed with the bit's place; a collision only adds a candidate."""
    keys = []
    for low, width in segments(max_bits):
        segment = ((1 << width) - 1) << low
        for bit in range(low, low + width):
            mask = _signed(segment & ~(1 << bit))
            keys.append(F.xxhash64(F.lit(bit), fp.bitwiseAND(F.lit(mask))))
    return F.array(*keys)


def stars(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges (first member, other member) of the components of some
    fingerprints; values is of unsigned 64-bit integers."""
    edges, rest = [], np.arange(len(values))
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        todo = [root]
        while todo and len(rest):
            near = np.bitwise_count(values[rest] ^ values[todo.pop()]) <= max_bits
            found, rest = rest[near], rest[~near]
            todo.extend(found)
            edges.extend((root, x) for x in found)
    return edges


def _edges_of_runs(max_bits: int, run: int) -> Callable:
    """Task over rows (key, fp) sorted by key: edges (a, b), and the members
    (key, fp) of keys with over ``run`` rows, marked ``long_run``."""
    def batch(a, b, long_run: bool) -> pa.RecordBatch:
        a, b = (np.asarray(x).view(np.int64) for x in (a, b))
        return pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(b), pa.array(np.full(len(a), long_run))], ["a", "b", "long_run"])

    def edges(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.array([], int)
        size = np.diff(np.r_[first, len(keys)])
        left = np.repeat(size, size) <= SMALL_RUN
        at = np.flatnonzero(left)
        for d in range(1, SMALL_RUN):
            at = at[at + d < len(keys)]
            at = at[keys[at] == keys[at + d]]
            if not len(at):
                break
            hit = at[np.bitwise_count(fps[at] ^ fps[at + d]) <= max_bits]
            if len(hit):
                yield batch(fps[hit], fps[hit + d], False)
        for i in np.flatnonzero(size > SMALL_RUN):
            own = fps[first[i]:first[i] + size[i]]
            if pairs := stars(own, max_bits):
                pairs = np.array(pairs)
                yield batch(own[pairs[:, 0]], own[pairs[:, 1]], False)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f = np.array([], np.int64), np.array([], np.uint64)
        passing = None  # the key of a long run that is being passed on
        for b in batches:
            keys = np.r_[held_k, b.column(0).to_numpy()]
            fps = np.r_[held_f, b.column(1).to_numpy().view(np.uint64)]
            if not len(keys):
                continue
            if passing is not None:
                n = int(np.searchsorted(keys != passing, True))
                if n:
                    yield batch(keys[:n], fps[:n], True)
                    keys, fps = keys[n:], fps[n:]
                if not len(keys):
                    held_k, held_f = keys, fps
                    continue
                passing = None
            last = int(np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])[-1])
            yield from bounded(keys[:last], fps[:last])
            held_k, held_f = keys[last:], fps[last:]
            if len(held_k) > run:
                passing = held_k[0]
                yield batch(held_k, held_f, True)
                held_k, held_f = held_k[:0], held_f[:0]
        yield from bounded(held_k, held_f)

    def bounded(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(keys):
            return
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[first, len(keys)])
        long = np.repeat(size > run, size)
        if long.any():
            yield batch(keys[long], fps[long], True)
            keys, fps = keys[~long], fps[~long]
        yield from edges(keys, fps)

    return task


def links(fps: DataFrame, max_bits: int, run: int = RUN) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of fingerprints at
    most ``max_bits`` apart. ``fps``: distinct longs in column ``fp``."""
    checkpoint_root(fps.sparkSession)
    keyed = fps.select(F.explode(variants(F.col("fp"), max_bits)).alias("key"), "fp")
    found = (
        keyed.repartition("key").sortWithinPartitions("key")
        .mapInArrow(_edges_of_runs(max_bits, run), "a long, b long, long_run boolean")
        .checkpoint()
    )
    edges = found.filter("not long_run").select("a", "b")
    over = found.filter("long_run").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    if over.isEmpty():
        return edges
    # long runs: every pair of blocks is one group of at most about ``run`` rows
    sized = over.join(over.groupBy("key").agg(F.ceil(F.count("*") * 3 / run).cast("int").alias("n")), "key")
    own = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    blocks = sized.withColumn("own", own).select(
        "key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    pairs = blocks.select("key", "fp", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))

    def block_edges(pdf: pd.DataFrame) -> pd.DataFrame:
        values = pdf["fp"].to_numpy().view(np.uint64)
        found = np.array(stars(values, max_bits) or np.empty((0, 2)), dtype=int)
        signed = values.view(np.int64)
        return pd.DataFrame({"a": signed[found[:, 0]], "b": signed[found[:, 1]]})

    return edges.unionByName(pairs.groupBy("key", "lo", "hi").applyInPandas(block_edges, "a long, b long"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 4, max_bits: int = 4, run: int = RUN) -> DataFrame:
    """Per row: ``doc_id`` (of ``id_col``), ``fp`` (long), ``component_id``.

    ``component_id`` is the smallest id that links lead to, the row's own
    included. A null text counts as empty; all texts without a word have the
    fingerprint zero and are linked like any other. A row with a null id gets
    the component of its fingerprint (null if no id is in it); repeated rows
    come back repeated; an empty table gives no rows.
    """
    checkpoint_root(docs.sparkSession)
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), simhash(F.col(f"`{text_col}`"), shingle).alias("fp")).checkpoint()
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = connected_components(links(fps.select("fp"), max_bits, run))
    grouped = (
        fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", F.coalesce("root", "fp").alias("root"), "least_id").checkpoint()
    )
    of_root = grouped.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = grouped.join(of_root, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                max_bits: int = 4) -> DataFrame:
    """One row of each near-duplicate group of ``docs``: that of the smallest id,
    then of the smallest hash of its text. Rows are told apart by id and text, so
    rows that share an id but are no near duplicates all stay, and so does one row
    of a group without an id; rows alike in both are one."""
    name = fresh(docs, "keep")
    marked = docs.withColumn(name, row_key(docs, id_col, text_col))
    groups = simhash_groups(marked, name, text_col, shingle, max_bits)
    first = groups.filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("times"))
    of = fresh(marked, "keep_of")
    once, again = (marked.join(first.filter(f"times {op} 1").select(F.col("doc_id").alias(of)), F.col(name) == F.col(of), "left_semi")
                   for op in "=>")
    return once.unionByName(again.dropDuplicates([name])).drop(name)


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    groups = simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=4, max_bits=4)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

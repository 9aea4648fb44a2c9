"""N-gram Jaccard join with a token-group matrix.

Texts are sets of word shingles; two are linked when ``per_cent`` of their union is
shared. Equal sets are one set. The others are joined in these steps:

* shingles are counted in a table of slots that tasks fill and Spark adds up, and
  every set is ordered from rare to frequent shingles. Sets that are linked share
  a token among the first of both, as many as the threshold leaves free to differ;
* sets that share such a token with the same first set are compared with it, and
  linked ones form the groups of similar sets. A frequent token's sets are first
  dealt out, each share with a first set of its own, and then these first sets;
* the token-group matrix lists, for each token, the groups that hold it. A set of
  a smaller group asks the groups of other components (in chunks of ``CHUNK`` sets)
  that hold so many of its first tokens that the rest could make up a link; a
  chunk is opened only where the set's overlap with the union of the chunk's sets
  reaches the threshold's share of the set.

Inside a group all sets are linked already, so one link is enough to join a set
and a group, and no group of copies is ever compared in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskwin.llm.batches import small_batches
from riskwin.llm.components import connected_components
from riskwin.session import checkpoint_root, scratch_path

SEED = 42
#: Sets of a chunk of a group, and queries that a chunk's copy is opened for.
CHUNK = 256
#: log2 of the slots that shingles are counted in, at most; it bounds what is
#: broadcast (a byte a slot) and only affects the order of tokens.
SLOT_BITS = 24
#: Shingles for each slot, where there are slots enough.
LOAD = 16
#: How frequent tokens are, in doublings above the usual count.
LEVELS = np.arange(16, dtype=np.uint64)
#: Slots of a piece of the table, and words remembered by a task.
PIECE = 1 << 16
WORDS = 1 << 18
#: Rows of a table that may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 400_000
#: Copies of a set from which its rows are not dealt out by the set.
HOT_COPIES = 10_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value


def shingle_set(text: str | None, words: dict, shingle: int = 5) -> np.ndarray:
    """Distinct hashes of the text's shingles, ascending. ASCII letters are
    lower-cased, words are runs of anything but ASCII white space; fewer words
    than ``shingle`` are one shingle, none (or a null text) give none."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.array([], np.uint64)
    if len(parts) < shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), SEED + len(parts))], np.uint64)
    h = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    n = len(h) - shingle + 1
    out = h[:n].copy()
    for i in range(1, shingle):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += h[i:i + n]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def least_shared(n: int, per_cent: int) -> int:
    """Tokens that a set of ``n`` shares with any set it is linked with."""
    return -(-per_cent * n // 100)


def linked(shared: int, a: int, b: int, per_cent: int) -> bool:
    return 100 * shared >= per_cent * (a + b - shared)


def slot_levels(docs: DataFrame, bits: int, shingle: int) -> np.ndarray:
    """How far above the usual count each slot is, in doublings (0 to 15), as a
    byte a slot. Counts are of all texts; one task's count of a slot is held at
    255, which only blurs the order of very frequent tokens."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table = _WordHashes(), np.zeros(1 << bits, np.uint32)
        for b in batches:
            for text in b.column(0):
                np.add.at(table, shingle_set(text.as_py(), words, shingle) >> np.uint64(64 - bits), 1)
        pack = zstandard.ZstdCompressor(level=1)
        for i in range(0, len(table), PIECE):
            piece = table[i:i + PIECE]
            if piece.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i // PIECE], pa.int32()), pa.array([pack.compress(np.minimum(piece, 255).astype(np.uint8).tobytes())])],
                    ["piece", "counts"])

    def add(t: pa.Table) -> pa.Table:
        unpack, total = zstandard.ZstdDecompressor(), None
        for c in t["counts"]:
            own = np.frombuffer(unpack.decompress(c.as_py()), np.uint8).astype(np.int64)
            total = own if total is None else total + own
        # a quarter of a doubling a step
        code = np.floor(4 * np.log2(total + 1)).astype(np.uint8)
        return pa.table({"piece": t["piece"][:1].cast(pa.int32()), "sum": pa.array([int(total.sum())]),
                         "codes": pa.array([zstandard.ZstdCompressor().compress(code.tobytes())], pa.binary())})

    parts = docs.select("text").mapInArrow(count, "piece int, counts binary")
    levels, total = np.zeros(1 << bits, np.uint8), 0
    for r in parts.groupBy("piece").applyInArrow(add, "piece int, sum long, codes binary").collect():
        own = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["codes"]), np.uint8)
        levels[r["piece"] * PIECE:r["piece"] * PIECE + len(own)] = own
        total += r["sum"]
    usual = 4 * np.log2(2 * total / (1 << bits) + 8)
    return np.clip(np.floor((levels - usual) / 4) + 1, 0, 15).astype(np.uint8)


def signatures(docs: DataFrame, levels, bits: int, shingle: int, per_cent: int) -> DataFrame:
    """(doc_id, th, n, h, prefix, starts): the set's size, hash and first tokens,
    rare ones first. The last four bits of a token say how frequent it is, its
    level; ``starts`` has for each level how many tokens of lower ones there are."""
    kind = dict(docs.dtypes)["doc_id"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table = _WordHashes(), levels.value
        for b in batches:
            sizes, hashes, prefixes, starts = [], [], [], []
            for text in b.column(2):
                s = shingle_set(text.as_py(), words, shingle)
                sizes.append(len(s))
                hashes.append(xxhash.xxh3_128_digest(s.tobytes(), SEED))
                level = table[s >> np.uint64(64 - bits)].astype(np.uint64)
                token = s & ~np.uint64(15) | level
                first = np.lexsort((token, level))[:len(s) - least_shared(len(s), per_cent) + 1] if len(s) else []
                prefixes.append(token[first].view(np.int64) if len(s) else np.array([], np.int64))
                starts.append(np.searchsorted(level[first], LEVELS) if len(s) else np.zeros(len(LEVELS), np.int64))
            ends = np.cumsum([0, *map(len, prefixes)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sizes, pa.int32()), pa.array(hashes, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.array([], np.int64), *prefixes]))),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(starts) + 1) * len(LEVELS), pa.int32()),
                                          pa.array(np.concatenate([np.array([], np.int64), *starts]), pa.int32()))],
                ["doc_id", "th", "n", "h", "prefix", "starts"])

    return docs.select("doc_id", "th", "text").mapInArrow(
        task, f"doc_id {kind}, th long, n int, h binary, prefix array<long>, starts array<int>").checkpoint()


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def set_table(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(sid, words): the sets of ``wanted`` (sid, doc_id, th), as 64-bit numbers."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHashes()
        for b in batches:
            if len(b):
                sets = [shingle_set(t.as_py(), words, shingle).tobytes() for t in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], ["sid", "words"])

    asked = _bounded(wanted.select("sid", F.col("doc_id").alias("of"), F.col("th").alias("hash")), wanted.count())
    texts = docs.join(asked, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("th") == F.col("hash")))
    sets = texts.select("sid", "text").mapInArrow(task, "sid long, words binary").checkpoint()
    # rows repeated with their id give a set more than once
    return sets if sets.groupBy("sid").count().filter("count > 1").isEmpty() else sets.dropDuplicates(["sid"]).checkpoint()


def _open(per_cent: int):
    """Task over rows (grp, block, is_query, sid, words), a group's members before
    its queries: edges (a, b) of queries and the first member they are linked with."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, union = None, [], None
        for batch in batches:
            out = []
            grp, block, query, sid = (batch.column(i).to_pylist() for i in range(4))
            for i, words in enumerate(batch.column(4)):
                own = np.frombuffer(words.as_buffer(), np.uint64)
                if (grp[i], block[i]) != key:
                    key, members, union = (grp[i], block[i]), [], None
                if not query[i]:
                    members.append((sid[i], own))
                    continue
                if union is None:
                    union = members[0][1] if len(members) == 1 else np.unique(np.concatenate([m for _, m in members]))
                need = least_shared(len(own), per_cent)
                if len(np.intersect1d(own, union, assume_unique=True)) < need:
                    continue
                for other, theirs in members:
                    if len(theirs) * 100 < per_cent * len(own) or len(own) * 100 < per_cent * len(theirs):
                        continue
                    if linked(len(np.intersect1d(own, theirs, assume_unique=True)), len(own), len(theirs), per_cent):
                        out.append((sid[i], other))
                        break
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())],
                                                 ["a", "b"])

    return task


def opened(asked: DataFrame, members: DataFrame, texts: tuple[DataFrame, DataFrame], per_cent: int, shingle: int) -> DataFrame:
    """Edges (a, b) between queries and groups: ``asked`` (grp, sid), ``members``
    (grp, sid), a bounded number a group. A group that many ask is copied for
    every ``CHUNK`` of them or so. ``texts``: the rows and where a set's is."""
    docs, sources = texts
    used = asked.select("sid").unionByName(members.select("sid")).distinct()
    sets = set_table(docs, sources.join(used, "sid", "left_semi"), shingle)
    counts = asked.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("blocks"))
    queries = asked.join(counts, "grp").select("grp", F.pmod(F.xxhash64("sid"), "blocks").alias("block"), F.lit(True).alias("is_query"), "sid")
    copies = members.join(counts, "grp").select(
        "grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("is_query"), "sid")
    rows = queries.unionByName(copies).join(sets, "sid").select("grp", "block", "is_query", "sid", "words")
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "is_query").mapInArrow(
        _open(per_cent), "a long, b long").checkpoint()


def first_pairs(reps: DataFrame, per_cent: int) -> tuple[DataFrame, DataFrame]:
    """(shared, pairs): rows (token, sid, n, far, front) of tokens that several sets
    have, and the pairs (grp, sid) of a first set and others with one of its tokens.

    ``far`` is the largest set that one may be linked with whose first token in
    common is this one: the tokens before it are not shared, and at most the others
    are. ``front`` is how many rarer tokens the set has; the first set of a token
    has the fewest, so that of many texts around one passage it is the plainest."""
    # a token ``level`` doublings above the usual count is dealt into 2 ** level shares
    salt = F.expr("pmod(sid, cast(1 as bigint) << cast(token & 15 as int))").alias("salt")
    far = F.expr(f"cast((100L * n - {100 + per_cent}L * pos) div {per_cent} as int)").alias("far")
    front = F.expr("starts[cast(token & 15 as int)]").alias("front")
    tokens = reps.select("sid", "n", "starts", F.posexplode("prefix").alias("pos", "token")).select("token", salt, "sid", "n", far, front)
    share = "over (partition by token, salt)"
    rows = tokens.select("token", "sid", "n", "far", "front", F.expr(f"min({FIRST}) {share}").alias("hub"), F.expr(f"count(*) {share}").alias("k"))
    shared = rows.filter("k > 1 or token & 15 > 0").select(
        "token", "sid", "n", "far", "front", F.col("hub.sid").alias("grp"), F.col("hub.n").alias("m"), _near("hub").alias("near")).checkpoint()
    near = shared.filter("sid <> grp").select("grp", "sid", "m", "n", "near")
    hubs = shared.filter("sid = grp and token & 15 > 0").select(
        "sid", "n", "far", F.expr(f"min({FIRST}) over (partition by token)").alias("first"))
    return shared.select("token", "sid", "n", "far", "front"), _worth(near.unionByName(_stars(hubs)), per_cent)


#: What sets are ordered by where one is compared with the others.
FIRST = "struct(front, sid, n, far)"


def _near(first: str):
    """Whether a row's set and the set ``first`` may be linked if the token is the
    first one they share."""
    return (F.col("n") <= F.col(f"{first}.far")) & (F.col(f"{first}.n") <= F.col("far"))


def _stars(rows: DataFrame) -> DataFrame:
    """(grp, sid, m, n, near) of ``rows`` (sid, n, far, first)."""
    return rows.filter("sid <> first.sid").select(
        F.col("first.sid").alias("grp"), "sid", F.col("first.n").alias("m"), "n", _near("first").alias("near"))


def _enough(c, a, b, per_cent: int):
    """Whether sets of ``a`` and ``b`` tokens of which ``c`` first ones are shared
    may be linked: of one of them, all tokens it shares that are not among its
    first ones are among its last, which are under the threshold's part of it."""
    return c + F.greatest(a, b) * (per_cent / 100) >= (a + b) * (per_cent / (100 + per_cent)) - 1e-6


def _worth(rows: DataFrame, per_cent: int) -> DataFrame:
    """Pairs (grp, sid) of ``rows`` (grp, sid, m, n, near), one for each shared
    token, with a near one and with tokens enough for a link."""
    pairs = rows.groupBy("grp", "sid", "m", "n").agg(F.count(F.lit(1)).alias("c"), F.max("near").alias("near"))
    return pairs.filter(F.col("near") & _enough(F.col("c"), F.col("m"), F.col("n"), per_cent)).select("grp", "sid").checkpoint()


def _settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back. A checkpoint keeps the size
    that Spark guessed for its plan, the product of a join's sides; over the rounds of
    components that number grows to millions of digits, and planning takes minutes."""
    path = scratch_path(df.sparkSession, "links")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class _Components:
    """The components of all edges so far; ``add`` opens groups for more."""

    def __init__(self, docs: DataFrame, sources: DataFrame, per_cent: int, shingle: int):
        self.texts, self.per_cent, self.shingle = (docs, sources), per_cent, shingle
        self.edges = docs.sparkSession.createDataFrame([], "a long, b long")
        self.roots = self.edges.toDF("sid", "root")

    def add(self, asked: DataFrame, members: DataFrame) -> None:
        if asked.isEmpty():
            return
        found = opened(asked, members, self.texts, self.per_cent, self.shingle)
        if not found.isEmpty():
            self.edges = self.edges.unionByName(_settled(found))
            roots = _settled(connected_components(self.edges, BROADCAST_ROWS // 2).withColumnRenamed("node", "sid"))
            self.roots = _bounded(roots, roots.count())

    def label(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``comp``, the component of the set ``sid``."""
        return rows.join(self.roots, "sid", "left").withColumn("comp", F.coalesce("root", "sid")).drop("root")


def _alone(pairs: DataFrame) -> DataFrame:
    """Each group's name as its only member."""
    return pairs.select("grp", F.col("grp").alias("sid")).distinct()


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                   per_cent: int = 80, slot_bits: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    ``component_id`` is the smallest id that links lead to, the row's own included.
    A null text or one without a word has no shingle and is linked with nothing.
    Rows with a null id are linked like others (and get null if no id is in their
    component); repeated rows come back repeated; an empty table gives no rows.
    """
    spark = docs.sparkSession
    checkpoint_root(spark)
    small_batches(spark)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).withColumn("th", F.xxhash64("text"))
    if slot_bits is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        slot_bits = min(SLOT_BITS, max(16, int(size / 6 / LOAD).bit_length()))
    levels = spark.sparkContext.broadcast(slot_levels(rows, slot_bits, shingle))
    sigs = signatures(rows, levels, slot_bits, shingle, per_cent)
    reps = sigs.filter("n > 0").groupBy("h").agg(
        F.max("n").alias("n"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("doc_id", "th")).alias("src"), F.first(F.struct("prefix", "starts")).alias("first"))
    reps = reps.withColumn("sid", F.monotonically_increasing_id()).checkpoint()

    shared, pairs = first_pairs(reps.select("sid", "n", "first.prefix", "first.starts"), per_cent)
    groups = _Components(rows, reps.select("sid", "src.doc_id", "src.th"), per_cent, shingle)
    groups.add(pairs, _alone(pairs))

    # one set for each component that has a token, against the first of them
    seen = groups.label(shared).groupBy("token", "comp").agg(F.min(F.expr(FIRST)).alias("one"))
    stars = seen.select("one.*", F.expr("min(one) over (partition by token)").alias("first"))
    more = _worth(_stars(stars), per_cent).join(pairs, ["grp", "sid"], "left_anti")
    groups.add(more, _alone(more))

    # the matrix: tokens of several components, by chunks of their sets
    labels = groups.label(shared.select("sid").distinct())
    sized = labels.join(labels.groupBy("comp").agg(F.count(F.lit(1)).alias("size")), "comp")
    sized = sized.withColumn("chunk", F.pmod(F.xxhash64("sid"), F.ceil(F.col("size") / CHUNK))).select(
        "sid", "comp", "size", F.xxhash64("comp", "chunk").alias("grp")).checkpoint()
    held = shared.drop("front").join(_bounded(sized, sized.count()), "sid")
    several = held.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("token")
    held = held.join(several, "token").checkpoint()
    matrix = held.groupBy("token", "grp", "comp", "size").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("far").alias("reach"))
    asks = held.select("token", "sid", "n", "far", F.col("comp").alias("own"), F.col("size").alias("own_size"))
    smaller = (F.col("own_size") < F.col("size")) | ((F.col("own_size") == F.col("size")) & (F.col("own") < F.col("comp")))
    # pairs that may be linked if a token is the first one they share, then all their tokens
    near = (F.col("n") <= F.col("reach")) & (F.col("lo") <= F.col("far"))
    asked = asks.join(matrix, "token").filter(smaller & near).select("grp", "sid").distinct().checkpoint()
    # sizes that a set of the group with a link would have
    least, most = F.greatest("lo", F.col("n") * (per_cent / 100)), F.least("hi", F.col("n") * (100 / per_cent))
    asked = asked.join(asks.select("sid", "token", "n"), "sid").join(matrix.select("grp", "token", "lo", "hi"), ["grp", "token"]).groupBy(
        "grp", "sid", "n").agg(F.count(F.lit(1)).alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    c, n = F.col("c"), F.col("n")
    asked = asked.filter((least <= most + 1e-6) & (_enough(c, n, least, per_cent) | _enough(c, n, most, per_cent))).select("grp", "sid").checkpoint()
    members = sized.select("grp", "sid").join(asked.select("grp").distinct(), "grp", "left_semi")
    groups.add(asked, members)

    classes = groups.label(reps.select("h", "sid", "least", "copies"))
    least = classes.groupBy("comp").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "comp").select("h", "component_id", "copies").checkpoint()
    hot = classes.filter(F.col("copies") > HOT_COPIES).select("h", F.col("component_id").alias("hot_id"))
    parts = sigs.select("doc_id", "n", "h").join(_bounded(hot, hot.count()), "h", "left")
    # rows of a hot set have their class already and are dealt by a hash of their own
    own = F.when(F.col("hot_id").isNull(), F.col("h")).otherwise(F.concat("h", F.unhex(F.hex(F.xxhash64("doc_id")))))
    out = parts.withColumn("h", own).join(classes.select("h", "component_id"), "h", "left")
    alone = F.when(F.col("n") == 0, F.col("doc_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                      F.coalesce(alone, "hot_id", "component_id").alias("component_id"))


def op12_jaccard(spark, sf_dir: str) -> DataFrame:
    """Shingle count and near-duplicate component of every document."""
    return jaccard_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=5, per_cent=80)


JACCARD_SQL = r"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
t AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(id, root) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.id, e.b FROM r JOIN e ON r.root = e.a)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, c.root AS component_id
FROM s JOIN (SELECT id, min(root) AS root FROM r GROUP BY id) c ON c.id = s.doc_id"""

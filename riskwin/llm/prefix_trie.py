"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first turns; its key is a hash of the sequence,
got from running sums of hashed (depth, turn), so a long conversation is
numbered block by block. Totals over subtrees come from the forest of parent
edges:

* the weight ``w`` of a node, the number of turns of its members from its depth
  on, is the size of its subtree counted by members, and is known without any
  rollup; the heaviest node of a component is its top;
* the nodes with more than half of their component's weight form one path from
  the top down; its end is the component's centroid, and what remains when the
  centroid is taken out are parts of at most half the weight;
* the total of the centroid and the parts below it is added to every node on the
  path from the centroid to the top (and the centroid's weight taken off them),
  and the parts are split in turn.

Components of over ``LIMIT`` nodes are split by joins, all of them at once, in a
number of rounds that grows with the logarithm of the weight, however deep or
wide the trie is; smaller ones are finished in tasks, many at a time, by the same
rule. The part that a node falls into is read off the conversation it comes from:
the key of that conversation at the depth below the centroid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskwin.operators.index import dense_index
from riskwin.session import checkpoint_root

#: Nodes of a component that a task finishes.
LIMIT = 4_096
#: Turns of a block of a conversation, ids of a chunk of a list (a power of two).
BLOCK = 65_536
#: Rows of a table that may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Children from which a node's key is not used to deal rows out.
HOT_CHILDREN = 10_000
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_NODE = ["key", "d", "parent", "m", "n_convs", "n_children", "w", "own_leaf", "own_saved", "acc_leaf", "acc_saved"]


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def ordered_turns(raw: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv, pos, digest, bytes): turns numbered from 0 in each conversation, by
    turn (null first), those of the same turn by a hash of role and text. Rows
    without a conversation are left out; a null role or text is empty."""
    checkpoint_root(raw.sparkSession)
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = raw.filter(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        F.substring(F.sha2(content, 256), 1, 32).alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    return dense_index(rows, "turn", keys=["conv"], idx_col="pos").df.select("conv", "pos", "digest", "bytes").checkpoint()


def _running(turns: DataFrame) -> DataFrame:
    """``turns`` (conv, d from 1, ...) with ``key`` and ``parent``."""
    piece = F.sha2(F.concat(F.col("d").cast("string"), F.lit(":"), "digest"), 256)
    pieces = [F.conv(F.substring(piece, 8 * i + 1, 8), 16, 10).cast("long").alias(f"p{i}") for i in range(4)]
    blk = F.floor((F.col("d") - 1) / BLOCK).cast("long").alias("blk")
    rows = turns.select("conv", "d", "bytes", "len", blk, *pieces)
    totals = rows.groupBy("conv", "blk").agg(*[F.sum(f"p{i}").alias(f"t{i}") for i in range(4)])
    before = "partition by conv order by blk rows between unbounded preceding and 1 preceding"
    offsets = totals.select("conv", "blk", *[F.expr(f"coalesce(sum(t{i}) over ({before}), 0L)").alias(f"o{i}") for i in range(4)])
    upto = "partition by conv, blk order by d rows between unbounded preceding and current row"
    sums = rows.join(offsets, ["conv", "blk"]).select(
        "conv", "d", "bytes", "len", *[F.expr(f"o{i} + sum(p{i}) over ({upto})").alias(f"s{i}") for i in range(4)],
        *[f"p{i}" for i in range(4)])

    def key(depth: Column, values: list[Column]) -> Column:
        return F.unhex(F.substring(F.sha2(F.concat_ws(",", depth, *values), 256), 1, 32))

    own = key(F.col("d"), [F.col(f"s{i}") for i in range(4)])
    above = key(F.col("d") - 1, [F.col(f"s{i}") - F.col(f"p{i}") for i in range(4)])
    return sums.select("conv", "d", own.alias("key"), F.when(F.col("d") == 1, F.unhex(F.lit(""))).otherwise(above).alias("parent"),
                       "bytes", "len")


def paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, d, key, parent, bytes, len): every conversation's nodes, the root
    (d = 0, no parent) first. ``turns``: (conv, d, digest, bytes, len), d from 1;
    ``convs``: (conv, len), conversations without a turn included."""
    roots = convs.select("conv", F.lit(0).cast("long").alias("d"), F.unhex(F.lit("")).alias("key"),
                         F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("bytes"), "len")
    return roots.unionByName(_running(turns)).checkpoint()


def nodes_of(path: DataFrame) -> DataFrame:
    """A row for each node: members, smallest member, children and weight; all in
    one component, the root's."""
    nodes = path.groupBy("key", "d", "parent").agg(
        F.min("conv").alias("m"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("len") - F.col("d") + 1).alias("w"),
        F.max("bytes").alias("bytes"))
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    zero = F.lit(0).cast("long")
    return counted.select(
        "key", "d", "parent", "m", "n_convs", "n_children", "w", (F.col("n_children") == 0).cast("long").alias("own_leaf"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("own_saved"), zero.alias("acc_leaf"), zero.alias("acc_saved"),
        F.unhex(F.lit("")).alias("comp")).checkpoint()


def decompose(parent: np.ndarray, weight: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``own`` over each node's subtree, for the nodes of some
    components. ``parent``: index of the parent, -1 for a top; ``weight``: a
    subtree's weight, above the sum of its children's."""
    n = len(parent)
    up, w = parent.copy(), weight.astype(np.int64).copy()
    added, out = np.zeros_like(own), np.zeros_like(own)
    live, every = np.arange(n), np.arange(n)

    def tops() -> np.ndarray:
        top = np.where(up < 0, every, up)
        while True:
            ahead = top[top]
            if (ahead == top).all():
                return top
            top = ahead

    top = tops()
    while len(live):
        heavy = live[2 * w[live] > w[top[live]]]
        inner = np.zeros(n, bool)
        inner[up[heavy][up[heavy] >= 0]] = True
        centroid = heavy[~inner[heavy]]
        of_top = np.empty(n, np.int64)
        of_top[top[centroid]] = centroid
        of = of_top[top[heavy]]
        is_centroid = np.zeros(n, bool)
        is_centroid[centroid] = True
        child = live[(up[live] >= 0) & is_centroid[up[live]]]
        above = up[child]
        up[child] = -1
        up[centroid] = -1
        top = tops()
        part, total = np.zeros_like(own), np.zeros_like(own)
        np.add.at(part, top[live], own[live])
        np.add.at(total, above, part[child])
        total[centroid] += own[centroid]
        out[centroid] = added[centroid] + total[centroid]
        on_path = ~is_centroid[heavy]
        added[heavy[on_path]] += total[of[on_path]]
        w[heavy[on_path]] -= w[of[on_path]]
        live = live[~is_centroid[live]]
    return out


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole components, sorted by ``comp``: nodes with ``leaves`` and ``saved``."""
    def finished(t: pa.Table) -> Iterator[pa.RecordBatch]:
        comp, key = t["comp"].to_pylist(), t["key"].to_pylist()
        place = {k: i for i, k in enumerate(key)}
        parent = np.fromiter((i if (i := place.get(p, -1)) >= 0 and comp[i] == c else -1
                              for p, c in zip(t["parent"].to_pylist(), comp)), np.int64, len(key))
        own = np.stack([t["own_leaf"].to_numpy(), t["own_saved"].to_numpy()], axis=1)
        sums = decompose(parent, t["w"].to_numpy(), own)
        for i, name in enumerate(("leaves", "saved")):
            acc = t["acc_leaf" if i == 0 else "acc_saved"].to_numpy()
            t = t.append_column(name, pa.array(sums[:, i] + acc))
        yield from t.drop_columns(["comp"]).combine_chunks().to_batches()

    held: pa.Table | None = None
    for b in batches:
        if not len(b):
            continue
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        comp = held["comp"].to_pylist()
        last = len(comp) - 1
        while last and comp[last - 1] == comp[-1]:
            last -= 1
        if last:
            yield from finished(held.slice(0, last))
            held = held.slice(last)
    if held is not None:
        yield from finished(held)


def rollup(nodes: DataFrame, path: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``nodes`` with ``leaves`` and ``saved``, the sums of ``own_leaf`` and
    ``own_saved`` over each node's subtree."""
    live = nodes
    closed, small = [], []
    while True:
        sizes = live.groupBy("comp").agg(F.max("w").alias("total"), F.count(F.lit(1)).alias("size")).filter(
            F.col("size") > limit).drop("size").checkpoint()
        n = sizes.count()
        if not n:
            small.append(live)
            break
        marked = live.join(_bounded(sizes, n), "comp", "left")
        small.append(marked.filter("total is null").drop("total"))
        big = marked.filter("total is not null").withColumn("heavy", 2 * F.col("w") > F.col("total")).drop("total")
        ends = big.filter("heavy").groupBy("comp").agg(F.max_by(F.struct(
            F.col("key").alias("c_key"), F.col("d").alias("c_d"), F.col("w").alias("c_w")), "d").alias("c"))
        ends = ends.select("comp", "c.*", (F.col("c.c_d") + 1).alias("at")).checkpoint()
        big = big.join(_bounded(ends, n), "comp").withColumn("seg", F.floor(F.col("d") / BLOCK))
        wanted = big.filter("d > c_d").select("m", "seg", "comp", "at", "c_key").distinct()
        level = path.select(F.col("conv").alias("m"), F.col("d").alias("at"), F.col("key").alias("part"), F.col("parent").alias("of"))
        level = level.join(_bounded(ends.select("at").distinct(), n), "at", "left_semi")
        found = wanted.join(level, ["m", "at"]).filter(F.col("of") == F.col("c_key")).select("m", "seg", "comp", "part")
        below = F.when(F.col("d") > F.col("c_d"), F.col("part"))
        split = big.join(found, ["m", "seg", "comp"], "left").withColumn("part", below).checkpoint()
        is_centroid = F.col("key") == F.col("c_key")
        totals = split.filter(F.col("part").isNotNull() | is_centroid).groupBy("comp").agg(
            F.sum("own_leaf").alias("t_leaf"), F.sum("own_saved").alias("t_saved"))
        summed = split.join(_bounded(totals, n), "comp")
        closed.append(summed.filter(is_centroid).select(
            *_NODE, (F.col("acc_leaf") + F.col("t_leaf")).alias("leaves"), (F.col("acc_saved") + F.col("t_saved")).alias("saved")))
        on = F.col("heavy")
        changed = {"w": F.col("w") - F.when(on, F.col("c_w")).otherwise(0),
                   "acc_leaf": F.col("acc_leaf") + F.when(on, F.col("t_leaf")).otherwise(0),
                   "acc_saved": F.col("acc_saved") + F.when(on, F.col("t_saved")).otherwise(0)}
        live = summed.filter(~is_centroid).select(
            *[changed[c].alias(c) if c in changed else F.col(c) for c in _NODE], F.coalesce("part", "comp").alias("comp")).checkpoint()
    rest = small[0].select("comp", *_NODE)
    for more in small[1:]:
        rest = rest.unionByName(more.select("comp", *_NODE))
    kinds = dict(rest.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in _NODE] + ["leaves long", "saved long"])
    out = rest.repartition("comp").sortWithinPartitions("comp").mapInArrow(_finish, schema)
    for c in closed:
        out = out.unionByName(c)
    return out.drop("own_leaf", "own_saved", "acc_leaf", "acc_saved", "w")


def _digest_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by key and number: SHA-256 of each key's joined list."""
    key, state = None, None
    for b in batches:
        done = []
        for k, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if k != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.binary()), pa.array([x for _, x in done], pa.string())],
                                         ["key", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])


def list_digests(rows: DataFrame, block_bits: int = 16) -> DataFrame:
    """(key, ends_sha256): hash of each key's ids (distinct), ascending and joined
    by commas. Lists are joined in chunks of ``2 ** block_bits`` numbers; a list
    of several chunks is hashed as a stream, for SHA-256 has no other way."""
    chunks = rows.groupBy("key", F.shiftright("conv", block_bits).alias("no")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string"))).alias("ids"))
    counts = chunks.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.first("ids").alias("ids")).checkpoint()
    one = counts.filter("k = 1").select("key", F.sha2("ids", 256).alias("ends_sha256"))
    long_lists = counts.filter("k > 1").select("key")
    if long_lists.isEmpty():
        return one
    many = chunks.join(long_lists, "key", "left_semi").repartition("key").sortWithinPartitions("key", "no")
    return one.unionByName(many.select("key", "ids").mapInArrow(_digest_lists, "key binary, ends_sha256 string"))


def prefix_trie(turns: DataFrame, convs: DataFrame, limit: int = LIMIT, block_bits: int = 16) -> DataFrame:
    """One row for each node of the trie of conversations.

    ``turns``: (conv, d, digest, bytes, len), turn ``d`` (from 1) of conversations
    of ``len`` turns; ``convs``: (conv, len), every conversation once. Returns
    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens (bytes that sharing the node and those
    below saves) and ends_sha256 (of the ids of the conversations that end
    there). Without conversations there is no root: no rows.
    """
    path = paths(turns, convs)
    nodes = nodes_of(path)
    summed = rollup(nodes, path, limit)
    ends = list_digests(path.filter("d = len").select("key", "conv"), block_bits)
    hot = nodes.filter(F.col("n_children") > HOT_CHILDREN).select(F.col("key").alias("parent"), F.col("m").alias("hot"))
    summed = summed.join(_bounded(hot, hot.count()), "parent", "left")
    # children of a hot node have their parent already and are dealt by their own key
    asked = F.when(F.col("hot").isNull(), F.col("parent")).otherwise(F.concat("key", F.unhex(F.lit("00"))))
    own = nodes.select(F.col("key").alias("asked"), F.col("m").alias("found"))
    out = summed.withColumn("asked", asked).join(own, "asked", "left").join(ends, "key", "left")
    return out.select(
        F.col("m").alias("conv_id"), F.col("d").alias("depth"), F.coalesce("hot", "found").alias("parent_conv_id"), "n_convs",
        "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256"))


def rebuilt(turns: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(turns, convs) for ``prefix_trie``: conversation c takes the first h turns
    of conversation c - c % ``family`` (all if fewer, none if it isn't there), then
    its own after its first h; h is crc32(c in decimal) % ``most``."""
    n = turns.groupBy("conv").agg(F.max("pos").alias("n")).withColumn("n", F.col("n") + 1)
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    base = n.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    convs = n.withColumn("h", h).withColumn("base", F.col("conv") - F.col("conv") % family).join(base, "base", "left")
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = convs.select("conv", "base", "n", "h", taken.alias("taken"),
                         (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")).checkpoint()
    blocks = convs.select("conv", "taken", "len", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / BLOCK))).alias("blk"))
    own = turns.filter(F.col("pos") >= h).withColumn("blk", F.floor(F.col("pos") / BLOCK)).join(blocks, ["conv", "blk"]).select(
        "conv", (F.col("taken") + F.col("pos") - h + 1).alias("d"), "digest", "bytes", "len")
    lent = turns.filter(F.col("pos") < most - 1).select(F.col("conv").alias("base"), "pos", "digest", "bytes")
    first = convs.filter("taken > 0").select("conv", "base", "taken", "len").join(lent, "base").filter("pos < taken").select(
        "conv", (F.col("pos") + 1).alias("d"), "digest", "bytes", "len")
    return own.unionByName(first), convs.select("conv", "len")


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    turns, convs = rebuilt(ordered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return prefix_trie(turns, convs)


# crc32 by bits: a byte is mixed in, then eight steps shift it through
_CRC = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
  lambda x: [CAST(unicode(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""

TRIE_SQL = f"""WITH t0 AS (
  SELECT conv_id AS c, turn, coalesce(text, '') AS text, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS dig
  FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT c, text, dig, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, dig) - 1 AS pos FROM t0),
n AS (SELECT c, count(*) AS n, {_CRC} % 9 AS h, c - c % 5 AS b FROM t GROUP BY c),
v AS (SELECT n.*, least(n.h, coalesce(o.n, 0)) AS taken, least(n.h, coalesce(o.n, 0)) + greatest(n.n - n.h, 0) AS len
  FROM n LEFT JOIN n o ON o.c = n.b),
r AS (
  SELECT v.c, pos + 1 AS d, dig, text, len FROM v JOIN t ON t.c = v.b AND pos < taken
  UNION ALL SELECT v.c, taken + pos - h + 1, dig, text, len FROM v JOIN t ON t.c = v.c AND pos >= h),
p AS (
  SELECT c, d, string_agg(dig, '') OVER (PARTITION BY c ORDER BY d) AS seq, strlen(text) AS bytes, len FROM r
  UNION ALL SELECT c, 0, '', 0, len FROM v),
k AS (SELECT c, d, sha256(seq) AS k, lag(sha256(seq)) OVER (PARTITION BY c ORDER BY d) AS up, bytes, len FROM p),
g AS (SELECT k, d, any_value(up) AS up, min(c) AS m, count(*) AS n_convs, any_value(bytes) AS bytes,
  sha256(coalesce(string_agg(CASE WHEN d = len THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS sha FROM k GROUP BY k, d),
ch AS (SELECT up AS k, count(*) AS n_children FROM g WHERE up IS NOT NULL GROUP BY up),
f AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN ch USING (k)),
s AS (SELECT k.k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum((n_convs - 1) * f.bytes) AS saved
  FROM f JOIN k ON k.c = f.m AND k.d <= f.d GROUP BY k.k)
SELECT f.m AS conv_id, CAST(f.d AS BIGINT) AS depth, u.m AS parent_conv_id, f.n_convs, CAST(f.n_children AS BIGINT) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, f.sha AS ends_sha256
FROM f JOIN s USING (k) LEFT JOIN f u ON u.k = f.up"""

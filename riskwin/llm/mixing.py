"""Mixing sources to target weights by temperature.

The weight of a source is its share of the tokens to the power of an exponent
between 0 (all sources alike) and 1 (as they come), normalised. The exponent is
bisected, many points at a time, until the weights meet a target entropy, and
raised where a source would be repeated more often than a limit allows.

The weights are realised with a budget of tokens: a source gives whole
permutations of its documents (one an epoch) until its part of the budget is
used, and the places of its tokens are spread evenly over blocks. Every block
so holds the sources in their weights, and is itself a permutation.

Everything is DataFrame operations; running sums go through chunks of the
permutation's key, so no source is ever in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskwin.llm.columns import columns
from riskwin.session import checkpoint_root

SEED = 17
#: Where the target entropy lies between that of the natural shares (0) and
#: that of equal weights (1).
FLATTEN = 0.5
#: Times that a source's documents may be used on average.
MAX_REPEATS = 3.0
#: Tokens of a block.
BLOCK_TOKENS = 250_000
#: Rows of a chunk of a source's permutation, on average.
CHUNK_ROWS = 2_000
#: Points tried in a round of the bisection, and rounds: 32 ** 10 = 2 ** 50.
POINTS, ROUNDS = 32, 10


def tokens_of(text: Column) -> Column:
    """Words of a text (null: none)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r]+")), F.lit(0)).cast("long")


def _document_classes(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """Rows equal in id, source and text as one row with their number ``n``."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
        F.md5(text.cast("binary")).alias("digest"), tokens_of(text).alias("tokens"),
    ).groupBy("doc_id", "source", "digest", "tokens").agg(F.count("*").alias("n"))


def _meet(totals: DataFrame, column: Column, target: float, lo: float = 0.0, hi: float = 1.0) -> float:
    """Largest exponent whose ``column`` (falling with the exponent) is at least
    the target, to within (hi - lo) / POINTS ** ROUNDS. ``totals``: share ``p``."""
    for _ in range(ROUNDS):
        step = (hi - lo) / POINTS
        tried = totals.select(
            "p", F.explode(F.sequence(F.lit(0), F.lit(POINTS - 1))).alias("i")
        ).withColumn("t", F.lit(lo) + F.col("i") * F.lit(step))
        power = F.pow("p", F.col("t"))
        met = (
            tried.groupBy("i").agg(F.sum(power).alias("z"), F.sum(power * F.log("p")).alias("plogp"),
                                   F.max(F.pow("p", F.col("t") - 1)).alias("most"), F.first("t").alias("t"))
            .filter(column >= F.lit(target)).agg(F.max("i")).first()[0]
        )
        lo = lo + (met or 0) * step
        hi = lo + step
    return lo


def exponent(totals: DataFrame, budget: int, total: int, flatten: float, max_repeats: float) -> float:
    """Exponent for per-source ``tokens`` (all above 0)."""
    shares = totals.select((F.col("tokens") / F.lit(float(total))).alias("p")).checkpoint()
    natural, sources = shares.agg(F.sum(-F.col("p") * F.log("p")), F.count("*")).first()
    target = natural + flatten * (math.log(sources) - natural)
    entropy = F.log("z") - F.col("t") * F.col("plogp") / F.col("z")
    by_entropy = _meet(shares, entropy, target)
    # used max p ** (t - 1) / z times the budget over the total; falls with t
    repeats = F.col("most") / F.col("z") * F.lit(budget / total)
    limit = _meet(shares, repeats, max_repeats) if budget <= max_repeats * total else 1.0
    return max(by_entropy, limit)


def mix(docs: DataFrame, budget: int | None = None, flatten: float = FLATTEN, max_repeats: float = MAX_REPEATS,
        block_tokens: int = BLOCK_TOKENS, seed: int = SEED, id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mixture's documents in order: ``block``, ``slot`` in the block,
    ``doc_id``, ``source``, ``epoch``, ``tokens``, ``digest`` (MD5 of the text)
    and ``n`` (rows of ``docs`` equal to this one in id, source and text).

    ``budget``: tokens of the mixture (default: those of ``docs``). A null
    source is a source of its own; a null text has no token. Sources without a
    token take no part, since no weight reaches them; documents without one
    come along with their source. An empty table gives no rows.
    """
    checkpoint_root(docs.sparkSession)
    classes = _document_classes(docs, id_col, source_col, text_col).checkpoint()
    totals = classes.groupBy("source").agg(
        F.sum(F.col("tokens") * F.col("n")).alias("tokens"), F.sum("n").alias("rows")).filter("tokens > 0").checkpoint()
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    budget = total if budget is None else budget
    t = exponent(totals, budget, total, flatten, max_repeats) if total else 1.0
    power = F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(t))
    z = totals.agg(F.sum(power)).first()[0] or 1.0
    quotas = totals.select(
        F.col("source").alias("of"), F.col("tokens").alias("source_tokens"),
        F.least(F.round(power / F.lit(z) * F.lit(budget)).cast("long"),
                F.floor(F.col("tokens") * F.lit(max_repeats))).alias("quota"),
        F.ceil(F.col("rows") / CHUNK_ROWS).alias("chunks"),
    ).filter("quota > 0")
    n_blocks = max(1, -(-budget // block_tokens))

    # a row for every document and epoch of its source
    epochs = F.explode(F.expr("sequence(0L, (quota - 1) div source_tokens)"))
    used = classes.join(quotas, F.col("source").eqNullSafe(F.col("of"))).withColumn("epoch", epochs)
    used = used.withColumn("copy", F.explode(F.expr("sequence(0L, n - 1)")))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), "epoch", "copy",
                            F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest").cast("binary"))
    used = used.withColumn("key", key).withColumn(
        "chunk", F.expr("cast(conv(substr(key, 1, 7), 16, 10) as long) * chunks div 268435456"))
    own = ["of", "epoch", "chunk"]
    so_far = Window.partitionBy("of", "epoch").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    firsts = used.groupBy(*own).agg(F.sum("tokens").alias("s")).select(
        *[F.col(c).alias(f"{c}_") for c in own], F.coalesce(F.sum("s").over(so_far), F.lit(0)).alias("first"))
    in_chunk = Window.partitionBy(*own).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    placed = used.withColumn("before", F.coalesce(F.sum("tokens").over(in_chunk), F.lit(0))).join(
        firsts, F.col("of").eqNullSafe(F.col("of_")) & (F.col("epoch") == F.col("epoch_")) & (F.col("chunk") == F.col("chunk_")))
    placed = placed.withColumn("place", F.expr("epoch * source_tokens + first + before"))
    kept = placed.filter(F.col("place") + F.col("tokens") <= F.col("quota"))
    kept = kept.withColumn("block", F.least(F.expr(f"place * {n_blocks}L div quota"), F.lit(n_blocks - 1)).cast("long"))
    order = Window.partitionBy("block").orderBy(F.md5(F.concat_ws(":", F.lit(str(seed + 1)), "key").cast("binary")))
    return kept.select("block", (F.row_number().over(order) - 1).cast("long").alias("slot"),
                       "doc_id", "source", "epoch", "tokens", "digest", "n")


def mixed_documents(docs: DataFrame, mixture: DataFrame, id_col: str = "doc_id", source_col: str = "source",
                    text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` as often as the mixture has them. Of rows equal in id,
    source and text each gets its part of the copies, the rest in the order of
    the other columns."""
    times = mixture.groupBy("doc_id", "source", "digest").agg(F.count("*").alias("times"), F.first("n").alias("n"))
    digest = F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary"))
    rows = docs.select(F.struct(*columns(docs)).alias("row"), F.col(f"`{id_col}`").alias("id"),
                       F.col(f"`{source_col}`").alias("of"), digest.alias("md5"))
    joined = rows.join(times, F.col("id").eqNullSafe(F.col("doc_id")) & F.col("of").eqNullSafe(F.col("source"))
                       & (F.col("md5") == F.col("digest")))
    order = Window.partitionBy("id", "of", "md5").orderBy(
        *[F.col("row").getField(c) for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"])
    rest = F.when(F.row_number().over(order) <= F.expr("times % n"), 1).otherwise(0)
    single = joined.filter("n = 1").select("row", "times")
    repeated = joined.filter("n > 1").select("row", (F.expr("times div n") + rest).alias("times"))
    return single.unionByName(repeated).filter("times > 0").select(
        "row", F.explode(F.expr("sequence(1L, cast(times as long))"))).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns])


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    """The documents table mixed: half-way to equal weights, at most three uses."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("n")


def mixing_sql() -> str:
    """The same mixture in SQL: plain bisection, running sums over a source."""
    def meet(name: str, value: str, target: str) -> str:
        return f"""{name}(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN {value} >= {target} THEN mid ELSE lo END, CASE WHEN {value} >= {target} THEN hi ELSE mid END
  FROM (SELECT *, (lo + hi) / 2 AS mid FROM {name} WHERE i < 60) b, natural_shares)"""

    z = "list_sum(list_transform(ps, lambda p: pow(p, mid)))"
    plogp = "list_sum(list_transform(ps, lambda p: pow(p, mid) * ln(p)))"
    most = "list_max(list_transform(ps, lambda p: pow(p, mid - 1)))"
    key = f"md5(concat_ws(':', '{SEED}', epoch, copy, coalesce(CAST(doc_id AS VARCHAR), ''), digest))"
    return f"""WITH RECURSIVE classes AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r]+')) AS tokens,
    row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, ''))) - 1 AS copy
  FROM documents),
totals AS (SELECT source AS of, CAST(sum(tokens) AS BIGINT) AS source_tokens FROM classes GROUP BY source HAVING sum(tokens) > 0),
natural_shares AS (
  SELECT list(source_tokens / total) AS ps, any_value(total) AS total,
    sum(-(source_tokens / total) * ln(source_tokens / total)) AS least_entropy, ln(count(*)) AS flat
  FROM totals, (SELECT CAST(sum(source_tokens) AS DOUBLE) AS total FROM totals) s),
{meet("by_entropy", f"ln({z}) - mid * {plogp} / {z}", f"least_entropy + {FLATTEN} * (flat - least_entropy)")},
{meet("by_repeats", f"{most} / {z}", str(MAX_REPEATS))},
chosen AS (SELECT greatest((SELECT lo FROM by_entropy WHERE i = 60), (SELECT lo FROM by_repeats WHERE i = 60)) AS t),
powers AS (SELECT of, source_tokens, pow(source_tokens / total, t) AS w, total FROM totals, natural_shares, chosen),
quotas AS (
  SELECT of, source_tokens,
    least(CAST(round(w / (SELECT sum(w) FROM powers) * total) AS BIGINT), CAST(floor(source_tokens * {MAX_REPEATS}) AS BIGINT)) AS quota,
    CAST(greatest(1, ceil(total / {BLOCK_TOKENS})) AS BIGINT) AS n_blocks
  FROM powers),
used AS (
  SELECT c.*, q.*, unnest(range(0, (quota - 1) // source_tokens + 1)) AS epoch
  FROM classes c JOIN quotas q ON c.source IS NOT DISTINCT FROM q.of WHERE quota > 0),
keyed AS (SELECT *, {key} AS key FROM used),
placed AS (
  SELECT *, epoch * source_tokens + CAST(coalesce(sum(tokens) OVER (
    PARTITION BY of, epoch ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
  FROM keyed),
kept AS (SELECT *, least(place * n_blocks // quota, n_blocks - 1) AS block FROM placed WHERE place + tokens <= quota)
SELECT block, row_number() OVER (PARTITION BY block ORDER BY md5(concat_ws(':', '{SEED + 1}', key))) - 1 AS slot,
  doc_id, source, epoch, tokens, digest
FROM kept"""

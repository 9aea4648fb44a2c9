"""Language identification with bit-sliced Bloom filters over character n-grams.

All languages share one table of bit masks: bit ``l`` of every slot belongs to
language ``l``'s Bloom filter, so one lookup (the AND of ``HASHES`` slots)
returns the set of all languages that hold an n-gram. For a text, the masks'
bits are counted per language, each count is corrected for the share of false
positives that the filter's fill predicts, and the largest count decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskwin.llm.batches import small_batches
from riskwin.llm.columns import columns, fresh

#: Characters of an n-gram; words are padded with one space.
GRAM = 4
HASHES = 3
#: Odd multipliers of the slot hashes (fixed values).
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: Different texts of a language that a model is fitted on, at most about (a
#: hash sample within the language; all, if fewer).
FIT_ROWS = 20_000
#: n-grams that a language's filter holds at most, the most frequent first.
CAPACITY = 65_536
#: log2 of the table's slots.
SLOT_BITS = 20
#: n-grams seen less often in the fitted rows of a language are left out.
MIN_COUNT = 3
#: A language with few n-grams in all keeps rarer ones: once seen below this
#: number, twice below its double, and so on up to ``MIN_COUNT``.
FEW_GRAMS = 500
#: A language holds an n-gram if its rate there is at least this part of the
#: rate in the language where it is most frequent.
MIN_SHARE = 0.1
UNDETERMINED = "und"
#: Characters that a task handles at once.
CHUNK = 250_000

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normal(text: str) -> str:
    """Lower-cased words of letters, one space around each; "" without a letter."""
    if not any(map(str.isalpha, text)):
        return ""
    return f" {_NOT_LETTERS.sub(' ', text.lower()).strip()} "


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams of some normalised texts, and the index of the text
    each belongs to."""
    joined = "\0".join(texts) + "\0"
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n = len(chars) - GRAM + 1
    if n <= 0:
        return np.array([], np.uint64), np.array([], np.int64)
    end = chars == 0
    owner = (np.cumsum(end) - end)[:n]
    codes, crosses = chars[:n].copy(), end[:n].copy()
    for k in range(1, GRAM):
        codes *= np.uint64(0x100000001B3)
        codes += chars[k:n + k]
        crosses |= end[k:n + k]
    return codes[~crosses], owner[~crosses]


@dataclass
class LanguageFilters:
    """``table``: a mask per slot, one row for each 64 languages."""

    languages: list[str]
    table: np.ndarray
    false_positive: np.ndarray

    @classmethod
    def build(cls, languages: list[str], codes: list[np.ndarray], slot_bits: int = SLOT_BITS) -> "LanguageFilters":
        """Filters that hold ``codes[l]`` for language ``l``."""
        width = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64)
                     if len(languages) <= 8 * np.dtype(t).itemsize or t is np.uint64)
        rows = -(-max(1, len(languages)) // 64)
        table = np.zeros((rows, 1 << slot_bits), width)
        fill = []
        for i, own in enumerate(codes):
            bit = width(1 << (i % 64))
            slots = _slots(own, slot_bits)
            for s in slots:
                table[i // 64, s] |= bit
            fill.append(np.count_nonzero(table[i // 64] & bit) / table.shape[1])
        return cls(languages, table, np.array(fill) ** HASHES)

    def counts(self, codes: np.ndarray, owner: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of each text, and how many of them each language holds,
        corrected for false positives."""
        total = np.bincount(owner, minlength=n_texts).astype(float)
        held = np.zeros((n_texts, len(self.languages)))
        slots = _slots(codes, int(np.log2(self.table.shape[1])))
        for row in range(self.table.shape[0]):
            mask = self.table[row][slots[0]]
            for s in slots[1:]:
                mask &= self.table[row][s]
            for i in range(64 * row, min(64 * row + 64, len(self.languages))):
                has = (mask >> mask.dtype.type(i % 64)) & mask.dtype.type(1)
                held[:, i] = np.bincount(owner, weights=has, minlength=n_texts)
        false = self.false_positive
        return total, np.clip((held - total[:, None] * false) / (1 - false), 0, total[:, None])

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """(language, score, share of n-grams it holds) of each text. The score
        is the best count over the sum of the best two."""
        return [x[:3] for x in self.judge(texts)]

    def judge(self, texts: list[str | None]) -> list[tuple[str, float, float, int]]:
        """``predict``'s values and the number of n-grams of each text."""
        plain = [normal(t) if isinstance(t, str) else "" for t in texts]
        if not self.languages:
            return [(UNDETERMINED, 0.0, 0.0, max(0, len(p) - GRAM + 1)) for p in plain]
        total, held = self.counts(*grams(plain), len(plain))
        best = np.argmax(held, axis=1)
        top = np.sort(held, axis=1)[:, ::-1]
        second = top[:, 1] if top.shape[1] > 1 else np.zeros(len(plain))
        score = np.divide(top[:, 0], top[:, 0] + second, out=np.zeros(len(plain)), where=top[:, 0] > 0)
        share = np.divide(top[:, 0], total, out=np.zeros(len(plain)), where=total > 0)
        return [(self.languages[b], float(s), float(h), int(n)) if p else (UNDETERMINED, 0.0, 0.0, 0)
                for p, b, s, h, n in zip(plain, best, score, share, total)]


def _slots(codes: np.ndarray, slot_bits: int) -> list[np.ndarray]:
    shift = np.uint64(64 - slot_bits)
    mixed = codes ^ (codes >> np.uint64(29))
    return [(mixed * np.uint64(m)) >> shift for m in MULTIPLIERS[:HASHES]]


def hash_sample(df: DataFrame, bound: int, *cols: str) -> DataFrame:
    """About ``bound`` rows of ``df`` (all, if fewer), chosen by a hash of ``cols``."""
    n = df.count()
    if n <= bound:
        return df
    share = F.pmod(F.xxhash64(*cols, F.lit(1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return df.filter(share < F.lit(bound / n))


def sample_by_language(known: DataFrame, bound: int) -> DataFrame:
    """The rows of about ``bound`` different texts of each language (all, if
    fewer), chosen by a hash of the text: no language is crowded out by larger
    ones, nor by copies of its own texts."""
    sizes = known.groupBy("lang").agg(F.count_distinct(F.xxhash64("text")).alias("texts"))
    share = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return known.join(F.broadcast(sizes), "lang").filter(share < F.lit(float(bound)) / F.col("texts")).select("text", "lang")


def chunks(texts: list, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of texts with about ``size`` characters."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t) if isinstance(t, str) else 0
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS, capacity: int = CAPACITY,
        min_count: int = MIN_COUNT, min_share: float = MIN_SHARE) -> LanguageFilters:
    """Filters learned from ``text`` and ``lang`` (both non-null) of ``rows``.

    Every language is learned, from about ``fit_rows`` different texts of its own.
    n-grams are counted in tasks and summed by Spark; the driver gets at most
    ``capacity`` codes a language. No row gives a model without languages."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, langs = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), dtype=object)
            for i, j in chunks(texts):
                codes, owner = grams([normal(t) for t in texts[i:j]])
                names = langs[i:j]
                for lang in sorted(set(names)):
                    found, n = np.unique(codes[(names == lang)[owner]], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)),
                         pa.array(n.astype(np.int64))], ["lang", "code", "n"])

    small_batches(rows.sparkSession)
    known = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    sample = sample_by_language(known, fit_rows)
    counted = sample.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    rates = counted.join(totals, "lang").withColumn("rate", F.col("n") / F.col("total"))
    most = rates.groupBy("code").agg(F.max("rate").alias("most"))
    enough = F.least(F.lit(min_count), 1 + F.floor(F.col("total") / FEW_GRAMS))
    held = rates.join(most, "code").filter((F.col("n") >= enough) & (F.col("rate") >= min_share * F.col("most")))
    ranked = (
        held.groupBy("lang", "n").agg(F.count("*").alias("k")).withColumn(
            "above", F.expr("sum(k) over (partition by lang order by n desc)"))
        .filter(F.col("above") <= capacity).groupBy("lang").agg(F.min("n").alias("least"))
    )
    kept = held.join(ranked, "lang").filter("n >= least").select("lang", "code").toPandas()
    languages = sorted(kept["lang"].unique())
    return LanguageFilters.build(
        languages, [kept.loc[kept["lang"] == x, "code"].to_numpy().astype(np.int64).view(np.uint64) for x in languages])


def identify(df: DataFrame, model: LanguageFilters, text_col: str = "text", grams_too: bool = False) -> DataFrame:
    """``df`` with ``lang_pred``, ``lang_score`` and ``lang_share`` (columns that
    have these names already are replaced); ``grams_too`` adds ``lang_grams``,
    the n-grams of the text.

    A text that is null or has no letter gets ``und`` and zeros; so does every
    text if the model knows no language. One whose n-grams no language holds
    gets the first language with score 0; one of a single letter has no n-gram
    and gets the same, though nothing speaks against it."""
    names = ("lang_pred", "lang_score", "lang_share", *(("lang_grams",) if grams_too else ()))
    shared = df.sparkSession.sparkContext.broadcast((model.languages, model.table, model.false_positive))

    @F.pandas_udf("lang_pred string, lang_score double, lang_share double" + (", lang_grams long" if grams_too else ""))
    def predict(texts: pd.Series) -> pd.DataFrame:
        own, filters = list(texts), LanguageFilters(*shared.value)
        found = [x[:len(names)] for i, j in chunks(own) for x in filters.judge(own[i:j])]
        return pd.DataFrame(found, columns=list(names))

    kept, name = columns(df, names), fresh(df, "language")
    return df.select(*kept, predict(F.col(f"`{text_col}`")).alias(name)).select(*kept, f"{name}.*")


def held_out() -> Column:
    """Whether a row is left out of the fit: crc32 of the id's text mod 3 is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op2_langid(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = fit(rows.filter("not held_out"))
    return identify(rows.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), F.col("lang_share").alias("share"))

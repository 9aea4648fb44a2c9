"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: compatibility forms decomposed (mathematical and
full-width letters), accents away, lower case, look-alike letters of other scripts
to Latin ones, digits and signs that stand for letters to these (not in words
without a letter, as numbers), invisible characters away. The lexicon holds word beginnings with
weights; exception phrases (a term with the word before or after it that is
harmless) take the weight of the term inside them back. The sum of the weights
is normalised by the text's length and a logistic curve gives the score.

Lexicon, exceptions and curve are learned from labelled rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskwin.llm.batches import small_batches
from riskwin.llm.columns import columns, fresh
from riskwin.llm.langid import hash_sample

#: Labelled rows that the lexicon and the curve are fitted on, at most about.
FIT_ROWS = 20_000
#: Lexicon terms and exception phrases, at most.
MAX_TERMS = 2_000
MAX_EXCEPTIONS = 500
#: Word beginnings that may become terms have this many characters, or are a
#: whole word.
PREFIXES = range(4, 11)
#: A term is in this share of the toxic rows, at least (in different contexts:
#: copies of a text have the same contexts and count once).
MIN_TOXIC_SHARE = 0.01
#: A term weighs the lower confidence bound of its log odds, so many standard
#: errors below the estimate, and this at least. Rare terms have wide bounds, so
#: there is no least count, and small tables learn too.
ERRORS, MIN_WEIGHT = 1.5, 1.5
#: Words at which a text counts as of usual length.
USUAL_WORDS = 200

# Characters folded, by what they stand for.
HOMOGLYPHS = {
    "a": "аαɑ@4", "b": "Ьв8", "c": "сϲ", "d": "ԁ", "e": "еєε3", "g": "ɡ9", "h": "һ",
    "i": "іιı1!|", "j": "ј", "k": "кκ", "l": "ӏ", "m": "м", "n": "ո", "o": "оοσ0", "p": "рρ",
    "q": "ԛ", "s": "ѕ5$", "t": "тτ7+", "u": "υս", "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγ",
    "z": "ᴢ2",
}
INVISIBLE = "­​‌‍⁠﻿"
#: Signs that end a word; others inside words stay.
BREAKS = ".,;:?\"'()[]{}<>/\\*%&#=~^_-`\t\n\r\x0b\x0c…–—“”‘’«»¡¿·"


BREAK_TABLE = {ord(c): " " for c in BREAKS} | {ord(c): None for c in INVISIBLE}
FOLD_TABLE = {ord(c): to for to, cs in HOMOGLYPHS.items() for c in cs}
_MARKS = re.compile("[\u0300-\u036f]")
#: Words of digits and signs only.
_NUMBERS = re.compile(r"(?<!\S)[0-9@$!|+]+(?!\S)")


def fold(text: str | None) -> str:
    """Folded words of a text, one space around each; " " for none."""
    text = text or ""
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    text = text.lower().translate(BREAK_TABLE)
    parts, at = [], 0
    for number in _NUMBERS.finditer(text):
        parts += [text[at:number.start()].translate(FOLD_TABLE), number[0]]
        at = number.end()
    words = "".join([*parts, text[at:].translate(FOLD_TABLE)]).split()
    return f" {' '.join(words)} " if words else " "


@dataclass
class ToxicityModel:
    """``weights``: log odds of folded terms. ``exceptions``: folded phrases.
    ``slope`` and ``offset``: of the logistic curve over the normalised sum."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    slope: float = 1.0
    offset: float = -2.0

    def automaton(self) -> "ahocorasick.Automaton":
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(" " + term, (len(term) + 1, weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, None))
        if len(found):
            found.make_automaton()
        return found


def matches(folded: str, automaton) -> tuple[list[tuple[int, int, float]], int]:
    """(start, end, weight) of the longest term at each word that is not inside
    an exception phrase, and the number of matches taken back."""
    terms: dict[int, tuple[int, float]] = {}
    shields = []
    if len(automaton):
        for last, (size, weight) in automaton.iter(folded):
            start = last - size + 1
            if weight is None:
                shields.append((start, last))
            elif start not in terms or size > terms[start][0]:
                terms[start] = (size, weight)
    kept, at = [], 0
    shields.sort()
    reach = -1
    for start in sorted(terms):
        while at < len(shields) and shields[at][0] <= start:
            reach = max(reach, shields[at][1])
            at += 1
        if start >= reach:
            kept.append((start + 1, start + terms[start][0], terms[start][1]))
    return kept, len(terms) - len(kept)


def normalised(folded: str, automaton) -> float:
    """Sum of the weights over a factor that grows with the logarithm of the
    text's length."""
    found, _ = matches(folded, automaton)
    if not found:
        return 0.0
    words = folded.count(" ") - 1
    return sum(w for _, _, w in found) / (1 + math.log1p(words / USUAL_WORDS))


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0.05) and offset of a ridge-penalised logistic fit to
    points that count ``n`` times."""
    a, b = 1.0, -2.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w, g = n * (p * (1 - p) + 1e-9), n * (p - y)
        grad = np.array([(g * x).sum() + 0.1 * a, g.sum() + 0.01 * b])
        hess = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(hess, grad)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 0.05), float(b)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, toxic) to rows (term, context, clean, toxic) for word
    beginnings and whole words (these end with a space): the clean and toxic
    rows that hold a term, under context -1, and one row for each context of a
    term in toxic rows, a hash of the words before and after it."""
    for b in batches:
        rows, contexts = (Counter(), Counter()), set()
        for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            words = fold(text).split()
            rows[label].update({t for w in set(words) for t in _terms(w)})
            if label:
                for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                    context = zlib.crc32(f"{before} {after}".encode())
                    contexts.update((t, context) for t in _terms(word))
        terms = list(rows[0].keys() | rows[1].keys())
        yield pa.RecordBatch.from_arrays([
            pa.array([*terms, *(t for t, _ in contexts)], pa.string()),
            pa.array([-1] * len(terms) + [c for _, c in contexts], pa.int64()),
            *(pa.array([n[t] for t in terms] + [0] * len(contexts), pa.int64()) for n in rows)],
            ["term", "context", "clean", "toxic"])


def _terms(word: str) -> list[str]:
    return [*(word[:k] for k in PREFIXES if k <= len(word)), word + " "]


def log_odds(toxic: float, clean: float, n_toxic: int, n_clean: int) -> float:
    """Lower confidence bound of the log odds."""
    odds = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
    return odds - ERRORS * math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def _bound(n_toxic: int, n_clean: int, side: float) -> Column:
    """``side`` * the log odds of columns ``toxic`` and ``clean``, less the errors."""
    t, c = F.col("toxic") + 0.5, F.col("clean") + 0.5
    return F.lit(side) * (F.log(t / (n_toxic + 1)) - F.log(c / (n_clean + 1))) - F.lit(ERRORS) * F.sqrt(1 / t + 1 / c)


def choose_terms(counted: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Weights of terms from (term, clean, toxic): a longer term is left out if
    a beginning of it weighs about as much."""
    weights: dict[str, float] = {}
    for term, clean, toxic in sorted(counted, key=lambda r: (len(r[0]), r[0])):
        weight = log_odds(toxic, clean, n_toxic, n_clean)
        above = max((weights[term[:k]] for k in range(1, len(term)) if term[:k] in weights), default=None)
        if weight >= MIN_WEIGHT and (above is None or weight > above + 1.5):
            weights[term] = weight
    return weights


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS, exceptions: list[str] = (), id_col: str | None = None) -> ToxicityModel:
    """Model learned from ``text`` and ``toxic`` (0 or 1; other rows and null
    texts are left out) of about ``fit_rows`` rows. Without toxic rows no term
    is learned and all scores are low. ``exceptions`` are added to those found.
    With ``id_col`` rows are sampled by id and text, so that copies of a text aren't
    all in or all out; nothing is learned from the ids."""
    small_batches(rows.sparkSession)
    known = rows.filter(F.col("toxic").isin(0, 1) & F.col("text").isNotNull()).select(
        "text", F.col("toxic").cast("int").alias("toxic"), *([F.col(f"`{id_col}`").alias("_id")] if id_col else []))
    sample = hash_sample(known, fit_rows, "text", *(["_id"] if id_col else [])).select("text", "toxic")
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = n.get(0, 0), n.get(1, 0)
    if not n_toxic:
        return ToxicityModel({}, [fold(e).strip() for e in exceptions])
    counted = (
        sample.mapInArrow(_term_counts, "term string, context long, clean long, toxic long")
        .groupBy("term", "context").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .groupBy("term").agg(F.sum("clean").alias("clean"),
                             F.least(F.sum("toxic"), F.count_if(F.col("context") >= 0)).alias("toxic"))
        .filter(F.col("toxic") >= MIN_TOXIC_SHARE * n_toxic)
        .withColumn("odds", _bound(n_toxic, n_clean, 1.0))
        .filter(F.col("odds") >= MIN_WEIGHT)
        .orderBy(F.desc(F.col("odds") * F.col("toxic")), "term").limit(MAX_TERMS)
    )
    weights = choose_terms([(r["term"], r["clean"], r["toxic"]) for r in counted.collect()], n_toxic, n_clean)
    model = ToxicityModel(weights, [fold(e).strip() for e in exceptions])

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for b in batches:
            out = []
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                folded, found = fold(text), set()
                for start, _, _ in matches(folded, automaton)[0]:
                    before, after = folded[:start].rsplit(None, 1)[-1:], folded[start:].split(None, 2)[:2]
                    found.add(" ".join(after) if len(after) > 1 else "")
                    found.add(" ".join([*before, after[0]]) if before else "")
                out.extend((p, toxic) for p in found - {""})
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in out], pa.string()), pa.array([t for _, t in out], pa.int32())], ["phrase", "toxic"])

    harmless = (
        sample.mapInArrow(phrases, "phrase string, toxic int").groupBy("phrase")
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
        .filter(_bound(n_toxic, n_clean, -1.0) > 0)
        .orderBy(F.desc("clean"), "phrase").limit(MAX_EXCEPTIONS)
    )
    model.exceptions += [r["phrase"] for r in harmless.collect()]

    def features(texts: pd.Series) -> pd.Series:
        automaton = model.automaton()
        return pd.Series([normalised(fold(t), automaton) for t in texts], dtype=float)

    # the curve has two numbers; it is fitted on the rows' rounded sums, counted
    sums = sample.select(F.round(F.pandas_udf(features, "double")("text"), 3).alias("x"), "toxic")
    points = sums.groupBy("x", "toxic").agg(F.count("*").alias("n")).toPandas()
    model.slope, model.offset = logistic(*(points[c].to_numpy().astype(float) for c in ("x", "toxic", "n")))
    return model


def score_text(text: str | None, model: ToxicityModel, automaton) -> float:
    x = model.slope * normalised(fold(text), automaton) + model.offset
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def score(df: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``df`` with ``toxicity`` (0 to 1) and ``toxic_terms`` (matches counted);
    columns that have these names already are replaced.

    A null or empty text scores like one without a match."""
    parts = (model.weights, model.exceptions, model.slope, model.offset)

    @F.pandas_udf("toxicity double, toxic_terms long")
    def scored(texts: pd.Series) -> pd.DataFrame:
        own = ToxicityModel(*parts)
        automaton = own.automaton()
        rows = []
        for t in texts:
            t = t if isinstance(t, str) else None
            rows.append((score_text(t, own, automaton), len(matches(fold(t), automaton)[0])))
        return pd.DataFrame(rows, columns=["toxicity", "toxic_terms"])

    kept, name = columns(df, ("toxicity", "toxic_terms")), fresh(df, "scored")
    return df.select(*kept, scored(F.col(f"`{text_col}`")).alias(name)).select(*kept, f"{name}.*")


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a lexicon learned from the labels of the
    rows that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").filter("toxic is not null")
    model = fit(docs.filter(~out).join(labels, "doc_id"), id_col="doc_id")
    scored = score(docs.select("doc_id", out.alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", F.col("toxicity").alias("score"),
                         F.when(F.col("toxicity") >= 0.5, 1).otherwise(0).alias("predicted"), "toxic_terms")

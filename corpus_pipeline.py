"""Corpus pipeline: filters, deduplicates, cleans, mixes and shards documents.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``docs``. ``run(spark, sf_dir)``
applies them to the documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskwin.llm import decontam, langid, mixing, sharding, simhash
from riskwin.llm.columns import columns
from riskwin.session import scratch_path

#: Least share of a text's n-grams that its language must hold. Texts of a known
#: language are above 0.45, most above 0.95.
MIN_LANGUAGE_SHARE = 0.25
#: Places of the last stage.
SHARDS = 40


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter and texts in no known language go; a text of a
    single letter has no n-gram to judge and stays. The filters are learned from
    the rows that ``langid.held_out`` leaves; with none, no language is known and
    nothing can be judged, so all stay."""
    model = langid.fit(docs.filter(~langid.held_out()).select("text", "lang"))
    if not model.languages:
        return docs
    seen = langid.identify(docs.select(F.struct(*columns(docs)).alias("row"), "text"), model, grams_too=True)
    known = (F.col("lang_share") >= MIN_LANGUAGE_SHARE) | (F.col("lang_grams") == 0)
    kept = seen.filter((F.col("lang_pred") != langid.UNDETERMINED) & known)
    return kept.select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.one_of_each(docs, shingle=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.without_items(docs, benchmark)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the temperature mixture has them."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows shuffled into shards: the columns of ``docs``, shard and slot."""
    return sharding.shuffle_to_shards(docs, SHARDS)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mix_sources),
    ("sharding", shard),
]

#: The stages learn models and hash with XXH64, which SQL can't express;
#: tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Corpus pipeline over ``documents``: language ID, near-duplicate removal,
benchmark decontamination, PII surrogates, source mixing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet and read again as the next one's docs. All but the
last return the columns of ``docs``. Null and empty texts, repeated rows, ties, empty tables and
columns with clashing names are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateprofile.llm import decontaminate, langid, mixing, pii, simhash
from rateprofile.llm.common import materialise, ship, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go: no letters, or too far from every language. It learns from
    all labelled documents; for the limits each text is held against centroids without itself."""
    ship(spark)
    model = langid.fit(docs)
    return langid.predict(docs, model).filter(~F.col("rejected")).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group stays."""
    ship(spark)
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    ship(spark)
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("hits") == 0).select("row.*")


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities are replaced; ``n_chars`` follows the new text where it was there."""
    ship(spark)
    got = pii.anonymise(docs)
    new = {"text": F.col("text"), "n_chars": F.when(F.size("entities") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))}
    return got.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as training blocks: ``shard``, ``place`` (order in the shard), ``source``, ``block``, ``doc_ids``,
    ``n_words``, ``text``."""
    ship(spark)
    return mixing.Mix(docs, keep_text=True).blocks()


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_surrogates", pii_surrogates),
    ("source_mix", source_mix),
]
#: SQL has no k-means, XXH64 or keyed surrogates: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

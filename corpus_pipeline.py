"""From raw documents to packed training sequences.

Each stage gets what the one before it kept, as a table, and all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from tallyroad.llm import langid, mixing, packing, secrets, simhash
from tallyroad.llm.common import small_batches, stored, table
from tallyroad.llm.queries import language_rows, vocabulary

# How much of each domain's expected tokens stays.
KEEP = {"clean": 1.0, "low": 0.4, "toxic": 0.1}
# Words that each of two generations of a packing worker remembers.
CACHE_WORDS = 150_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is not recognised."""
    small_batches(spark)
    return langid.accepted(docs, langid.fit(docs, language_rows()))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    small_batches(spark)
    return simhash.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts; every document stays."""
    small_batches(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Thins out low-quality and toxic documents to their target weights;
    every document that is labelled clean or most likely clean stays."""
    labels = table(spark, sf_dir, "labels")
    labelled = mixing.labelled_ids(labels, mixing.label_domain())
    clean = mixing.domain_ids(labels, mixing.label_domain()).where("domain = 'clean'")
    keep = [KEEP[d] for d in mixing.DOMAINS]
    return mixing.resample(docs, labelled, mixing.DOMAINS, keep, spared="clean", spared_ids=clean)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens, one row per piece of a document."""
    small_batches(spark)
    # Workers of other stages keep their models in memory beside it.
    encoder = functools.partial(packing.worker_encoder, cache_words=CACHE_WORDS)
    return packing.pack(docs, vocabulary(), encoder=encoder)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

# Trained models and tokenizers have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training-corpus pipeline over ``documents``: five stages, each one operator of
``flumen.llm``. A stage takes all that its predecessor kept and returns the columns
of ``documents`` (the last: what the encoder returns)."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from flumen.llm import bpe, decontaminate, langid, simhash, suffixdedup  # noqa: E402
from flumen.llm.common import written  # noqa: E402
from flumen.sources.tables import load  # noqa: E402


#: A repeated passage in words: 400 bytes alone would leave most of 51 to 62 words.
PASSAGE = suffixdedup.Settings(length=51, anchor=12, unit="words")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language (``und``) go. The others stay, with the
    predicted language where they had none."""
    found = langid.identify(docs, langid.learn_fold(docs)).where(F.col("lang_pred") != langid.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (four-word shingles, 4 bits)."""
    return simhash.keep_one(docs)


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes, and runs of more than 50 words however short, that repeat among
    these documents leave their texts; every document stays, and n_chars follows its text."""
    found = suffixdedup.deduplicated(docs, "doc_id", "text", suffixdedup.Settings(), PASSAGE)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark").select("item_id", "text"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    ids = bpe.encoded(docs.select("doc_id", "lang", "source", "text"))
    return ids.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [("language", language), ("near_dedup", near_dedup), ("repeated_text", repeated_text),
          ("decontaminated", decontaminated), ("encode", encode)]

#: SQL cannot state byte suffixes, fingerprints or merges; tests/llm has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

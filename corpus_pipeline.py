"""From raw documents to token ids.

Five stages over ``documents``: quality rules drop junk, of near-duplicates the first
stays, documents with a benchmark passage go, secrets are masked, and what is left is
encoded. Each stage is one of the library's operators, gets all that its predecessor
kept, and returns the columns of ``documents``; the last adds ``ids``, the token ids.

Stages are written as Parquet to the shared folder and reread, so a lost executor costs
at most part of one stage. A stage's result must be written before the next stage is asked for:
then the tables that it rested on are dropped. NULL and empty texts fail the quality rules; an empty table
passes through all stages; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paywarden.llm import bpe, decontam, neardup, rules, secrets
from paywarden.llm.common import drop, owned, stash, table

TOKENIZER = "byte_bpe_50k.json"


# Tables that the result of the stage asked for last rests on.
_TABLES: list[str] = []


def _stage(run: Callable) -> Callable:
    """Drop what the stage before has left, and note what this one makes."""

    @wraps(run)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop(spark, _TABLES)
        with owned(_TABLES):
            return run(spark, docs, sf_dir)

    return call


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in their language's perplexity band."""
    return rules.clean(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return neardup.unique(docs)


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


@_stage
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked and ``n_chars`` brought up to date."""
    return secrets.clean(docs).withColumn("n_chars", F.length("text").cast("long"))


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids."""
    return bpe.encode(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", mask_secrets),
    ("bpe", encode),
]

# Perplexity bands and token ids have no SQL; the tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), name)
    drop(spark, _TABLES)
    return docs

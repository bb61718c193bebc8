"""Duplicate job: find repeated transactions, store their copies, summarise."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden.operators.duplicates import (
    duplicate_ids,
    duplicate_records,
    multiplicity,
    summarise_multiplicity,
)
from paywarden.schema import TRANSACTION_SCHEMA
from paywarden.sinks.writers import write_if_any
from paywarden.sources.readers import read_transactions


@dataclass(frozen=True)
class DuplicateRun:
    """``rows`` holds the parsed input, ``counts`` how often each key occurs, ``records`` the copies."""

    output: str
    key: str = "transaction_id"

    @property
    def rows(self) -> str:
        return f"{self.output.rstrip('/')}/rows"

    @property
    def counts(self) -> str:
        return f"{self.output.rstrip('/')}/key_counts"

    @property
    def records(self) -> str:
        return f"{self.output.rstrip('/')}/duplicates"

    def read_counts(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType(
            [
                T.StructField(self.key, TRANSACTION_SCHEMA[self.key].dataType),
                T.StructField("repeated", T.BooleanType()),
                T.StructField("ids", T.LongType()),
                T.StructField("records", T.LongType()),
            ]
        )
        return spark.read.schema(schema).parquet(self.counts)

    def read_records(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(TRANSACTION_SCHEMA).parquet(self.records)


def run_duplicates(spark: SparkSession, path: str, run: DuplicateRun) -> DataFrame:
    """Store all copies of repeated keys and return the summary row.

    The text is parsed once; counts and copies come from the Parquet that this leaves,
    where the counts read one column. Without duplicates an earlier result stays.
    """
    read_transactions(spark, path).write.mode("overwrite").parquet(run.rows)
    rows = spark.read.schema(TRANSACTION_SCHEMA).parquet(run.rows)
    multiplicity(rows, run.key).write.mode("overwrite").parquet(run.counts)
    counts = run.read_counts(spark)
    repeated = counts.filter(F.col("repeated") & F.col(run.key).isNotNull())
    write_if_any(duplicate_records(rows, repeated, run.key), run.records, evidence=repeated)
    return summarise_multiplicity(counts, run.key)


def stored_ids(
    df: DataFrame, path: str, key: str = "transaction_id", null_safe: bool = False
) -> DataFrame:
    """The repeated keys of ``df``, written to ``path`` and read back, so that their size is known."""
    found = duplicate_ids(df if null_safe else df.filter(F.col(key).isNotNull()), key)
    found.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(found.schema).parquet(path)

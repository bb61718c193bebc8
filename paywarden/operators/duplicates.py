"""Duplicate transactions: repeated keys, all their copies, one survivor, summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def duplicate_ids(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Keys held by more than one row, with their count. NULLs form one group."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("record_count"))
        .filter(F.col("record_count") > 1)
    )


def multiplicity(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Repeated keys one by one, plus a single row for all keys held once.

    Small next to the input unless most keys repeat, and enough to answer both
    "which keys repeat" and the summary, so the input is counted once. Columns:
    key, ``repeated``, ``ids``, ``records``.
    """
    counted = df.groupBy(key).agg(F.count("*").alias("records"))
    repeated = F.col("records") > 1
    return (
        counted.select(
            F.when(repeated, F.col(key)).alias(key), repeated.alias("repeated"), "records"
        )
        .groupBy(key, "repeated")
        .agg(F.count("*").alias("ids"), F.sum("records").alias("records"))
    )


def summarise_multiplicity(counted: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Total, unique, duplicate records and duplicate ids from ``multiplicity``.

    A NULL key counts as a repeated id but its rows are not duplicate records,
    because NULL matches nothing in the join that extracts the copies.
    """

    def added(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    repeated = F.col("repeated")
    return counted.agg(
        added(F.col("records")).alias("total_records"),
        added(F.col("ids")).alias("unique_records"),
        added(F.when(repeated & F.col(key).isNotNull(), F.col("records"))).alias(
            "duplicate_records"
        ),
        added(F.when(repeated, F.col("ids"))).alias("duplicate_transaction_ids"),
    )


def duplicate_summary(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """The four duplicate counts as one row, from one scan."""
    counted = df.groupBy(key).agg(F.count("*").alias("records"))
    return summarise_multiplicity(
        counted.withColumns({"repeated": F.col("records") > 1, "ids": F.lit(1)}), key
    )


def duplicate_records(
    df: DataFrame, ids: DataFrame, key: str = "transaction_id", null_safe: bool = False
) -> DataFrame:
    """All rows of ``df`` whose key is listed in ``ids`` (unique keys).

    ``ids`` should be a stored table: Spark then knows its size before planning
    and broadcasts it only below ``autoBroadcastJoinThreshold``, leaving the
    big side unshuffled. Above that both sides shuffle by key straight into the
    join, the form in which adaptive execution splits an oversized key.
    """
    if not null_safe:
        return df.join(ids.select(key), key, "left_semi")
    listed = ids.select(F.col(key).alias("_listed"))
    return df.join(listed, F.col(key).eqNullSafe(F.col("_listed")), "left_semi")


def dedupe(
    df: DataFrame,
    keys: Sequence[str] = ("transaction_id",),
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """One row per key, the first by ``order_by`` (default: all columns).

    Each task keeps only its own first row per key before the shuffle, so a key
    held by many rows sends at most one row per task. Rows equal in every
    ordering column are interchangeable only if ``order_by`` covers all columns.
    """
    order = list(order_by) if order_by else [c for c in df.columns if c not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")

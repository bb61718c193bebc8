"""Sinks: partitioned and flat Parquet, conditional overwrite, tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden.operators.fraud import flat_velocity
from paywarden.schema import DATE_PARTS, DAY_OF_TABLE, EVENT_TIME, TABLE_DAY
from paywarden.sources.readers import read_table


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for the writes of a micro-batch.

    Streaming queries run in a session with it switched off, and ``balanced`` has
    no effect without it. The micro-batch itself is planned by then.
    """
    with _set(spark, "spark.sql.adaptive.enabled", "true"):
        yield


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def balanced(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of one output partition brought together, oversized ones split.

    Adaptive execution sizes the pieces, so a day with most of the rows is
    written by many tasks and a quiet day by one, without a file per task and day.
    """
    return df.hint("rebalance", *(F.col(name) for name in by))


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] = DATE_PARTS,
    mode: str = "append",
    rebalance: bool = True,
    coalesce_to: int | None = None,
) -> None:
    """Parquet under ``path`` in one directory level per column of ``by``.

    ``coalesce_to`` caps the number of writers for small outputs only.
    """
    if coalesce_to is not None:
        df = df.coalesce(coalesce_to)
    elif rebalance:
        df = balanced(df, by)
    # Overwrite replaces everything under the path, whatever the session default.
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static")
    writer.partitionBy(*by).parquet(path)


def write_clustered(
    df: DataFrame, path: str, by: str = EVENT_TIME, bloom: str = "customer_id", values: int = 100_000,
    mode: str = "append",
) -> None:
    """Parquet in files that hold a range of ``by`` each, with Bloom filters on another column.

    A filter on ``by`` then opens the files of its range, and one on ``bloom`` the row groups whose
    filter has the value; a row group should hold about ``values`` different ones at most. Times are written
    as 64-bit numbers, as the older form has no statistics that a filter can use.
    """
    ranged = df.repartitionByRange(F.col(by).asc_nulls_first()).sortWithinPartitions(by)
    writer = ranged.write.mode(mode).option(f"parquet.bloom.filter.enabled#{bloom}", "true")
    writer = writer.option(f"parquet.bloom.filter.expected.ndv#{bloom}", str(values))
    with _set(df.sparkSession, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS"):
        writer.parquet(path)


def write_velocity(
    alerts: DataFrame, path: str, mode: str = "append", coalesce_to: int | None = None
) -> None:
    """Velocity alerts as flat, unpartitioned Parquet."""
    flat = flat_velocity(alerts)
    flat = flat.coalesce(coalesce_to) if coalesce_to is not None else balanced(flat)
    flat.write.mode(mode).parquet(path)


def write_if_any(
    df: DataFrame, path: str, mode: str = "overwrite", evidence: DataFrame | None = None
) -> bool:
    """Write only when there are rows; earlier output stays otherwise.

    ``evidence`` is a cheaper table that is empty exactly when ``df`` is.
    """
    if (df if evidence is None else evidence).isEmpty():
        return False
    df.write.mode(mode).parquet(path)
    return True


def write_table(df: DataFrame, target: str, mode: str = "append", **options) -> None:
    """To a JDBC table when ``url`` is among the options, else to a Parquet path.

    For JDBC, ``numPartitions`` caps the connections and ``batchsize`` sets the
    rows per round trip. A retried JDBC task may send its rows again unless the
    target has a key.
    """
    if "url" in options:
        df.write.format("jdbc").mode(mode).options(dbtable=target, **options).save()
    else:
        df.write.mode(mode).options(**options).parquet(target)


def append_table(
    df: DataFrame, target: str, key: str, again: bool = False, folder: str | None = None, **options
) -> None:
    """Append to a table, a Parquet folder below ``folder`` or JDBC.

    ``again`` says that the target may hold some of the rows, from an earlier try or an
    earlier alert of the same window: only then its keys are read, and rows that it has are left
    out. Of tables that are looked up by day (``DAY_OF_TABLE``) keys are read only of the days of
    these rows, by folder or, for JDBC, by a condition on the time.
    """
    within = DAY_OF_TABLE.get(target)
    path = target if folder is None else f"{folder.rstrip('/')}/{target}"
    spark = df.sparkSession
    if again:
        try:
            existing = read_table(spark, path, days=True, **options)
            if within:
                existing = _same_days(existing, df, within, TABLE_DAY if "url" not in options else within)
            df = unseen(df, existing, key)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if within and "url" not in options:
        write_partitioned(df.withColumn(TABLE_DAY, F.to_date(within)), path, (TABLE_DAY,))
    else:
        write_table(df, path, **options)


def _same_days(existing: DataFrame, df: DataFrame, within: str, column: str) -> DataFrame:
    """Rows of ``existing`` from the first to the last day of ``df``, or without a day if it has such."""
    day = F.to_date(within)
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last"),
                  F.count_if(day.isNull()).alias("none")).first()
    wanted = F.lit(False)
    kind = existing.schema[column].dataType
    # A table that has but rows without a day has a folder level without a type.
    if span["first"] is not None and not isinstance(kind, T.NullType):
        after = span["last"] + dt.timedelta(days=1)
        first, after = (F.lit(d).cast(kind) for d in (span["first"], after))
        wanted = (F.col(column) >= first) & (F.col(column) < after)
    if span["none"]:
        wanted = wanted | F.col(column).isNull()
    return existing.filter(wanted)


def unseen(df: DataFrame, existing: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows whose key the target does not hold yet, for targets with a unique key."""
    return df.join(existing.select(key), key, "left_anti")


def preview(df: DataFrame, columns: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows of chosen columns; showing them is up to the caller."""
    return df.select(*columns).limit(n)

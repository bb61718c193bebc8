"""Landing queue messages as JSON lines, where the transaction stream picks them up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from paywarden.operators.messages import (
    DEAD_LETTER_ROUTE,
    GOOD_ROUTE,
    failed_tables,
    sort_messages,
)
from paywarden.schema import TRANSACTION_SCHEMA

# Fixed value: how long messages are gathered before they are written.
LANDING_INTERVAL = "5 seconds"

LANDED_SCHEMA = T.StructType(
    [
        *TRANSACTION_SCHEMA.fields,
        T.StructField("_retry_count", T.IntegerType()),
        T.StructField("raw_message", T.StringType()),
        T.StructField("dlq_reason", T.StringType()),
        T.StructField("route", T.StringType()),
    ]
)


def land_messages(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    every: str = LANDING_INTERVAL,
    once: bool = False,
) -> StreamingQuery:
    """Messages as JSON lines under ``path``, dead letters in a folder of their own.

    Good rows keep the message text as well. The source is read and parsed once. Spark's log of committed files
    lies under ``path``, so read through the functions below, which follow it.
    Messages are gathered by time. A limit on rows per file has no counterpart
    in Spark; the source's own limits bound a micro-batch.
    """
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return (
        sort_messages(messages)
        .writeStream.format("json")
        .partitionBy("route")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _good(landed: DataFrame) -> DataFrame:
    return landed.filter(F.col("route") == GOOD_ROUTE).select(
        *TRANSACTION_SCHEMA.names, "_retry_count"
    )


def read_landed(spark: SparkSession, path: str, raw: bool = False) -> DataFrame:
    """Landed transactions; with ``raw`` also the message as it came."""
    landed = spark.read.schema(LANDED_SCHEMA).json(path)
    if raw:
        return landed.filter(F.col("route") == GOOD_ROUTE).drop("route", "dlq_reason")
    return _good(landed)


def land_routes(failed: DataFrame, path: str) -> None:
    """Rows of a failed write into the tables ``retry`` and ``dead`` below ``path``.

    ``failed`` has ``raw_message`` and ``_retry_count``. The retry table has the columns of
    a message table, so ``land_messages`` and ``parse_messages`` take it as it is.
    """
    retry, dead = failed_tables(failed)
    retry.write.mode("append").partitionBy("route").parquet(f"{path}/retry")
    dead.write.mode("append").parquet(f"{path}/dead")


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    landed = spark.read.schema(LANDED_SCHEMA).json(path)
    return landed.filter(F.col("route") == DEAD_LETTER_ROUTE).select("raw_message", "dlq_reason")


def stream_landed(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Landed transactions as input of the streaming job."""
    reader = spark.readStream.schema(LANDED_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _good(reader.json(path)).drop("_retry_count")

"""Scans: JSON-lines transactions (table or stream) and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden.schema import TABLE_DAY, TRANSACTION_SCHEMA


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines files under the fixed schema; no inference pass over the data."""
    return spark.read.schema(TRANSACTION_SCHEMA).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same, with what is needed to find a line again that is no JSON object.

    ``malformed_line`` has the text of such a line and is NULL for all others, ``source_file`` and
    ``block_start`` say where it was read. A field of the wrong type is NULL and makes no line
    malformed. Columns that are not asked for are not parsed, these three included.
    """
    broken = "_broken"
    schema = T.StructType([*TRANSACTION_SCHEMA.fields, T.StructField(broken, T.StringType())])
    lines = spark.read.schema(schema).option("columnNameOfCorruptRecord", broken).json(path)
    # Only lines that could not be read whole, and gave no id, are looked at once more.
    kind = F.schema_of_variant(F.try_parse_json(broken))
    is_object = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    malformed = F.when(F.col("transaction_id").isNull() & F.col(broken).isNotNull() & ~is_object, F.col(broken))
    return lines.select(
        *TRANSACTION_SCHEMA.names, malformed.alias("malformed_line"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"))


def stream_transactions(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """A directory of JSON-lines files as a stream; limits bound one micro-batch."""
    reader = spark.readStream.schema(TRANSACTION_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.json(path)


def read_table(
    spark: SparkSession, source: str, view: str | None = None, days: bool = False, **options
) -> DataFrame:
    """A result table by Parquet path, or by JDBC when ``url`` is among the options.

    For JDBC, pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` to spread a large table over tasks; without them Spark
    reads it through one connection. ``days`` keeps the folder level by day of Parquet tables.
    """
    if "url" in options:
        table = spark.read.format("jdbc").options(dbtable=source, **options).load()
    else:
        # The folder level by day serves look-ups and is no column of the table.
        table = spark.read.options(**options).parquet(source)
        if not days:
            table = table.drop(TABLE_DAY)
    if view:
        table.createOrReplaceTempView(view)
    return table

"""Raw queue messages: parsing, dead letters, retry counts and retry routing.

A message table has ``raw`` (text or bytes) and ``headers`` (map of string to int).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden.functions.columns import blank
from paywarden.schema import TRANSACTION_SCHEMA

# Routes, delays and reasons.
RETRY_STEPS = ((0, "RETRY_1", 5000), (1, "RETRY_2", 10000))
DEAD_LETTER_ROUTE = "DLQ"
GOOD_ROUTE = "GOOD"
INVALID_JSON = "INVALID_JSON"
RETRIES_EXHAUSTED = "HDFS_WRITE_FAILED_AFTER_RETRIES"


def judge_messages(df: DataFrame) -> DataFrame:
    """Add ``raw_message`` (broken bytes replaced), ``_retry_count`` and ``judged``.

    ``judged.is_good`` says whether the whole text is one JSON object, and
    ``judged.fields`` is the transaction.

    The JSON reader stops after the first value and ignores what follows. So the
    text is read as the first element of an array whose second and last element
    carries a digest of the text: anything left over after the object ends the
    array early, adds an element or breaks it.

    The verdict is unnested from an array of one, because a filter on it then
    stays above the parse instead of repeating it.
    """
    raw = F.col("raw").cast("string")
    mark = F.xxhash64("raw").cast("string")
    boxed = F.concat(F.lit("["), raw, F.lit(',{"transaction_id":"'), mark, F.lit('"}]'))
    parsed = F.from_json(boxed, T.ArrayType(TRANSACTION_SCHEMA), {"allowSingleQuotes": "false"})
    read = with_retry_count(df).withColumns(
        {
            "raw_message": F.make_valid_utf8(raw),
            "_pair": F.when(F.is_valid_utf8(raw), parsed),
            "_mark": mark,
        }
    )
    first, last = F.get("_pair", F.lit(0)), F.get("_pair", F.lit(1))
    alone = (F.size("_pair") == 2) & (last["transaction_id"] == F.col("_mark"))
    is_good = F.coalesce(alone & first.isNotNull(), F.lit(False))
    verdict = F.struct(is_good.alias("is_good"), first.alias("fields"))
    return read.withColumn("judged", F.explode(F.array(verdict))).drop("_pair", "_mark")


def parse_messages(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, dead).

    Good rows carry the transaction fields, ``_retry_count`` from the headers
    and ``raw_message``; a field of the wrong type is NULL and is left to
    validation. Dead rows are texts that are not one JSON object.
    """
    judged = judge_messages(df)
    good = judged.filter("judged.is_good").select("judged.fields.*", "_retry_count", "raw_message")
    return good, dead_letters(judged.filter("NOT judged.is_good"), INVALID_JSON)


def sort_messages(df: DataFrame) -> DataFrame:
    """Good and dead messages as one table, told apart by ``route``; one pass.

    Good rows have the fields and ``_retry_count``, dead rows ``dlq_reason``; the rest
    is NULL. All rows keep ``raw_message``: unknown fields and values of the wrong type are
    in no column.
    """
    good = F.col("judged.is_good")
    fields = [F.when(good, F.col(f"judged.fields.{n}")).alias(n) for n in TRANSACTION_SCHEMA.names]
    return judge_messages(df).select(
        *fields,
        F.when(good, F.col("_retry_count")).alias("_retry_count"),
        "raw_message",
        F.when(~good, F.lit(INVALID_JSON)).alias("dlq_reason"),
        F.when(good, F.lit(GOOD_ROUTE)).otherwise(F.lit(DEAD_LETTER_ROUTE)).alias("route"),
    )


def dead_letters(df: DataFrame, reason: str) -> DataFrame:
    return df.select("raw_message", F.lit(reason).alias("dlq_reason"))


def with_retry_count(df: DataFrame) -> DataFrame:
    """``_retry_count`` from the headers, 0 when absent; the body has no say."""
    return df.withColumn(
        "_retry_count", F.coalesce(F.try_element_at("headers", F.lit("retry_count")), F.lit(0))
    )


def route_failed(df: DataFrame) -> DataFrame:
    """Where rows of a failed write go next, by how often they were tried.

    Adds ``route``, ``next_retry_count``, ``delay_ms`` and ``dlq_reason``.
    """
    tried = F.col("_retry_count")

    def by_step(values: dict[int, object], otherwise: Column) -> Column:
        steps = [F.when(tried == count, F.lit(value)) for count, value in values.items()]
        return F.coalesce(*steps, otherwise)

    last_step = max(count for count, _, _ in RETRY_STEPS)
    return df.withColumns(
        {
            "route": by_step({n: name for n, name, _ in RETRY_STEPS}, F.lit(DEAD_LETTER_ROUTE)),
            "next_retry_count": by_step({n: n + 1 for n, _, _ in RETRY_STEPS}, blank("int")),
            "delay_ms": by_step({n: wait for n, _, wait in RETRY_STEPS}, blank("int")),
            "dlq_reason": F.when(
                ~tried.between(0, last_step), F.lit(RETRIES_EXHAUSTED)
            ),
        }
    )


def failed_tables(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(retry, dead) of rows of a failed write, from ``route_failed``.

    Retry rows carry the raw message, headers with the next count, the step and its delay,
    so that reading them as messages gives the row back under its new count. Dead rows carry
    the raw message and the reason.
    """
    routed = route_failed(df)
    retry = routed.filter(F.col("route") != DEAD_LETTER_ROUTE).select(
        F.col("raw_message").alias("raw"),
        F.create_map(F.lit("retry_count"), F.col("next_retry_count")).alias("headers"),
        "route", "delay_ms",
    )
    dead = routed.filter(F.col("route") == DEAD_LETTER_ROUTE).select("raw_message", "dlq_reason")
    return retry, dead

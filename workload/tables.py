"""Transactions and queue messages derived from the ``events`` table.

Each column is an SQL expression that Spark and DuckDB read alike. Remainders
of the event id plant every defect; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# One day of events becomes five minutes, so that customers reach the velocity limit.
SQUEEZE = 288

FIELDS = {
    "transaction_id": """CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 89 = 0 THEN ''
        WHEN event_id % 50 = 49 THEN concat('TXN', CAST(event_id - 1 AS STRING))
        ELSE concat('TXN', CAST(event_id AS STRING)) END""",
    "customer_id": """CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 37 = 0 THEN ''
        ELSE concat('CUST', CAST(user_id AS STRING)) END""",
    "account_id": """CASE WHEN event_id % 79 = 0 THEN NULL
        ELSE concat('ACC', CAST(user_id AS STRING)) END""",
    # With amounts that are no number, that no decimal of 18 digits holds, or that none holds.
    "amount": """CASE WHEN event_id % 41 = 0 THEN CAST(-5000 AS DOUBLE)
        WHEN event_id % 43 = 0 THEN NULL WHEN event_id % 103 = 0 THEN CAST('Infinity' AS DOUBLE)
        WHEN event_id % 107 = 0 THEN CAST('NaN' AS DOUBLE)
        WHEN event_id % 109 = 0 THEN CAST(1e17 AS DOUBLE)
        WHEN event_id % 113 = 0 THEN CAST(9999999999999999.0 AS DOUBLE)
        WHEN event_id % 127 = 0 THEN CAST(1e30 AS DOUBLE) ELSE value * 1000 END""",
    "currency": """CASE WHEN event_id % 47 = 0 THEN 'USD' WHEN event_id % 53 = 0 THEN NULL
        ELSE 'INR' END""",
    "transaction_type": """CASE WHEN event_id % 59 = 0 THEN 'INVALID'
        WHEN event_type = 'click' THEN 'UPI' WHEN event_type = 'view' THEN 'CARD'
        WHEN event_type = 'purchase' THEN 'NEFT' WHEN event_type = 'signup' THEN 'IMPS'
        WHEN event_type = 'error' THEN 'ATM' END""",
    "merchant": """CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 73 = 0 THEN ''
        ELSE concat('M', CAST(user_id % 8 AS STRING)) END""",
    "location": "concat('L', CAST(user_id % 6 AS STRING))",
    "status": """CASE WHEN event_id % 61 = 0 THEN 'UNKNOWN' WHEN event_id % 67 = 0 THEN NULL
        WHEN event_id % 5 = 0 THEN 'FAILED' ELSE 'SUCCESS' END""",
}

# Ids without planted repeats, for streams that carry exact copies instead.
OWN_ID = """CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 89 = 0 THEN ''
        ELSE concat('TXN', CAST(event_id AS STRING)) END"""
COPIES = "CASE WHEN event_id % 50 = 49 THEN 2 ELSE 1 END"

# Text of a queue message; amounts are whole numbers, so both engines spell them alike.
_BODY = """concat('{"transaction_id":"TXN', CAST(event_id AS STRING),
        '","customer_id":"CUST', CAST(user_id AS STRING),
        '","amount":', CAST(CAST(round(value * 1000) AS BIGINT) AS STRING),
        ',"currency":"INR","status":"SUCCESS","_retry_count":9}')"""
MESSAGE = f"""CASE event_id % 20
        WHEN 0 THEN concat('{{bad', CAST(event_id AS STRING))
        WHEN 1 THEN concat('[', CAST(event_id AS STRING), ']')
        WHEN 2 THEN concat('"x', CAST(event_id AS STRING), '"')
        WHEN 3 THEN 'null'
        WHEN 4 THEN ''
        WHEN 5 THEN concat({_BODY}, ' tail')
        WHEN 6 THEN concat({_BODY}, ']')
        WHEN 7 THEN '{{}}'
        WHEN 8 THEN concat('{{"transaction_id":"TXN', CAST(event_id AS STRING), '","amount":"12x"}}')
        WHEN 9 THEN CAST(event_id AS STRING)
        ELSE {_BODY} END"""

# Lines of a file, some of which are no JSON object.
LINE = f"""CASE event_id % 20
        WHEN 0 THEN concat('{{bad', CAST(event_id AS STRING))
        WHEN 2 THEN concat('"x', CAST(event_id AS STRING), '"')
        WHEN 5 THEN concat('{{"transaction_id":"TXN', CAST(event_id AS STRING))
        WHEN 7 THEN '{{}}'
        WHEN 8 THEN concat('{{"transaction_id":"TXN', CAST(event_id AS STRING), '","amount":"12x"}}')
        WHEN 9 THEN CAST(event_id AS STRING)
        WHEN 11 THEN concat('{{"amount":[', CAST(event_id AS STRING), ']}}')
        ELSE {_BODY} END"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream. The pattern lets it be one file or a folder of files."""
    schema = events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


_BASE = "unix_micros(timestamp'2024-01-01 00:00:00')"
_MONTH = "CAST(ts AS TIMESTAMP)"
_SQUEEZED = f"timestamp_micros({_BASE} + (unix_micros({_MONTH}) - {_BASE}) div {SQUEEZE})"
_TEXT = f"""date_format({_SQUEEZED}, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")"""
_WIRE_TEXT = f"""CASE WHEN event_id % 97 = 0 THEN 'not a time'
        WHEN event_id % 101 = 0 THEN NULL ELSE {_TEXT} END"""


def _columns(fields: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in fields.items()]


def transactions(spark: SparkSession, sf_dir: str, squeezed: bool = True) -> DataFrame:
    """Transactions with a parsed time, planted defects and repeated ids."""
    fields = FIELDS | {"transaction_timestamp": _SQUEEZED if squeezed else _MONTH}
    return events(spark, sf_dir).selectExpr(*_columns(fields))


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten message fields, time as text; some times are missing or unreadable."""
    return events(spark, sf_dir).selectExpr(*_columns(FIELDS | {"timestamp": _WIRE_TEXT}))


def wire_copies(source: DataFrame, copies: str = COPIES) -> DataFrame:
    """The ten message fields of a table or stream of events, some rows sent twice."""
    fields = FIELDS | {"transaction_id": OWN_ID, "timestamp": _TEXT}
    sent = source.withColumn("_sent", F.expr(f"explode(sequence(1, {copies}))"))
    return sent.selectExpr(*_columns(fields))


def month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten message fields in real time, whether in the second half of the month, and a later time."""
    text = """date_format({}, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")"""
    fields = FIELDS | {"transaction_id": OWN_ID, "timestamp": text.format(_MONTH)}
    later = text.format(f"{_MONTH} + INTERVAL '14' DAY")
    return events(spark, sf_dir).selectExpr(
        *_columns(fields), "CAST(ts >= timestamp_ntz'2024-01-16 00:00:00' AS INT) AS late_half", f"{later} AS two_weeks_on")


# Minutes at which a sending ends; windows of five minutes lie across them.
SENDINGS = (48, 97)


def sendings(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The ten message fields in four sendings: three spans of time, and each copy one later.

    Some times are missing or unreadable. Rows without an id have no copies.
    """
    fields = FIELDS | {"transaction_id": OWN_ID, "timestamp": _WIRE_TEXT}
    spans = " + ".join(f"CAST({_SQUEEZED} >= timestamp'2024-01-01 00:00:00' + INTERVAL '{m}' MINUTE AS INT)"
                       for m in SENDINGS)
    sent = events(spark, sf_dir).withColumn("_copy", F.expr(f"explode(sequence(0, {COPIES} - 1))"))
    sent = sent.selectExpr(*_columns(fields), f"{spans} + _copy AS _sending", "_copy")
    sent = sent.filter("_copy = 0 OR transaction_id <> ''").drop("_copy")
    return [sent.filter(F.col("_sending") == n).drop("_sending") for n in range(len(SENDINGS) + 2)]


def messages(source: DataFrame) -> DataFrame:
    """Raw queue messages of a table or stream of events."""
    headers = """CASE event_id % 4 WHEN 0 THEN NULL
        WHEN 1 THEN map('other', 5) ELSE map('retry_count', CAST(event_id % 4 - 1 AS INT)) END"""
    return source.select(F.expr(MESSAGE).alias("raw"), F.expr(headers).alias("headers"))

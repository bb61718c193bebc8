"""Record layouts and fixed values shared by batch and streaming."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# The ten fields of a transaction message, in wire order.
TRANSACTION_SCHEMA = _struct(
    transaction_id=T.StringType(),
    customer_id=T.StringType(),
    account_id=T.StringType(),
    amount=T.DoubleType(),
    currency=T.StringType(),
    transaction_type=T.StringType(),
    merchant=T.StringType(),
    location=T.StringType(),
    timestamp=T.StringType(),
    status=T.StringType(),
)

EVENT_TIME = "transaction_timestamp"
DATE_PARTS = ("year", "month", "day")

# Column order of the two result tables.
TRANSACTION_COLUMNS = (
    "transaction_id",
    "customer_id",
    "account_id",
    "amount",
    "currency",
    "transaction_type",
    "merchant",
    "location",
    "transaction_timestamp",
    "status",
)
FRAUD_COLUMNS = ("fraud_rule", "fraud_reason", "fraud_status")
ALERT_COLUMNS = TRANSACTION_COLUMNS + FRAUD_COLUMNS

# What the alert report shows, newest first.
RECENT_ALERT_COLUMNS = (
    "fraud_alert_id",
    "transaction_id",
    "customer_id",
    "amount",
    "transaction_type",
    "merchant",
    "location",
    "fraud_rule",
    "fraud_reason",
    "fraud_status",
    "created_at",
)

# Accepted domains.
CURRENCY = "INR"
TRANSACTION_TYPES = ("UPI", "ATM", "CARD", "NET_BANKING", "IMPS", "NEFT")
STATUSES = ("SUCCESS", "FAILED")

# Fraud rules and their defaults.
HIGH_VALUE_RULE = "HIGH_VALUE_TRANSACTION"
VELOCITY_RULE = "HIGH_TRANSACTION_VELOCITY"
FRAUD_STATUS = "POTENTIAL_FRAUD"
HIGH_VALUE_THRESHOLD = 100000
VELOCITY_THRESHOLD = 5
VELOCITY_WINDOW = "5 minutes"
WATERMARK_DELAY = "10 minutes"

_TYPES = {f.name: f.dataType for f in TRANSACTION_SCHEMA.fields} | {EVENT_TIME: T.TimestampType()}
TRANSACTION_TABLE_SCHEMA = _struct(**{c: _TYPES[c] for c in TRANSACTION_COLUMNS})
VELOCITY_SCHEMA = _struct(
    customer_id=T.StringType(),
    window_start=T.TimestampType(),
    window_end=T.TimestampType(),
    transaction_count=T.LongType(),
    fraud_rule=T.StringType(),
    fraud_reason=T.StringType(),
    fraud_status=T.StringType(),
)
# Result tables that are looked up by day: the time that is part of their rows' key.
DAY_OF_TABLE = {"fraud_alerts": EVENT_TIME}
# Folder level by day of such tables, where they are Parquet.
TABLE_DAY = "table_day"

"""The same queries in SQL for DuckDB, written against the test tables."""

from __future__ import annotations

from paywarden import schema as S
from workload.tables import COPIES, FIELDS, LINE, MESSAGE, OWN_ID, SQUEEZE

_BASE = "epoch_us(TIMESTAMP '2024-01-01')"
_SQUEEZED = f"make_timestamp({_BASE} + (epoch_us(ts) - {_BASE}) // {SQUEEZE})"
_TEXT = f"strftime({_SQUEEZED}, '%Y-%m-%dT%H:%M:%S.%f')"
_WIRE_TEXT = f"""CASE WHEN event_id % 97 = 0 THEN 'not a time'
    WHEN event_id % 101 = 0 THEN NULL ELSE {_TEXT} END"""
_WIRE_TIME = f"""CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN NULL
    ELSE {_SQUEEZED} END"""
_FIELD_LIST = ", ".join(f"{sql} AS {name}" for name, sql in FIELDS.items())
_OWN_LIST = ", ".join(
    f"{OWN_ID if name == 'transaction_id' else sql} AS {name}" for name, sql in FIELDS.items()
)
_PARTS = """CAST(year(transaction_timestamp) AS INTEGER) AS year,
    CAST(month(transaction_timestamp) AS INTEGER) AS month,
    CAST(day(transaction_timestamp) AS INTEGER) AS day"""

_TYPES = "('UPI', 'ATM', 'CARD', 'NET_BANKING', 'IMPS', 'NEFT')"
_BAD_AMOUNT = "amount IS NULL OR amount <= 0"
_BAD_STATUS = "status NOT IN ('SUCCESS', 'FAILED')"
_BAD_TYPE = f"transaction_type NOT IN {_TYPES}"


def _gone(name: str) -> str:
    return f"{name} IS NULL OR {name} = ''"


# (label, broken when), in label order
BATCH_RULES = [
    ("MISSING_CUSTOMER_ID", _gone("customer_id")),
    ("INVALID_AMOUNT", _BAD_AMOUNT),
    ("INVALID_STATUS", _BAD_STATUS),
    ("INVALID_TRANSACTION_TYPE", _BAD_TYPE),
    ("INVALID_CURRENCY", "currency IS NULL OR currency <> 'INR'"),
    ("MISSING_TRANSACTION_ID", _gone("transaction_id")),
    ("MISSING_ACCOUNT_ID", _gone("account_id")),
    ("MISSING_MERCHANT", _gone("merchant")),
]
STREAM_RULES = [
    ("INVALID_CUSTOMER", "customer_id IS NULL"),
    ("INVALID_AMOUNT", _BAD_AMOUNT),
    ("INVALID_CURRENCY", "currency <> 'INR'"),
    ("INVALID_TRANSACTION_TYPE", _BAD_TYPE),
    ("INVALID_STATUS", _BAD_STATUS),
    ("INVALID_TRANSACTION_ID", _gone("transaction_id")),
    ("INVALID_ACCOUNT", _gone("account_id")),
    ("INVALID_MERCHANT", _gone("merchant")),
]


STRICT_RULES = [
    ("INVALID_CUSTOMER", _gone("customer_id")),
    ("INVALID_AMOUNT", f"{_BAD_AMOUNT} OR isnan(amount)"),
    ("INVALID_CURRENCY", "currency IS NULL OR currency <> 'INR'"),
    ("INVALID_TRANSACTION_TYPE", f"transaction_type IS NULL OR {_BAD_TYPE}"),
    ("INVALID_STATUS", f"status IS NULL OR {_BAD_STATUS}"),
    ("INVALID_TRANSACTION_ID", _gone("transaction_id")),
    ("INVALID_ACCOUNT", _gone("account_id")),
    ("INVALID_MERCHANT", _gone("merchant")),
    ("INVALID_TIMESTAMP", "transaction_timestamp IS NULL"),
]


def _reason(rules) -> str:
    labels = ", ".join(f"CASE WHEN {broken} THEN '{label}' END" for label, broken in rules)
    return f"concat_ws(',', {labels})"


_HIGH_TAGS = """'HIGH_VALUE_TRANSACTION' AS fraud_rule,
    'Transaction amount exceeds INR 100000' AS fraud_reason, 'POTENTIAL_FRAUD' AS fraud_status"""


def _fast_tags(window: str = "5 minutes") -> str:
    return f"""'HIGH_TRANSACTION_VELOCITY' AS fraud_rule,
    'More than 5 transactions within {window}' AS fraud_reason,
    'POTENTIAL_FRAUD' AS fraud_status"""


def _counts(source: str, window: str = "5 minutes") -> str:
    return f"""SELECT customer_id, time_bucket(INTERVAL '{window}', transaction_timestamp)
        AS window_start, time_bucket(INTERVAL '{window}', transaction_timestamp)
        + INTERVAL '{window}' AS window_end, count(*) AS transaction_count
        FROM {source} WHERE transaction_timestamp IS NOT NULL GROUP BY ALL"""


def _velocity(source: str, window: str = "5 minutes") -> str:
    return f"""SELECT *, {_fast_tags(window)} FROM ({_counts(source, window)})
        WHERE transaction_count > 5"""


_COLUMNS = ", ".join(S.TRANSACTION_COLUMNS)
_VELOCITY_COLUMNS = ", ".join(S.VELOCITY_SCHEMA.names)


def _velocity_rows(source: str, window: str = "5 minutes", stream: bool = False) -> str:
    if stream:
        fill = """'INR' AS currency, 'MULTIPLE' AS transaction_type, 'MULTIPLE' AS merchant,
            'MULTIPLE' AS location, window_start AS transaction_timestamp, 'DETECTED' AS status"""
    else:
        fill = """CAST(NULL AS VARCHAR) AS currency, CAST(NULL AS VARCHAR) AS transaction_type,
            CAST(NULL AS VARCHAR) AS merchant, CAST(NULL AS VARCHAR) AS location,
            window_start AS transaction_timestamp, 'SUCCESS' AS status"""
    return f"""SELECT CAST(NULL AS VARCHAR) AS transaction_id, customer_id,
        CAST(NULL AS VARCHAR) AS account_id, CAST(NULL AS DOUBLE) AS amount, {fill},
        fraud_rule, fraud_reason, fraud_status FROM ({_velocity(source, window)})"""


def _alerts(source: str, window: str = "5 minutes") -> str:
    return f"""SELECT {_COLUMNS}, {_HIGH_TAGS} FROM {source} WHERE amount > 100000
        UNION ALL BY NAME {_velocity_rows(source, window)}"""


def _stamped(source: str) -> str:
    return f"""SELECT *, md5(concat(coalesce(fraud_rule, ''), '|', coalesce(transaction_id, ''),
        '|', coalesce(customer_id, ''), '|', coalesce(account_id, ''), '|',
        CAST(epoch_us(transaction_timestamp) AS VARCHAR))) AS fraud_alert_id,
        transaction_timestamp AS created_at FROM ({source})"""


def _checked(name: str, source: str, rules) -> str:
    return f"{name} AS (SELECT *, {_reason(rules)} AS rejection_reason FROM {source})"


def _with(body: str) -> str:
    """The derived tables that any query may name."""
    valid = "* EXCLUDE (rejection_reason) FROM"
    return f"""WITH
    tx AS (SELECT {_FIELD_LIST}, {_SQUEEZED} AS transaction_timestamp FROM events),
    tx_month AS (SELECT {_FIELD_LIST}, ts AS transaction_timestamp FROM events),
    wire AS (SELECT {_FIELD_LIST}, {_WIRE_TEXT} AS timestamp,
        {_WIRE_TIME} AS transaction_timestamp FROM events),
    sent AS (SELECT {_OWN_LIST}, {_SQUEEZED} AS transaction_timestamp,
        unnest(range({COPIES})) AS copy FROM events),
    once AS (SELECT * EXCLUDE (copy) FROM sent
        WHERE copy = 0 OR transaction_id IS NULL OR transaction_id = ''),
    first AS (SELECT {_OWN_LIST}, {_WIRE_TIME} AS transaction_timestamp FROM events),
    own AS (SELECT {_OWN_LIST}, {_SQUEEZED} AS transaction_timestamp FROM events),
    {_checked("tx_batch", "tx", BATCH_RULES)},
    {_checked("tx_stream", "tx", STREAM_RULES)},
    {_checked("month_batch", "tx_month", BATCH_RULES)},
    {_checked("wire_batch", "wire", BATCH_RULES)},
    {_checked("wire_strict", "wire", STRICT_RULES)},
    {_checked("sent_stream", "(SELECT * EXCLUDE (copy) FROM sent)", STREAM_RULES)},
    {_checked("first_stream", "first", STREAM_RULES)},
    {_checked("own_stream", "own", STREAM_RULES)},
    valid AS (SELECT {valid} tx_batch WHERE rejection_reason = ''),
    valid_stream AS (SELECT {valid} tx_stream WHERE rejection_reason = ''),
    valid_month AS (SELECT {valid} month_batch WHERE rejection_reason = ''),
    valid_wire AS (SELECT {valid} wire_batch WHERE rejection_reason = ''),
    valid_first AS (SELECT {valid} first_stream WHERE rejection_reason = ''),
    valid_own AS (SELECT {valid} own_stream WHERE rejection_reason = ''),
    alerts AS ({_stamped(_alerts("valid"))}),
    alerts_month AS ({_stamped(_alerts("valid_month", "1 day"))}),
    chosen AS (SELECT * FROM alerts_month WHERE fraud_rule = 'HIGH_VALUE_TRANSACTION'
        AND CAST(transaction_timestamp AS DATE) BETWEEN '2024-01-05' AND '2024-01-20'),
    messages AS (SELECT event_id, {MESSAGE} AS raw,
        CASE WHEN event_id % 4 IN (0, 1) THEN 0 ELSE CAST(event_id % 4 - 1 AS INTEGER) END
        AS _retry_count FROM events),
    judged AS (SELECT *, CASE WHEN json_valid(raw) THEN json_type(raw) = 'OBJECT' ELSE false END
        AS good FROM messages),
    parsed AS (SELECT json_extract_string(raw, '$.transaction_id') AS transaction_id,
        json_extract_string(raw, '$.customer_id') AS customer_id,
        TRY_CAST(json_extract_string(raw, '$.amount') AS DOUBLE) AS amount,
        json_extract_string(raw, '$.currency') AS currency,
        json_extract_string(raw, '$.status') AS status, _retry_count, raw AS raw_message
        FROM judged WHERE good)
    {body}"""


_CENTS = "TRY_CAST(amount AS DECIMAL(24,2))"
_MONEY = f"CAST(coalesce(sum({_CENTS}), 0) AS DOUBLE)"
_LEFT_OUT = f"""count(*) FILTER (amount IS NOT NULL AND {_CENTS} IS NULL) AS amounts_left_out"""


def _by(column: str, source: str, amount: str | None = None) -> str:
    money = f", {_MONEY} AS {amount}, {_LEFT_OUT}" if amount else ""
    return f"""SELECT {column}, count(*) AS alert_count{money} FROM {source}
        GROUP BY {column} ORDER BY alert_count DESC, {column} NULLS FIRST"""


def _kpi(source: str) -> str:
    return f"""SELECT count(*) AS total_alerts, {_MONEY} AS total_amount, {_LEFT_OUT},
        count(DISTINCT customer_id) AS customers FROM {source}"""


def _bounds(source: str) -> str:
    return f"""SELECT min(CAST(transaction_timestamp AS DATE)) AS min_date,
        max(CAST(transaction_timestamp AS DATE)) AS max_date FROM {source}"""


def _recent(source: str) -> str:
    return f"""SELECT {", ".join(S.RECENT_ALERT_COLUMNS)} FROM {source}
        ORDER BY created_at DESC, fraud_alert_id DESC LIMIT 50"""


_TREND = """SELECT CAST(transaction_timestamp AS DATE) AS fraud_date,
    count(*) AS fraud_alert_count FROM alerts_month GROUP BY 1 ORDER BY 1 NULLS FIRST"""


def _routes(source: str, processed: str) -> str:
    return f"""SELECT 'processed' AS outcome, {_COLUMNS} FROM {source}
            WHERE rejection_reason = '' AND {processed}
        UNION ALL SELECT 'rejected', {_COLUMNS} FROM {source} WHERE rejection_reason <> ''
        UNION ALL SELECT 'high_value', {_COLUMNS} FROM {source}
            WHERE rejection_reason = '' AND amount > 100000"""


_OUTCOME = """CASE WHEN rejection_reason <> '' THEN 'rejected'
    WHEN amount > 100000 THEN 'high_value' ELSE 'processed' END AS outcome"""


def _repeated(source: str, nulls: bool = False) -> str:
    keep = "true" if nulls else "transaction_id IS NOT NULL"
    return f"""SELECT transaction_id FROM {source} WHERE {keep}
        GROUP BY transaction_id HAVING count(*) > 1"""


def _duplicate_summary(source: str) -> str:
    return f"""SELECT CAST(sum(n) AS BIGINT) AS total_records, count(*) AS unique_records,
        CAST(sum(CASE WHEN n > 1 AND transaction_id IS NOT NULL THEN n ELSE 0 END) AS BIGINT)
            AS duplicate_records,
        CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_transaction_ids
        FROM (SELECT transaction_id, count(*) AS n FROM {source} GROUP BY transaction_id)"""


def _summary(checked: str, valid: str) -> str:
    return f"""SELECT count(*) AS total_transactions,
        count(*) FILTER (rejection_reason = '') AS valid_transactions,
        count(*) FILTER (rejection_reason <> '') AS rejected_transactions,
        count(*) FILTER (rejection_reason = '' AND amount > 100000) AS high_value_alerts,
        (SELECT count(*) FROM ({_velocity(valid)})) AS velocity_alerts FROM {checked}"""


# The watermark has millisecond precision and trails the newest row by ten minutes.
_WATERMARK = """(SELECT make_timestamp(epoch_ms(max(transaction_timestamp)) * 1000)
    - INTERVAL 10 MINUTE FROM {})"""
_KEYED = "first WHERE transaction_id <> ''"
_STREAM_VELOCITY = f"SELECT {_VELOCITY_COLUMNS} FROM ({_velocity('valid_first')})"


def _runs(*runs: str) -> str:
    each = f"""SELECT '{{}}' AS run_id, CAST(0 AS BIGINT) AS batch_id, {_OUTCOME}, {_COLUMNS}
        FROM sent_stream"""
    return " UNION ALL ".join(each.format(run) for run in runs)


_SURVIVOR_ORDER = ", ".join(
    f"{c} NULLS FIRST" for c in S.TRANSACTION_COLUMNS if c != "transaction_id"
)
_STREAM_FLAGS = ", ".join(
    f"CASE WHEN {broken} THEN '{label}' END AS "
    + label.lower() for label, broken in STREAM_RULES
)

_STRICT_FLAGS = ", ".join(
    f"CASE WHEN {broken} THEN '{label}' END AS " + label.lower() for label, broken in STRICT_RULES
)

# Rows that come back: a failure with count c leads on to c + 1 until the third.
_RETRIES = """SELECT transaction_id, CASE c WHEN 0 THEN 'RETRY_1' WHEN 1 THEN 'RETRY_2' ELSE 'DLQ' END AS route,
    CASE WHEN c < 2 THEN CAST(c + 1 AS INTEGER) END AS next_retry_count,
    CASE WHEN c >= 2 THEN 'HDFS_WRITE_FAILED_AFTER_RETRIES' END AS dlq_reason, false AS early
    FROM (SELECT transaction_id, k, _retry_count + k AS c FROM (SELECT *, unnest(range(fails)) AS k
        FROM (SELECT *, CAST(substring(transaction_id, 4) AS BIGINT) // 4 % 4 AS fails FROM parsed
            WHERE transaction_id IS NOT NULL)))
    WHERE k = 0 OR c <= 2"""

_BODIES = {
    "malformed_lines": f"""SELECT line AS malformed_line, true AS found_again FROM
        (SELECT {LINE} AS line FROM events) WHERE CASE WHEN json_valid(line) THEN json_type(line) <> 'OBJECT'
        ELSE true END""",
    "lines_with_fields": f"""SELECT json_extract_string(line, '$.transaction_id') AS transaction_id,
        TRY_CAST(json_extract_string(line, '$.amount') AS DOUBLE) AS amount,
        json_extract_string(line, '$.status') AS status FROM (SELECT {LINE} AS line FROM events)
        WHERE CASE WHEN json_valid(line) THEN json_type(line) = 'OBJECT' ELSE false END""",
    "partial_kpi_alerts": _kpi("alerts"),
    "partial_kpi_alerts_filtered": _kpi("chosen"),
    "partial_kpi_alerts_customer": _kpi("alerts WHERE customer_id = 'CUST7'"),
    "partial_alert_trend": _TREND,
    "partial_alerts_by_rule": _by("fraud_rule", "alerts", "total_amount"),
    "partial_alerts_by_customer_filtered": _by("customer_id", "chosen", "fraud_amount"),
    "partial_alerts_by_merchant": _by("merchant", "alerts"),
    "partial_date_bounds": _bounds("alerts_month"),
    "clustered_alerts_filtered": """SELECT * FROM alerts_month WHERE customer_id = 'CUST7'
        AND CAST(transaction_timestamp AS DATE) BETWEEN '2024-01-05' AND '2024-01-20'""",
    "committed_after_compaction": f"SELECT * EXCLUDE (batch_id) FROM ({_runs('r2')})",
    "stream_late_rows": f"""SELECT {_COLUMNS} FROM (SELECT * REPLACE (
        concat('AGAIN-', transaction_id) AS transaction_id,
        transaction_timestamp - INTERVAL 5 MINUTE AS transaction_timestamp)
        FROM sent WHERE transaction_id <> '')
        WHERE transaction_timestamp <= {_WATERMARK.format('once')}""",
    "retry_release": _RETRIES,
    "land_by_count": """SELECT event_id, event_id % 8 AS queue, CAST((row_number() OVER
        (PARTITION BY event_id % 8 ORDER BY event_id) - 1) // 5 AS BIGINT) AS batch_no FROM events""",
    "event_time_parts": f"SELECT *, {_PARTS} FROM wire",
    "json_lines_scan": "SELECT * EXCLUDE (timestamp) FROM wire",
    "validate_batch": "SELECT * FROM tx_batch",
    "validate_stream": f"SELECT *, {_STREAM_FLAGS} FROM tx_stream",
    "validate_strict": f"SELECT * EXCLUDE (timestamp), {_STRICT_FLAGS} FROM wire_strict",
    "valid_split": "SELECT * FROM tx_batch WHERE rejection_reason = ''",
    "rejected_split": "SELECT * FROM tx_batch WHERE rejection_reason <> ''",
    "rejections_by_reason": """SELECT rejection_reason, count(*) AS rejected_count FROM tx_batch
        WHERE rejection_reason <> '' GROUP BY 1""",
    "rejections_by_label": """SELECT label, count(*) AS rejected_count FROM
        (SELECT unnest(string_split(rejection_reason, ',')) AS label FROM tx_stream
        WHERE rejection_reason <> '') GROUP BY 1""",
    "normal_transactions": "SELECT * FROM valid_stream WHERE amount <= 100000",
    "route_batch": _routes("tx_batch", "true"),
    "route_stream": _routes("tx_stream", "amount <= 100000"),
    "high_value_alerts": f"SELECT *, {_HIGH_TAGS} FROM valid WHERE amount > 100000",
    "velocity_counts": _counts("valid"),
    "velocity_alerts_default": _velocity("valid"),
    "velocity_alerts_daily": _velocity("valid_month", "1 day"),
    "velocity_alerts_stream_rules": _velocity("valid_stream"),
    "conform_high_value": f"SELECT {_COLUMNS}, {_HIGH_TAGS} FROM valid WHERE amount > 100000",
    "conform_velocity_batch": _velocity_rows("valid"),
    "conform_velocity_stream": _velocity_rows("valid_stream", stream=True),
    "all_alerts": "SELECT * FROM alerts",
    "transaction_summary": _summary("tx_batch", "valid"),
    "duplicate_ids": """SELECT transaction_id, count(*) AS record_count FROM tx
        GROUP BY transaction_id HAVING count(*) > 1""",
    "duplicate_records": f"SELECT * FROM tx WHERE transaction_id IN ({_repeated('tx')})",
    "duplicate_records_null_safe": f"""SELECT tx.* FROM tx JOIN ({_repeated("tx", True)}) d
        ON tx.transaction_id IS NOT DISTINCT FROM d.transaction_id""",
    "dedupe_unique": f"""SELECT * FROM tx QUALIFY row_number() OVER
        (PARTITION BY transaction_id ORDER BY {_SURVIVOR_ORDER}) = 1""",
    "duplicate_summary": _duplicate_summary("tx"),
    "kpi_transactions": f"""SELECT count(*) AS total_transactions,
        count(*) FILTER (status = 'SUCCESS') AS successful_transactions,
        {_MONEY} AS total_amount, {_LEFT_OUT} FROM valid""",
    "count_successful": "SELECT count(*) AS total FROM valid WHERE status = 'SUCCESS'",
    "kpi_alerts": _kpi("alerts"),
    "kpi_alerts_filtered": _kpi("chosen"),
    "kpi_alerts_customer": _kpi("alerts WHERE customer_id = 'CUST7'"),
    "kpi_alerts_no_match": _kpi("alerts WHERE customer_id = 'nobody'"),
    "date_bounds_no_match": _bounds("alerts WHERE customer_id = 'nobody'"),
    "alerts_by_rule": _by("fraud_rule", "alerts", "total_amount"),
    "alerts_by_customer": _by("customer_id", "alerts", "fraud_amount"),
    "alerts_by_customer_filtered": _by("customer_id", "chosen", "fraud_amount"),
    "alerts_by_merchant": _by("merchant", "alerts"),
    "alerts_by_type": _by("transaction_type", "alerts"),
    "alerts_by_location": _by("location", "alerts"),
    "alert_trend": _TREND,
    "distinct_customers": "SELECT DISTINCT customer_id FROM alerts ORDER BY 1 NULLS FIRST",
    "distinct_rules": "SELECT DISTINCT fraud_rule FROM alerts ORDER BY 1 NULLS FIRST",
    "date_bounds": _bounds("alerts_month"),
    "recent_alerts": _recent("alerts_month"),
    "recent_alerts_filtered": _recent("chosen"),
    "fraud_summary_view": _by("fraud_rule", "alerts", "total_amount"),
    "customer_fraud_view": _by("customer_id", "alerts", "fraud_amount"),
    "daily_fraud_view": _TREND,
    "partitioned_roundtrip": f"SELECT * EXCLUDE (timestamp), {_PARTS} FROM wire_batch",
    "velocity_roundtrip": _velocity("valid"),
    "table_roundtrip": "SELECT * EXCLUDE (fraud_alert_id, created_at) FROM alerts",
    "unseen_transactions": """SELECT * FROM tx WHERE NOT EXISTS (SELECT 1 FROM tx AS seen
        WHERE seen.amount > 100000 AND seen.transaction_id = tx.transaction_id)""",
    "batch_job_summary": _summary("wire_batch", "valid_wire"),
    "batch_job_alerts": _alerts("valid_wire"),
    "duplicates_job_summary": _duplicate_summary("wire"),
    "duplicates_job_records": f"""SELECT * EXCLUDE (transaction_timestamp) FROM wire
        WHERE transaction_id IN ({_repeated("wire")})""",
    "stream_dedupe": "SELECT * FROM first",
    "stream_routing": f"SELECT *, {_OUTCOME}, {_PARTS} FROM first_stream",
    "stream_dedupe_history": f"SELECT {_COLUMNS} FROM (SELECT {_OWN_LIST}, ts AS transaction_timestamp FROM events)",
    "stream_routing_one_start": f"SELECT *, {_OUTCOME}, {_PARTS} FROM first_stream",
    "stream_velocity_append": f"{_STREAM_VELOCITY} WHERE window_end <= {_WATERMARK.format(_KEYED)}",
    "stream_velocity_update_latest": _STREAM_VELOCITY,
    "run_streams": f"""SELECT {_COLUMNS}, {_HIGH_TAGS} FROM valid_first WHERE amount > 100000
        UNION ALL BY NAME {_velocity_rows("valid_first", stream=True)}""",
    "latest_velocity_two_runs": _velocity("valid_stream"),
    "stream_table_append_replay": f"""SELECT {_COLUMNS} FROM own_stream
        WHERE rejection_reason = '' AND NOT amount > 100000""",
    "stream_alert_append_replay": "SELECT * EXCLUDE (created_at) FROM (" + _stamped(
        f"""SELECT {_COLUMNS}, {_HIGH_TAGS} FROM valid_own WHERE amount > 100000
        UNION ALL BY NAME {_velocity_rows("valid_own", stream=True)}""") + ")",
    "stream_late_drop": f"""SELECT {_COLUMNS} FROM (SELECT * REPLACE (
        concat('AGAIN-', transaction_id) AS transaction_id,
        transaction_timestamp - INTERVAL 5 MINUTE AS transaction_timestamp)
        FROM sent WHERE transaction_id <> '' AND copy = 0)
        WHERE transaction_timestamp > {_WATERMARK.format('once')}""",
    "idempotent_replay": _runs("r1"),
    "ledger_skip": _runs("r1"),
    "committed_read": _runs("r2"),
    "parse_messages": "SELECT * FROM parsed",
    "dead_letters": """SELECT raw AS raw_message, 'INVALID_JSON' AS dlq_reason FROM judged
        WHERE NOT good""",
    "retry_count": "SELECT _retry_count, count(*) AS messages FROM messages GROUP BY 1",
    "route_failed": """SELECT transaction_id, _retry_count,
        CASE _retry_count WHEN 0 THEN 'RETRY_1' WHEN 1 THEN 'RETRY_2' ELSE 'DLQ' END AS route,
        CASE _retry_count WHEN 0 THEN 1 WHEN 1 THEN 2 END AS next_retry_count,
        CASE _retry_count WHEN 0 THEN 5000 WHEN 1 THEN 10000 END AS delay_ms,
        CASE WHEN _retry_count NOT IN (0, 1) THEN 'HDFS_WRITE_FAILED_AFTER_RETRIES' END
            AS dlq_reason FROM parsed""",
    "land_messages_raw": "SELECT transaction_id, _retry_count, raw_message FROM parsed",
    "land_routes_retried": """SELECT transaction_id, CAST(_retry_count + 1 AS INTEGER)
        AS _retry_count, raw_message FROM parsed WHERE _retry_count IN (0, 1)""",
    "land_routes_dead": """SELECT raw_message, 'HDFS_WRITE_FAILED_AFTER_RETRIES' AS dlq_reason
        FROM parsed WHERE _retry_count NOT IN (0, 1)""",
    "land_messages_good": "SELECT * EXCLUDE (raw_message) FROM parsed",
    # No account, type or merchant in the messages: the type may be missing, the others not.
    "stream_landed_messages": f"""SELECT transaction_id, customer_id, amount, currency, status,
        'rejected' AS outcome, {_reason(STREAM_RULES)} AS rejection_reason FROM (SELECT *,
        CAST(NULL AS VARCHAR) AS transaction_type, CAST(NULL AS VARCHAR) AS account_id,
        CAST(NULL AS VARCHAR) AS merchant FROM parsed)""",
    "land_messages_dead": """SELECT raw AS raw_message, 'INVALID_JSON' AS dlq_reason FROM judged
        WHERE NOT good""",
}

ORACLE = {name: _with(body) for name, body in _BODIES.items()}

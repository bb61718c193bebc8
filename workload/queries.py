"""One query per operator over the test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden import schema as S
from paywarden.functions.columns import with_date_parts, with_event_time
from paywarden.functions.rules import BATCH, STREAM, STRICT, Profile
from paywarden.operators import duplicates as D
from paywarden.operators import fraud as X
from paywarden.operators import messages as M
from paywarden.operators import reports as R
from paywarden.operators import validation as V
from paywarden.plans.batch import BatchRun, run_batch
from paywarden.plans.duplicates import DuplicateRun, run_duplicates, stored_ids
from paywarden.plans.report import report
from paywarden.session import work_folder
from paywarden.plans.partials import ReportPartials
from paywarden.sinks.writers import unseen, write_clustered, write_partitioned, write_table, write_velocity
from paywarden.sources.readers import read_lines, read_table, read_transactions, stream_transactions
from paywarden.streaming import jobs as J
from paywarden.streaming.landing import (
    land_messages,
    land_routes,
    read_dead_letters,
    read_landed,
    stream_landed,
)
from paywarden.streaming.ledger import Ledger
from paywarden.streaming.prepare import checked_stream
from paywarden.streaming.timers import RetryTable, drain, gather, start_retries
from workload.tables import (
    LINE,
    event_stream,
    events,
    messages,
    month,
    sendings,
    transactions,
    wire,
    wire_copies,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register under the function's name; times are returned without a zone."""

    def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = run(spark, sf_dir)
        zoned = [f.name for f in result.schema.fields if isinstance(f.dataType, T.TimestampType)]
        return result.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})

    QUERIES[run.__name__] = plain
    return run


def valid(spark: SparkSession, sf_dir: str, profile: Profile = BATCH, **options) -> DataFrame:
    return V.valid_rows(transactions(spark, sf_dir, **options), profile)


def _stored(spark: SparkSession, kind: str, rows: DataFrame) -> DataFrame:
    """An alert table, derived and written by each query that reports on it."""
    folder = work_folder(spark, kind)
    rows.write.parquet(folder)
    return read_table(spark, folder)


def derived_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert table in squeezed time."""
    rows = valid(spark, sf_dir)
    both = X.all_alerts(X.high_value_alerts(rows), X.velocity_alerts(rows), BATCH)
    return X.stamp_alerts(both, F.col(S.EVENT_TIME))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, "alerts", derived_alerts(spark, sf_dir))


def month_of_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert table in real time, velocity per day."""
    rows = valid(spark, sf_dir, squeezed=False)
    both = X.all_alerts(X.high_value_alerts(rows), X.velocity_alerts(rows, "1 day"), BATCH)
    return _stored(spark, "month-of-alerts", X.stamp_alerts(both, F.col(S.EVENT_TIME)))


# A customer that has alerts in the test tables of every size.
CUSTOMER = "CUST7"

FILTER = {
    "rule": S.HIGH_VALUE_RULE,
    "dates": (dt.date(2024, 1, 5), dt.date(2024, 1, 20)),
}


# --- parsing, validation and routing --------------------------------------------------


@query
def event_time_parts(spark, sf_dir):
    return with_date_parts(with_event_time(wire(spark, sf_dir)))


@query
def json_lines_scan(spark, sf_dir):
    path = work_folder(spark, "json-lines")
    wire(spark, sf_dir).write.json(path)
    return with_event_time(read_transactions(spark, path), keep=False)


@query
def malformed_lines(spark, sf_dir):
    """Lines of a batch run that are no JSON object, from its checked Parquet."""
    source = work_folder(spark, "broken-lines")
    events(spark, sf_dir).select(F.expr(LINE).alias("value")).write.text(source)
    run = BatchRun(work_folder(spark, "batch-output"), "r1")
    run_batch(spark, source, run)
    return run.read_malformed(spark).select(
        "malformed_line", F.col("source_file").contains(source.rsplit("/", 1)[-1]).alias("found_again"))


@query
def lines_with_fields(spark, sf_dir):
    """The fields of the other lines, among them such with a field of the wrong type."""
    source = work_folder(spark, "broken-lines")
    events(spark, sf_dir).select(F.expr(LINE).alias("value")).write.text(source)
    rows = read_lines(spark, source).filter("malformed_line IS NULL")
    return rows.select("transaction_id", "amount", "status")


@query
def validate_batch(spark, sf_dir):
    return V.validate(transactions(spark, sf_dir), BATCH)


@query
def validate_stream(spark, sf_dir):
    return V.validate(transactions(spark, sf_dir), STREAM)


@query
def validate_strict(spark, sf_dir):
    return V.validate(with_event_time(wire(spark, sf_dir), keep=False), STRICT)


@query
def valid_split(spark, sf_dir):
    return V.split(V.validate(transactions(spark, sf_dir), BATCH), BATCH)[0]


@query
def rejected_split(spark, sf_dir):
    return V.split(V.validate(transactions(spark, sf_dir), BATCH), BATCH)[1]


@query
def rejections_by_reason(spark, sf_dir):
    rejected = V.rejected_rows(transactions(spark, sf_dir), BATCH)
    return (
        V.validate(rejected, BATCH)
        .groupBy("rejection_reason")
        .agg(F.count("*").alias("rejected_count"))
    )


@query
def rejections_by_label(spark, sf_dir):
    return V.rejections_by_label(transactions(spark, sf_dir), STREAM)


@query
def normal_transactions(spark, sf_dir):
    return X.normal_value(valid(spark, sf_dir, STREAM))


def _routes(spark, sf_dir, profile):
    routed = X.route(transactions(spark, sf_dir), profile)
    kept = [rows.select(F.lit(name).alias("outcome"), *S.TRANSACTION_COLUMNS)
            for name, rows in routed.items()]
    return kept[0].unionByName(kept[1]).unionByName(kept[2])


@query
def route_batch(spark, sf_dir):
    return _routes(spark, sf_dir, BATCH)


@query
def route_stream(spark, sf_dir):
    return _routes(spark, sf_dir, STREAM)


# --- fraud ------------------------------------------------------------------------------


@query
def high_value_alerts(spark, sf_dir):
    return X.high_value_alerts(valid(spark, sf_dir))


@query
def velocity_counts(spark, sf_dir):
    counts = X.velocity_counts(valid(spark, sf_dir))
    return counts.select(
        "customer_id", F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"), "transaction_count",
    )


@query
def velocity_alerts_default(spark, sf_dir):
    return X.flat_velocity(X.velocity_alerts(valid(spark, sf_dir)))


@query
def velocity_alerts_daily(spark, sf_dir):
    return X.flat_velocity(X.velocity_alerts(valid(spark, sf_dir, squeezed=False), "1 day"))


@query
def velocity_alerts_stream_rules(spark, sf_dir):
    return X.flat_velocity(X.velocity_alerts(valid(spark, sf_dir, STREAM)))


@query
def conform_high_value(spark, sf_dir):
    return X.conform_high_value(X.high_value_alerts(valid(spark, sf_dir)))


@query
def conform_velocity_batch(spark, sf_dir):
    return X.conform_velocity(X.velocity_alerts(valid(spark, sf_dir)), BATCH)


@query
def conform_velocity_stream(spark, sf_dir):
    return X.conform_velocity(X.velocity_alerts(valid(spark, sf_dir, STREAM)), STREAM)


@query
def all_alerts(spark, sf_dir):
    return derived_alerts(spark, sf_dir)


@query
def transaction_summary(spark, sf_dir):
    return X.transaction_summary(transactions(spark, sf_dir), BATCH)


# --- duplicates -------------------------------------------------------------------------


@query
def duplicate_ids(spark, sf_dir):
    return D.duplicate_ids(transactions(spark, sf_dir))


@query
def duplicate_records(spark, sf_dir):
    rows = transactions(spark, sf_dir)
    return D.duplicate_records(rows, stored_ids(rows, work_folder(spark, "repeated-keys")))


@query
def duplicate_records_null_safe(spark, sf_dir):
    rows = transactions(spark, sf_dir)
    ids = stored_ids(rows, work_folder(spark, "repeated-keys"), null_safe=True)
    return D.duplicate_records(rows, ids, null_safe=True)


@query
def dedupe_unique(spark, sf_dir):
    order = [c for c in S.TRANSACTION_COLUMNS if c != "transaction_id"]
    return D.dedupe(transactions(spark, sf_dir), order_by=order)


@query
def duplicate_summary(spark, sf_dir):
    return D.duplicate_summary(transactions(spark, sf_dir))


# --- reports ----------------------------------------------------------------------------


@query
def kpi_transactions(spark, sf_dir):
    return R.kpi_transactions(valid(spark, sf_dir))


@query
def count_successful(spark, sf_dir):
    return R.count_successful(valid(spark, sf_dir))


@query
def kpi_alerts(spark, sf_dir):
    return R.kpi_alerts(alerts(spark, sf_dir))


@query
def kpi_alerts_filtered(spark, sf_dir):
    return R.kpi_alerts(R.alert_filter(month_of_alerts(spark, sf_dir), **FILTER))


@query
def kpi_alerts_no_match(spark, sf_dir):
    return R.kpi_alerts(R.alert_filter(alerts(spark, sf_dir), customer="nobody", rule="All"))


@query
def kpi_alerts_customer(spark, sf_dir):
    return R.kpi_alerts(R.alert_filter(alerts(spark, sf_dir), customer=CUSTOMER))


@query
def date_bounds_no_match(spark, sf_dir):
    return R.date_bounds(R.alert_filter(alerts(spark, sf_dir), customer="nobody"))


@query
def alerts_by_rule(spark, sf_dir):
    return R.alerts_by_rule(alerts(spark, sf_dir))


@query
def alerts_by_customer(spark, sf_dir):
    return R.alerts_by_customer(alerts(spark, sf_dir))


@query
def alerts_by_customer_filtered(spark, sf_dir):
    chosen = report(valid(spark, sf_dir), month_of_alerts(spark, sf_dir), **FILTER)
    return chosen["by_customer"]


@query
def alerts_by_merchant(spark, sf_dir):
    return R.alerts_by_merchant(alerts(spark, sf_dir))


@query
def alerts_by_type(spark, sf_dir):
    return R.alerts_by_type(alerts(spark, sf_dir))


@query
def alerts_by_location(spark, sf_dir):
    return R.alerts_by_location(alerts(spark, sf_dir))


@query
def alert_trend(spark, sf_dir):
    return R.alert_trend(month_of_alerts(spark, sf_dir))


@query
def distinct_customers(spark, sf_dir):
    return R.distinct_values(alerts(spark, sf_dir), "customer_id")


@query
def distinct_rules(spark, sf_dir):
    return R.distinct_values(alerts(spark, sf_dir), "fraud_rule")


@query
def date_bounds(spark, sf_dir):
    return R.date_bounds(month_of_alerts(spark, sf_dir))


@query
def recent_alerts(spark, sf_dir):
    return R.recent_alerts(month_of_alerts(spark, sf_dir))


@query
def recent_alerts_filtered(spark, sf_dir):
    return report(valid(spark, sf_dir), month_of_alerts(spark, sf_dir), **FILTER)["recent"]


def _partials(spark, sf_dir, rows):
    """Partials of an alert table that came in two batches, the second of them twice."""
    partials = ReportPartials(spark, work_folder(spark, "partials"))
    first = F.pmod(F.crc32(F.coalesce("customer_id", F.lit("")).cast("binary")), F.lit(3)) == 0
    partials.add(rows.filter(first), "1")
    for _ in range(2):
        partials.add(rows.filter(~first | (F.col("fraud_rule") == "")), "2")
    return partials


@query
def partial_kpi_alerts(spark, sf_dir):
    return _partials(spark, sf_dir, alerts(spark, sf_dir)).kpi_alerts()


@query
def partial_kpi_alerts_filtered(spark, sf_dir):
    return _partials(spark, sf_dir, month_of_alerts(spark, sf_dir)).kpi_alerts(**FILTER)


@query
def partial_kpi_alerts_customer(spark, sf_dir):
    return _partials(spark, sf_dir, alerts(spark, sf_dir)).kpi_alerts(customer=CUSTOMER)


@query
def partial_alert_trend(spark, sf_dir):
    return _partials(spark, sf_dir, month_of_alerts(spark, sf_dir)).alert_trend()


@query
def partial_alerts_by_rule(spark, sf_dir):
    return _partials(spark, sf_dir, alerts(spark, sf_dir)).alerts_by("fraud_rule", "total_amount")


@query
def partial_alerts_by_customer_filtered(spark, sf_dir):
    return _partials(spark, sf_dir, month_of_alerts(spark, sf_dir)).alerts_by("customer_id", "fraud_amount", **FILTER)


@query
def partial_alerts_by_merchant(spark, sf_dir):
    return _partials(spark, sf_dir, alerts(spark, sf_dir)).alerts_by("merchant")


@query
def partial_date_bounds(spark, sf_dir):
    return _partials(spark, sf_dir, month_of_alerts(spark, sf_dir)).date_bounds()


@query
def clustered_alerts_filtered(spark, sf_dir):
    """A customer's alerts of some days, from files that are laid out for both conditions."""
    path = work_folder(spark, "clustered")
    write_clustered(month_of_alerts(spark, sf_dir), path)
    return R.alert_filter(spark.read.parquet(path), customer=CUSTOMER, dates=FILTER["dates"])


@query
def fraud_summary_view(spark, sf_dir):
    R.register_views(alerts(spark, sf_dir))
    return spark.sql("SELECT * FROM fraud_summary")


@query
def customer_fraud_view(spark, sf_dir):
    R.register_views(alerts(spark, sf_dir))
    return spark.sql("SELECT * FROM customer_fraud")


@query
def daily_fraud_view(spark, sf_dir):
    R.register_views(month_of_alerts(spark, sf_dir))
    return spark.sql("SELECT * FROM daily_fraud")


# --- sinks and batch jobs ---------------------------------------------------------------


@query
def partitioned_roundtrip(spark, sf_dir):
    path = work_folder(spark, "partitioned")
    rows = with_date_parts(with_event_time(wire(spark, sf_dir), keep=False))
    write_partitioned(V.validate(rows, BATCH), path)
    return spark.read.parquet(path)


@query
def velocity_roundtrip(spark, sf_dir):
    path = work_folder(spark, "velocity")
    write_velocity(X.velocity_alerts(valid(spark, sf_dir)), path)
    return read_table(spark, path)


@query
def table_roundtrip(spark, sf_dir):
    path = work_folder(spark, "alerts")
    write_table(alerts(spark, sf_dir).select(*S.ALERT_COLUMNS), path)
    read_table(spark, path, view="stored_alerts")
    return spark.sql("SELECT * FROM stored_alerts")


@query
def unseen_transactions(spark, sf_dir):
    rows = transactions(spark, sf_dir)
    return unseen(rows, X.high_value(rows))


def _batch_run(spark, sf_dir):
    source = work_folder(spark, "batch-input")
    wire(spark, sf_dir).write.json(source)
    run = BatchRun(work_folder(spark, "batch-output"), "r1")
    return run, run_batch(spark, source, run)


@query
def batch_job_summary(spark, sf_dir):
    return _batch_run(spark, sf_dir)[1]


@query
def batch_job_alerts(spark, sf_dir):
    return _batch_run(spark, sf_dir)[0].fraud_alerts(spark)


def _duplicate_run(spark, sf_dir):
    source = work_folder(spark, "duplicates-input")
    wire(spark, sf_dir).write.json(source)
    run = DuplicateRun(work_folder(spark, "duplicates-output"))
    return run, run_duplicates(spark, source, run)


@query
def duplicates_job_summary(spark, sf_dir):
    return _duplicate_run(spark, sf_dir)[1]


@query
def duplicates_job_records(spark, sf_dir):
    return _duplicate_run(spark, sf_dir)[0].read_records(spark)


# --- streaming --------------------------------------------------------------------------


def _job(spark, **change):
    folder = work_folder(spark, "stream")
    return J.StreamJob(f"{folder}/out", f"{folder}/checkpoint",
                       trigger={"availableNow": True}, **change)


def _checked_table(spark, sf_dir):
    """What the stream's micro-batch would hold, as a table without repeated ids."""
    rows = wire_copies(events(spark, sf_dir))
    timed = with_date_parts(with_event_time(rows, keep=False))
    return V.validate(timed, STREAM)


def _send(spark, sf_dir, source, start):
    """The events in four sendings, each read by a start of the query of its own."""
    for rows in sendings(spark, sf_dir):
        rows.write.mode("append").json(source)
        start(stream_transactions(spark, source))


@query
def stream_dedupe(spark, sf_dir):
    folder = work_folder(spark, "stream-dedupe")

    def start(raw):
        checked_stream(raw, salts=4).select(*S.TRANSACTION_COLUMNS).writeStream.format("parquet").option(
            "path", f"{folder}/out"
        ).option("checkpointLocation", f"{folder}/checkpoint").trigger(
            availableNow=True
        ).start().awaitTermination()

    _send(spark, sf_dir, f"{folder}/in", start)
    return spark.read.schema(S.TRANSACTION_TABLE_SCHEMA).parquet(f"{folder}/out")


@query
def stream_dedupe_history(spark, sf_dir):
    """A month in two halves; with the second come copies of the first, two weeks later by their time."""
    job, source = _job(spark, keep_keys=True), work_folder(spark, "history-input")
    rows = month(spark, sf_dir)
    for part in (rows.filter("late_half = 0"), rows.filter("late_half = 1").unionByName(
            rows.filter("late_half = 0 AND transaction_id <> ''").withColumn("timestamp", F.col("two_weeks_on")))):
        part.select(*S.TRANSACTION_SCHEMA.names).write.mode("append").json(source)
        J.start_transactions(stream_transactions(spark, source), job).awaitTermination()
    return J.committed_transactions(spark, job).select(*S.TRANSACTION_COLUMNS)


@query
def stream_routing(spark, sf_dir):
    job = _job(spark)
    _send(spark, sf_dir, work_folder(spark, "stream-input"),
          lambda raw: J.start_transactions(raw, job).awaitTermination())
    rows = J.committed_transactions(spark, job)
    return rows.select("outcome", "rejection_reason", *S.TRANSACTION_COLUMNS, *S.DATE_PARTS)


@query
def stream_routing_one_start(spark, sf_dir):
    """The same rows, all there when the query starts for the first and only time."""
    job, source = _job(spark), work_folder(spark, "stream-input")
    for rows in sendings(spark, sf_dir):
        rows.write.mode("append").json(source)
    J.start_transactions(stream_transactions(spark, source), job).awaitTermination()
    rows = J.committed_transactions(spark, job)
    return rows.select("outcome", "rejection_reason", *S.TRANSACTION_COLUMNS, *S.DATE_PARTS)


def _velocity(spark, sf_dir, mode):
    job = _job(spark)
    _send(spark, sf_dir, work_folder(spark, "stream-input"),
          lambda raw: J.start_velocity(raw, job, mode).awaitTermination())
    return J.committed_velocity(spark, job)


@query
def stream_velocity_append(spark, sf_dir):
    return _velocity(spark, sf_dir, "append").select(*S.VELOCITY_SCHEMA.names)


@query
def stream_velocity_update_latest(spark, sf_dir):
    return J.latest_velocity(_velocity(spark, sf_dir, "update"))


@query
def run_streams(spark, sf_dir):
    """Both queries over landed JSON lines; their alerts in the common layout."""
    job = _job(spark)
    _send(spark, sf_dir, work_folder(spark, "stream-input"), lambda raw: J.run_streams(raw, job))
    high = J.high_value_of(J.committed_transactions(spark, job), job)
    fast = J.latest_velocity(J.committed_velocity(spark, job))
    return X.all_alerts(high, fast, STREAM)


@query
def latest_velocity_two_runs(spark, sf_dir):
    """An older run with a larger batch number, and a newer one that has seen all rows."""
    job = _job(spark)
    rows = valid(spark, sf_dir, STREAM)
    part = rows.filter("amount <= 50000")
    J.process_velocity(X.velocity_alerts(part), 7, job, "r1")
    J.process_velocity(X.velocity_alerts(rows), 0, job, "r2")
    return J.latest_velocity(J.committed_velocity(spark, job))


class _Unmarked(Ledger):
    """A crash after all output and before the mark."""

    def mark_processed(self, query, run_id, batch_id, epoch=None):
        pass


class _Crashing(J.StreamJob):
    def ledger(self, spark):
        return _Unmarked(spark, super().ledger(spark).path)


def _replayed(spark, sf_dir):
    """One micro-batch of each query, appended to tables, lost before its mark, and replayed."""
    folder = work_folder(spark, "replay")
    rows = wire_copies(events(spark, sf_dir), copies="1")
    checked = V.validate(with_date_parts(with_event_time(rows, keep=False)), STREAM)
    velocity = X.velocity_alerts(V.valid_rows(checked, STREAM))
    for kind in (_Crashing, J.StreamJob):
        job = kind(f"{folder}/out", f"{folder}/checkpoint", tables={"folder": f"{folder}/tables"})
        J.process_transactions(checked, 0, job, "r1")
        J.process_velocity(velocity, 0, job, "r1")
    return f"{folder}/tables"


@query
def stream_table_append_replay(spark, sf_dir):
    return read_table(spark, f"{_replayed(spark, sf_dir)}/transactions")


@query
def stream_alert_append_replay(spark, sf_dir):
    return read_table(spark, f"{_replayed(spark, sf_dir)}/fraud_alerts").drop("created_at")


@query
def stream_late_drop(spark, sf_dir):
    """All rows, then all of them again five minutes earlier under new ids: what still gets in."""
    source = work_folder(spark, "late-input")
    rows = wire_copies(events(spark, sf_dir))
    rows.write.json(source)
    job = _job(spark)
    J.start_transactions(stream_transactions(spark, source), job).awaitTermination()
    earlier = F.try_to_timestamp("timestamp") - F.expr("INTERVAL 5 MINUTES")
    rows.withColumns(
        {
            "transaction_id": F.concat(F.lit("AGAIN-"), F.nullif("transaction_id", F.lit(""))),
            "timestamp": F.date_format(earlier, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        }
    ).write.mode("append").json(source)
    J.start_transactions(stream_transactions(spark, source), job).awaitTermination()
    stored = J.committed_transactions(spark, job)
    return stored.filter(F.col("transaction_id").startswith("AGAIN-")).select(
        *S.TRANSACTION_COLUMNS
    )


@query
def stream_late_rows(spark, sf_dir):
    """The other rows of ``stream_late_drop``, stored as late; copies among them are all there."""
    source = work_folder(spark, "late-input")
    rows = wire_copies(events(spark, sf_dir))
    rows.write.json(source)
    job = _job(spark, keep_late=True)
    J.start_transactions(stream_transactions(spark, source), job).awaitTermination()
    earlier = F.try_to_timestamp("timestamp") - F.expr("INTERVAL 5 MINUTES")
    rows.withColumns(
        {
            "transaction_id": F.concat(F.lit("AGAIN-"), F.nullif("transaction_id", F.lit(""))),
            "timestamp": F.date_format(earlier, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        }
    ).write.mode("append").json(source)
    J.start_transactions(stream_transactions(spark, source), job).awaitTermination()
    late = J.late_of(J.committed_transactions(spark, job))
    return late.filter(F.col("transaction_id").startswith("AGAIN-")).select(*S.TRANSACTION_COLUMNS)


COMMITTED = ("run_id", "batch_id", "outcome", *S.TRANSACTION_COLUMNS)


@query
def idempotent_replay(spark, sf_dir):
    """A batch that was written but not marked, and is then replayed."""
    job = _job(spark)
    rows = _checked_table(spark, sf_dir)
    routed = rows.withColumn("outcome", V.outcome(STREAM))
    J.write_batch(routed, job.checked, "r1", 0, ("outcome", *S.DATE_PARTS))
    J.process_transactions(rows, 0, job, "r1")
    return J.committed_transactions(spark, job).select(*COMMITTED)


@query
def ledger_skip(spark, sf_dir):
    """The second delivery of a committed batch is ignored, whatever it holds."""
    job = _job(spark)
    rows = _checked_table(spark, sf_dir)
    J.process_transactions(rows, 0, job, "r1")
    J.process_transactions(rows.unionByName(rows), 0, job, "r1")
    return J.committed_transactions(spark, job).select(*COMMITTED)


@query
def committed_read(spark, sf_dir):
    """Two runs and one unmarked batch; only the marked batches are visible."""
    job = _job(spark)
    rows = _checked_table(spark, sf_dir)
    J.process_transactions(rows, 0, job, "r1")
    J.process_transactions(rows, 0, job, "r2")
    routed = rows.withColumn("outcome", V.outcome(STREAM))
    J.write_batch(routed, job.checked, "r1", 1, ("outcome", *S.DATE_PARTS))
    return J.committed_transactions(spark, job).select(*COMMITTED)


@query
def committed_after_compaction(spark, sf_dir):
    """The rows of ``committed_read``, in batches by event, some of them brought together twice."""
    job = _job(spark)
    rows = _checked_table(spark, sf_dir)
    part = F.pmod(F.crc32(F.coalesce("transaction_id", F.lit("")).cast("binary")), F.lit(6))
    for run_id in ("r1", "r2"):
        for n in range(6):
            J.process_transactions(rows.filter(part == n), n, job, run_id)
            if n in (2, 4):
                J.compact_transactions(spark, job, run_id, at_least=2)
    routed = rows.withColumn("outcome", V.outcome(STREAM))
    J.write_batch(routed, job.checked, "r1", 6, ("outcome", *S.DATE_PARTS))
    return J.committed_transactions(spark, job).select(*COMMITTED).drop("batch_id")


# --- queue messages ---------------------------------------------------------------------

MESSAGE_FIELDS = ("transaction_id", "customer_id", "amount", "currency", "status")


@query
def parse_messages(spark, sf_dir):
    good, _ = M.parse_messages(messages(events(spark, sf_dir)))
    return good.select(*MESSAGE_FIELDS, "_retry_count", "raw_message")


@query
def dead_letters(spark, sf_dir):
    return M.parse_messages(messages(events(spark, sf_dir)))[1]


@query
def retry_count(spark, sf_dir):
    counted = M.with_retry_count(messages(events(spark, sf_dir)))
    return counted.groupBy("_retry_count").agg(F.count("*").alias("messages"))


@query
def route_failed(spark, sf_dir):
    good, _ = M.parse_messages(messages(events(spark, sf_dir)))
    routed = M.route_failed(good)
    return routed.select(
        "transaction_id", "_retry_count", "route", "next_retry_count", "delay_ms", "dlq_reason"
    )


def _landed(spark, sf_dir):
    folder = work_folder(spark, "landing")
    source = messages(event_stream(spark, sf_dir))
    land_messages(source, f"{folder}/out", f"{folder}/checkpoint", once=True).awaitTermination()
    return f"{folder}/out"


@query
def land_messages_good(spark, sf_dir):
    return read_landed(spark, _landed(spark, sf_dir)).select(*MESSAGE_FIELDS, "_retry_count")


@query
def land_messages_raw(spark, sf_dir):
    """Every good message as it came, unknown fields and wrong types included."""
    landed = read_landed(spark, _landed(spark, sf_dir), raw=True)
    return landed.select("transaction_id", "_retry_count", "raw_message")


def _failed_routes(spark, sf_dir):
    folder = work_folder(spark, "routes")
    good, _ = M.parse_messages(messages(events(spark, sf_dir)))
    land_routes(good, folder)
    return folder


@query
def land_routes_retried(spark, sf_dir):
    """Rows of a failed write, read back from the retry table as messages."""
    retry = spark.read.parquet(f"{_failed_routes(spark, sf_dir)}/retry")
    good, _ = M.parse_messages(retry)
    return good.select("transaction_id", "_retry_count", "raw_message")


@query
def land_routes_dead(spark, sf_dir):
    return spark.read.parquet(f"{_failed_routes(spark, sf_dir)}/dead")


@query
def land_messages_dead(spark, sf_dir):
    return read_dead_letters(spark, _landed(spark, sf_dir))


@query
def stream_landed_messages(spark, sf_dir):
    """From raw messages to routed transactions: landing, then the streaming job."""
    job = _job(spark)
    landed = stream_landed(spark, _landed(spark, sf_dir))
    J.start_transactions(landed, job).awaitTermination()
    rows = J.committed_transactions(spark, job)
    return rows.select(*MESSAGE_FIELDS, "outcome", "rejection_reason")


# Times that the write of a message fails, by the number in its id.
_FAILURES = "pmod(CAST(substring(get_json_object({}, '$.transaction_id'), 4) AS BIGINT) div 4, 4)"


@query
def retry_release(spark, sf_dir):
    """Each step at which a failed message comes back, until its write succeeds or it is dead.

    The delays are a tenth of what they are; no row may come back before its own.
    """
    folder = work_folder(spark, "retries")
    table = RetryTable(f"{folder}/table")
    good, _ = M.parse_messages(messages(events(spark, sf_dir)))
    fails = F.coalesce(F.expr(_FAILURES.format("raw_message")), F.lit(0))
    start = good.withColumn("fails", fails).filter("fails > 0")
    # How often a message was tried before the first failure here.
    tried = start.select(F.col("raw_message").alias("raw"), F.col("_retry_count").alias("tried"), "fails")
    tried.write.parquet(f"{folder}/tried")
    table.add_failed(start, "first")

    def attempt(released):
        before = spark.read.parquet(f"{folder}/tried")
        again = released.withColumn("_retry_count", F.col("headers")["retry_count"]).join(before, "raw")
        again = again.filter(F.col("_retry_count") - F.col("tried") < F.col("fails"))
        return again.select(F.col("raw").alias("raw_message"), "_retry_count")

    query = start_retries(spark, table, f"{folder}/checkpoint", attempt, scale=0.1,
                          trigger={"processingTime": "0 seconds"})
    drain(query, lambda: table.waiting(spark) == 0)
    back = table.given_back(spark)
    early = F.coalesce(F.col("released_ms") < F.col("due_ms"), F.lit(False))
    return back.select(F.get_json_object("raw", "$.transaction_id").alias("transaction_id"), "route",
                       "next_retry_count", "dlq_reason", early.alias("early"))


@query
def land_by_count(spark, sf_dir):
    """Messages of eight queues, landed by five or when time is up; the number of each one's batch."""
    folder = work_folder(spark, "by-count")
    stream = event_stream(spark, sf_dir).select("event_id", F.pmod("event_id", F.lit(8)).alias("queue"))
    total = events(spark, sf_dir).count()
    query = (gather(stream, "queue", "event_id", millis=500).writeStream.format("parquet")
             .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").start())

    def landed():
        return spark.read.schema("event_id long, queue long, batch_no long").parquet(f"{folder}/out")

    drain(query, lambda: query.lastProgress is not None and landed().count() == total)
    return landed()

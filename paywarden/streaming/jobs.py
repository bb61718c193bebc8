"""The two streaming queries, their micro-batch writers, and their shutdown."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.window import Window

from paywarden import schema as S
from paywarden.functions.rules import STREAM, Profile
from paywarden.operators.fraud import (
    conform_high_value,
    conform_velocity,
    flat_velocity,
    stamp_alerts,
    tag,
)
from paywarden.operators.validation import HIGH_VALUE, LATE, PROCESSED, REJECTED, outcome
from paywarden.session import require_utc
from paywarden.sinks.writers import append_table
from paywarden.streaming.generations import AT_LEAST, compact
from paywarden.streaming.history import KeyHistory
from paywarden.streaming.ledger import Epoch, Ledger, committed
from paywarden.streaming.prepare import checked_stream, has_key, velocity_stream
from paywarden.streaming.writing import remove, write_batch

TRANSACTIONS_QUERY = "transactions"
VELOCITY_QUERY = "velocity"


@dataclass(frozen=True)
class StreamJob:
    """Where a streaming job keeps things.

    ``tables`` switches on appends to the tables ``transactions`` and ``fraud_alerts``: JDBC
    options with ``url``, or ``folder`` for Parquet folders below it.
    ``run_id`` defaults to the id that Spark stores in the checkpoint, so a new
    checkpoint is a new run. ``compact_every`` brings the micro-batches together whenever so many
    were committed. ``keep_late`` stores rows that come after the watermark under the outcome ``late``;
    ``salts`` are for ids with a large share of the rows. ``keep_keys`` keeps the ids of all batches and
    drops copies that come after the watermark has passed the first.
    """

    output: str
    checkpoint: str
    run_id: str | None = None
    profile: Profile = STREAM
    threshold: float = S.HIGH_VALUE_THRESHOLD
    trigger: dict = field(default_factory=lambda: {"processingTime": "0 seconds"})
    tables: dict | None = None
    compact_every: int | None = None
    keep_late: bool = False
    salts: int = 0
    keep_keys: bool = False

    @property
    def checked(self) -> str:
        return f"{self.output}/checked"

    @property
    def velocity(self) -> str:
        return f"{self.output}/fraud/velocity"

    def ledger(self, spark: SparkSession) -> Ledger:
        return Ledger(spark, f"{self.output}/processed_batches")

    def checked_schema(self) -> T.StructType:
        table = [f for f in S.TRANSACTION_TABLE_SCHEMA.fields]
        flags = [T.StructField(name, T.StringType()) for name in self.profile.flags]
        reason = [T.StructField("rejection_reason", T.StringType())]
        folders = [T.StructField("outcome", T.StringType())]
        folders += [T.StructField(name, T.IntegerType()) for name in S.DATE_PARTS]
        return T.StructType(table + flags + reason + folders)


def _stream_name(query: str, job: StreamJob) -> str:
    """Two jobs may share a session; only one query at a time can own a checkpoint."""
    return f"{query}:{job.checkpoint}"


def _run_of(spark: SparkSession, query: str, job: StreamJob) -> str:
    if job.run_id is not None:
        return job.run_id
    name = _stream_name(query, job)
    return next(q.id for q in spark.streams.active if q.name == name)


class _Turn:
    """The epoch of one start of a query, taken with its first micro-batch."""

    def __init__(self, spark: SparkSession, query: str, job: StreamJob):
        self.spark, self.query, self.job = spark, query, job

    @cached_property
    def epoch(self) -> Epoch:
        return self.job.ledger(self.spark).take(self.query, _run_of(self.spark, self.query, self.job))


def process_transactions(
    batch: DataFrame, batch_id: int, job: StreamJob, run_id: str, epoch: Epoch | None = None
) -> bool:
    """Processed, rejected and high-value rows of one micro-batch, in one write.

    Returns False when the ledger already lists the batch.
    """
    spark = batch.sparkSession
    ledger = job.ledger(spark)
    if ledger.is_processed(TRANSACTIONS_QUERY, run_id, batch_id):
        return False
    again = ledger.begin(TRANSACTIONS_QUERY, run_id, batch_id)
    if job.keep_keys:
        # Stored first: the micro-batch itself is not computed twice.
        stored = f"{job.output}/key_history/rows/{run_id}-{batch_id}"
        batch.write.mode("overwrite").parquet(stored)
        history = KeyHistory(spark, f"{job.output}/key_history/{run_id}")
        batch = history.unseen(spark.read.schema(batch.schema).parquet(stored), str(batch_id))
    routed = batch.withColumn("outcome", outcome(job.profile, job.threshold))
    if job.keep_late:
        late = F.when(F.col("is_late"), F.lit(LATE)).otherwise(F.col("outcome"))
        routed = routed.withColumn("outcome", late).drop("is_late")
    folder = write_batch(routed, job.checked, run_id, batch_id, ("outcome", *S.DATE_PARTS), epoch)
    if job.keep_keys:
        if folder:
            kept = spark.read.schema(job.checked_schema()).parquet(folder).filter(has_key())
            history.add(kept, F.to_date(S.EVENT_TIME), str(batch_id))
        history.done(str(batch_id))
        remove(spark, stored)
    if job.tables and folder:
        # Read back what was written: the batch itself is not computed twice.
        rows = spark.read.schema(job.checked_schema()).parquet(folder)
        append_table(transactions_of(rows, job), "transactions", "transaction_id", again, **job.tables)
        high = stamp_alerts(conform_high_value(high_value_of(rows, job)))
        append_table(high, "fraud_alerts", "fraud_alert_id", again, **job.tables)
    ledger.mark_processed(TRANSACTIONS_QUERY, run_id, batch_id, epoch)
    if job.compact_every:
        compact_transactions(spark, job, run_id, job.compact_every)
    return True


def process_velocity(
    batch: DataFrame, batch_id: int, job: StreamJob, run_id: str, epoch: Epoch | None = None
) -> bool:
    """Velocity alerts of one micro-batch. In the table a window's alert stands once."""
    spark = batch.sparkSession
    ledger = job.ledger(spark)
    if ledger.is_processed(VELOCITY_QUERY, run_id, batch_id):
        return False
    ledger.begin(VELOCITY_QUERY, run_id, batch_id)
    folder = write_batch(flat_velocity(batch), job.velocity, run_id, batch_id, epoch=epoch)
    if job.tables and folder:
        rows = spark.read.schema(S.VELOCITY_SCHEMA).parquet(folder)
        alerts = stamp_alerts(conform_velocity(rows, job.profile))
        # A window whose count grows alerts again, so the keys of the windows' days are looked at.
        append_table(alerts, "fraud_alerts", "fraud_alert_id", True, **job.tables)
    ledger.mark_processed(VELOCITY_QUERY, run_id, batch_id, epoch)
    if job.compact_every:
        compact_velocity(spark, job, run_id, job.compact_every)
    return True


def compact_transactions(spark: SparkSession, job: StreamJob, run_id: str, at_least: int = AT_LEAST) -> bool:
    """Bring the committed micro-batches of the transactions query together."""
    return compact(spark, job.checked, job.checked_schema(), job.ledger(spark), TRANSACTIONS_QUERY, run_id,
                   ("outcome", *S.DATE_PARTS), at_least)


def compact_velocity(spark: SparkSession, job: StreamJob, run_id: str, at_least: int = AT_LEAST) -> bool:
    """Bring the committed micro-batches of the velocity query together."""
    return compact(spark, job.velocity, S.VELOCITY_SCHEMA, job.ledger(spark), VELOCITY_QUERY, run_id, (), at_least)


def transactions_of(rows: DataFrame, job: StreamJob) -> DataFrame:
    """The transactions table: processed rows, ten columns."""
    return rows.filter(F.col("outcome") == PROCESSED).select(*S.TRANSACTION_COLUMNS)


def rejected_of(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("outcome") == REJECTED)


def late_of(rows: DataFrame) -> DataFrame:
    """Rows that came after the watermark, copies included; stored where the job keeps them."""
    return rows.filter(F.col("outcome") == LATE)


def high_value_of(rows: DataFrame, job: StreamJob) -> DataFrame:
    """High-value rows with the fraud columns, which are constants and not stored."""
    return tag(
        rows.filter(F.col("outcome") == HIGH_VALUE),
        S.HIGH_VALUE_RULE,
        f"Transaction amount exceeds {S.CURRENCY} {job.threshold}",
    )


def start_transactions(raw: DataFrame, job: StreamJob) -> StreamingQuery:
    """Query 1: every row, de-duplicated, validated and routed."""
    spark = raw.sparkSession
    require_utc(spark)

    turn = _Turn(spark, TRANSACTIONS_QUERY, job)

    def each(batch: DataFrame, batch_id: int) -> None:
        process_transactions(batch, batch_id, job, turn.epoch.run_id, turn.epoch)

    return (
        checked_stream(raw, job.profile, salts=job.salts, late=job.keep_late)
        .writeStream.queryName(_stream_name(TRANSACTIONS_QUERY, job))
        .foreachBatch(each)
        .option("checkpointLocation", f"{job.checkpoint}/{TRANSACTIONS_QUERY}")
        .trigger(**job.trigger)
        .start()
    )


def start_velocity(
    raw: DataFrame,
    job: StreamJob,
    mode: str = "update",
    window: str = S.VELOCITY_WINDOW,
    threshold: int = S.VELOCITY_THRESHOLD,
) -> StreamingQuery:
    """Query 2: velocity alerts, by default as soon as a window exceeds the limit."""
    spark = raw.sparkSession
    require_utc(spark)

    turn = _Turn(spark, VELOCITY_QUERY, job)

    def each(batch: DataFrame, batch_id: int) -> None:
        process_velocity(batch, batch_id, job, turn.epoch.run_id, turn.epoch)

    return (
        velocity_stream(raw, job.profile, window=window, threshold=threshold)
        .writeStream.queryName(_stream_name(VELOCITY_QUERY, job))
        .outputMode(mode)
        .foreachBatch(each)
        .option("checkpointLocation", f"{job.checkpoint}/{VELOCITY_QUERY}")
        .trigger(**job.trigger)
        .start()
    )


def await_together(queries: Sequence[StreamingQuery], once: bool = False) -> None:
    """Wait for all; when one fails, or one ends in a job that is not ``once``, stop the rest."""
    try:
        while running := [q for q in queries if q.isActive]:
            stopped = len(running) < len(queries)
            if any(q.exception() for q in queries) or (stopped and not once):
                break
            running[0].awaitTermination(1)
    finally:
        for query in queries:
            query.stop()
    for query in queries:
        if query.exception():
            raise query.exception()


def run_streams(raw: DataFrame, job: StreamJob, mode: str = "update") -> list[StreamingQuery]:
    """Both queries side by side until they end."""
    queries = [start_transactions(raw, job), start_velocity(raw, job, mode)]
    await_together(queries, once="availableNow" in job.trigger)
    return queries


def committed_transactions(
    spark: SparkSession, job: StreamJob, run_id: str | None = None
) -> DataFrame:
    """Checked rows of a run's committed micro-batches, with their ``outcome``.

    Without ``run_id`` it is the job's, or else the run that committed last.
    """
    return committed(
        spark, job.checked, job.checked_schema(), job.ledger(spark), TRANSACTIONS_QUERY,
        run_id or job.run_id,
    )


def committed_velocity(
    spark: SparkSession, job: StreamJob, run_id: str | None = None
) -> DataFrame:
    """Velocity alerts of a run's committed micro-batches, repeats included."""
    return committed(
        spark, job.velocity, S.VELOCITY_SCHEMA, job.ledger(spark), VELOCITY_QUERY,
        run_id or job.run_id,
    )


def latest_velocity(alerts: DataFrame, version: str = "batch_id") -> DataFrame:
    """One current alert per customer and window of one run: that of its latest micro-batch.

    Batch numbers of different runs do not compare, so ``alerts`` are those of one run.
    Each task keeps the newest of its versions before the shuffle, and a customer
    with many windows is spread over them.
    """
    keys = ("customer_id", "window_start", "window_end")
    newest = Window.partitionBy(*keys).orderBy(F.desc(version), F.desc("transaction_count"))
    ranked = alerts.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter("_rank = 1").select(*S.VELOCITY_SCHEMA.names)


class LateRows(StreamingQueryListener):
    """Counts rows dropped as later than the watermark, by query id, over whole runs.

    Add it with ``spark.streams.addListener`` before a query starts. Spark reports after
    each micro-batch; ``of`` gives what has been reported so far.
    """

    def __init__(self):
        self.counts: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.ended: set[str] = set()

    def of(self, query: StreamingQuery) -> int:
        return self.counts.get(str(query.id), 0)

    def onQueryStarted(self, event):
        self.counts.setdefault(str(event.id), 0)

    def onQueryProgress(self, event):
        key = str(event.progress.id)
        dropped = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.counts[key] = self.counts.get(key, 0) + dropped
        self.batches[key] = self.batches.get(key, 0) + 1

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.add(str(event.id))

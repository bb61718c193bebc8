"""Rows that wait in state: failed messages until their retry, landed ones until enough are there.

Both use processing-time timers. Spark fixes a micro-batch's time when it plans the batch and
writes it to the checkpoint, so a batch that is run again sets the same timers, and state and timers
come back from the checkpoint: a restart neither loses a row nor gives it twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from operator import itemgetter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from paywarden.operators.messages import DEAD_LETTER_ROUTE, route_failed
from paywarden.session import require_utc
from paywarden.streaming.ledger import Ledger, committed
from paywarden.streaming.writing import batch_exists, write_batch

RETRY_QUERY = "retries"
# Rows of one micro-batch and release time are spread over so many keys.
SLOTS = 64

HELD = T.StructType([
    T.StructField("raw", T.StringType()),
    T.StructField("route", T.StringType()),
    T.StructField("next_retry_count", T.IntegerType()),
    T.StructField("dlq_reason", T.StringType()),
])
RELEASED = T.StructType([*HELD.fields, T.StructField("due_ms", T.LongType()),
                         T.StructField("released_ms", T.LongType())])
_Released = T.Row(*RELEASED.names)


class _Hold(StatefulProcessor):
    """Keeps the rows of a slot and release time until that time; dead letters pass at once."""

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", HELD)

    def handleInputRows(self, key, rows, timerValues):
        now, due = timerValues.getCurrentProcessingTimeInMs(), key[1]
        given = [(r.raw, r.route, r.next_retry_count, r.dlq_reason) for r in rows]
        if due is None or due <= now:
            for row in given:
                yield _Released(*row, due, now)
            return
        self.rows.appendList(given)
        self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentProcessingTimeInMs()
        for row in self.rows.get():
            yield _Released(*row, key[1], now)
        self.rows.clear()

    def close(self) -> None:
        pass


def hold_failed(failed: DataFrame, scale: float = 1.0, slots: int = SLOTS) -> DataFrame:
    """Rows of failed writes, each given back after the delay of its step.

    ``failed`` is a stream with ``raw_message`` and ``_retry_count``. Comes out with the next
    count when the step's delay, times ``scale``, has passed since the micro-batch that brought it; rows out of
    steps come out at once as dead letters. Rows of one micro-batch and release time share
    a timer, and are spread over ``slots`` keys whatever their text is.
    """
    routed = route_failed(failed)
    now = F.unix_millis(F.current_timestamp())
    rows = routed.select(
        F.col("raw_message").alias("raw"), "route", "next_retry_count", "dlq_reason",
        (now + (F.col("delay_ms") * F.lit(scale)).cast("long")).alias("due_ms"),
        F.pmod(F.xxhash64(F.uuid()), F.lit(slots)).alias("slot"))
    return rows.groupBy("slot", "due_ms").transformWithState(
        statefulProcessor=_Hold(), outputStructType=RELEASED, outputMode="append", timeMode="processingTime")


class RetryTable:
    """A folder of failed messages, of those given back, and of dead letters.

    ``failed/`` takes rows with ``raw_message`` and ``_retry_count``; ``released/`` holds what
    came back, by micro-batch, with a ledger beside it.
    """

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def add_failed(self, failed: DataFrame, name: str) -> None:
        """Failed rows under a name of their own; the same name again adds nothing."""
        folder = f"{self.path}/failed/{name}"
        if not batch_exists(failed.sparkSession, folder):
            failed.select("raw_message", F.col("_retry_count").cast("int").alias("_retry_count")) \
                .write.mode("overwrite").parquet(folder)

    def stream(self, spark) -> DataFrame:
        return spark.readStream.schema("raw_message string, _retry_count int").parquet(f"{self.path}/failed/*")

    def ledger(self, spark) -> Ledger:
        return Ledger(spark, f"{self.path}/processed_batches")

    def given_back(self, spark) -> DataFrame:
        """All that came back in committed micro-batches."""
        return committed(spark, f"{self.path}/released", RELEASED, self.ledger(spark), RETRY_QUERY)

    def messages(self, spark) -> DataFrame:
        """Released rows as a message table: raw text and headers with the next count."""
        return as_messages(self.given_back(spark).filter(F.col("route") != DEAD_LETTER_ROUTE))

    def waiting(self, spark) -> int:
        """How many failed rows have not come back yet."""
        # In this order: a batch that is marked in between adds to what is counted last.
        back = self.given_back(spark).count()
        return spark.read.parquet(f"{self.path}/failed/*").count() - back

    def dead_letters(self, spark) -> DataFrame:
        dead = self.given_back(spark).filter(F.col("route") == DEAD_LETTER_ROUTE)
        return dead.select(F.col("raw").alias("raw_message"), "dlq_reason")


def as_messages(released: DataFrame) -> DataFrame:
    return released.select(
        "raw", F.create_map(F.lit("retry_count"), F.col("next_retry_count")).alias("headers"))


def start_retries(
    spark, table: RetryTable, checkpoint: str, attempt: Callable[[DataFrame], DataFrame],
    scale: float = 1.0, trigger: dict | None = None,
) -> StreamingQuery:
    """Give failed messages back after their delay and try them once more.

    ``attempt`` takes released messages (raw, headers), tries to write them, and returns the rows that failed
    again (raw_message, _retry_count); those enter the table anew. A micro-batch is stored, tried
    and marked in this order, and a replay finds its folders: what it stores is what counts.
    """
    require_utc(spark)

    def each(batch: DataFrame, batch_id: int) -> None:
        run_id = next(q.id for q in spark.streams.active if q.name == f"{RETRY_QUERY}:{checkpoint}")
        ledger = table.ledger(spark)
        if ledger.is_processed(RETRY_QUERY, run_id, batch_id):
            return
        folder = write_batch(batch, f"{table.path}/released", run_id, batch_id)
        if folder:
            rows = spark.read.schema(RELEASED).parquet(folder).filter(F.col("route") != DEAD_LETTER_ROUTE)
            table.add_failed(attempt(as_messages(rows)), f"{run_id}-{batch_id}")
        ledger.mark_processed(RETRY_QUERY, run_id, batch_id)

    return (
        hold_failed(table.stream(spark), scale)
        .writeStream.queryName(f"{RETRY_QUERY}:{checkpoint}")
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def drain(query: StreamingQuery, done: Callable[[], bool], timeout: float = 120.0) -> None:
    """Stop the query once ``done``, which is asked about twice a second.

    It is given up when the micro-batches of ``timeout`` seconds have brought no rows; one that runs
    may take as long as it needs.
    """
    finished, seen, quiet, mark = False, -1, 0.0, time.monotonic()
    while query.isActive and not (finished := done()) and quiet < timeout:
        time.sleep(0.5)
        new = [p for p in query.recentProgress if p["batchId"] > seen]
        if any(p["numInputRows"] for p in new):
            quiet, mark = 0.0, time.monotonic()
        elif new or not query.status["isTriggerActive"]:
            # The whole time of what has ended without rows.
            quiet, mark = quiet + time.monotonic() - mark, time.monotonic()
        seen = max([seen, *(p["batchId"] for p in new)])
    query.stop()
    if query.exception():
        raise query.exception()
    if not finished:
        raise TimeoutError("rows still wait")


# Rows that are landed together, and how long the first of them waits at most.
LAND_ROWS = 5
LAND_MILLIS = 5000


class _Gather(StatefulProcessor):
    """Numbers a key's rows in batches of ``size``; an open batch ends when its time is up."""

    def __init__(self, schema: T.StructType, key: str, order: str, size: int, millis: int):
        self.schema, self.key, self.order, self.size, self.millis = schema, key, order, size, millis
        self.row = T.Row(*schema.names, "batch_no")

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.schema)
        self.opened = handle.getValueState("opened", "batch_no long, deadline long")

    def _open(self) -> tuple[int, int | None]:
        return tuple(self.opened.get()) if self.opened.exists() else (0, None)

    def handleInputRows(self, key, rows, timerValues):
        number, deadline = self._open()
        held = [tuple(r) for r in self.waiting.get()]
        place = self.schema.fieldNames().index(self.order)
        known = []
        for row in map(tuple, rows):
            (held if row[place] is None else known).append(row)
        known.sort(key=itemgetter(place))
        held += known
        full = len(held) - len(held) % self.size
        for at in range(full):
            yield self.row(*held[at], number + at // self.size)
        if full:
            held, number, deadline = held[full:], number + full // self.size, None
        if held and deadline is None:
            deadline = timerValues.getCurrentProcessingTimeInMs() + self.millis
            self.handle.registerTimer(deadline)
        self.waiting.clear()
        if held:
            self.waiting.appendList(held)
        self.opened.update((number, deadline))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        number, deadline = self._open()
        # A batch that was full in time has left its timer behind.
        if deadline is None or expiredTimerInfo.getExpiryTimeInMs() < deadline:
            return
        for row in self.waiting.get():
            yield self.row(*row, number)
        self.waiting.clear()
        self.opened.update((number + 1, None))

    def close(self) -> None:
        pass


def gather(rows: DataFrame, key: str, order: str, size: int = LAND_ROWS, millis: int = LAND_MILLIS) -> DataFrame:
    """A stream's rows with ``batch_no``: they leave in batches of ``size`` for each ``key``.

    A batch is complete when it is full, or ``millis`` after its first row came if rows stay
    away. Rows of one micro-batch go by ``order``. ``key`` is the queue or partition that messages
    come from; it bounds what one task sorts together with the source's own limits.
    """
    schema = rows.schema
    out = T.StructType([*schema.fields, T.StructField("batch_no", T.LongType())])
    return rows.groupBy(key).transformWithState(
        statefulProcessor=_Gather(schema, key, order, size, millis), outputStructType=out,
        outputMode="append", timeMode="processingTime")


def land_by_count(
    rows: DataFrame, path: str, checkpoint: str, key: str, order: str,
    size: int = LAND_ROWS, millis: int = LAND_MILLIS, every: str = "1 second",
) -> StreamingQuery:
    """Land rows as JSON lines in batches by count or time, whichever comes first."""
    return (
        gather(rows, key, order, size, millis)
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )

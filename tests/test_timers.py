import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden.streaming import timers as M


def planted(spark, rows):
    return spark.createDataFrame(rows, "raw_message string, _retry_count int")


def drain(spark, table, query):
    M.drain(query, lambda: table.waiting(spark) == 0)


def never_again(messages):
    """An attempt in which every write succeeds."""
    return messages.select(F.col("raw").alias("raw_message"),
                           F.col("headers")["retry_count"].alias("_retry_count")).filter("false")


def always_fails(messages):
    return messages.select(F.col("raw").alias("raw_message"),
                           F.col("headers")["retry_count"].alias("_retry_count"))


def test_failed_rows_come_back_later_and_die_in_the_end(spark, tmp_path):
    table = M.RetryTable(str(tmp_path / "t"))
    rows = [(f"m{n}", n % 3) for n in range(30)] + [("same", 0)] * 20 + [(None, 0)]
    table.add_failed(planted(spark, rows), "first")
    query = M.start_retries(spark, table, str(tmp_path / "c"), always_fails, scale=0.2,
                            trigger={"processingTime": "0 seconds"})
    drain(spark, table, query)
    got = table.given_back(spark).collect()
    steps = {}
    for r in got:
        steps.setdefault(r.raw, []).append((r.route, r.next_retry_count))
        if r.route != "DLQ":
            assert r.released_ms >= r.due_ms
    assert sorted(steps["m0"]) == [("DLQ", None), ("RETRY_1", 1), ("RETRY_2", 2)]
    assert sorted(steps["m1"]) == [("DLQ", None), ("RETRY_2", 2)]
    assert steps["m2"] == [("DLQ", None)]
    assert len(steps["same"]) == 60 and len(steps[None]) == 3
    assert table.dead_letters(spark).count() == 51
    assert {r.dlq_reason for r in table.dead_letters(spark).collect()} == {"HDFS_WRITE_FAILED_AFTER_RETRIES"}
    # Rows of a step waited for the step's delay.
    first = min(r.due_ms for r in got if r.route == "RETRY_1")
    second = max(r.released_ms for r in got if r.route == "RETRY_2" and r.raw == "m0")
    assert second - first >= 2000


def test_a_restart_loses_and_doubles_none(spark, tmp_path):
    table = M.RetryTable(str(tmp_path / "t"))
    table.add_failed(planted(spark, [(f"m{n}", n % 2) for n in range(40)]), "first")
    # The same name again adds nothing.
    table.add_failed(planted(spark, [("other", 0)]), "first")
    options = {"scale": 0.6, "trigger": {"processingTime": "0 seconds"}}
    query = M.start_retries(spark, table, str(tmp_path / "c"), never_again, **options)
    # Stopped while the rows wait, and again when some may have come back.
    for wait in (1, 0):
        end = time.monotonic() + 60
        while (query.lastProgress or {"batchId": -1})["batchId"] < wait and time.monotonic() < end:
            time.sleep(0.05)
        query.stop()
        query = M.start_retries(spark, table, str(tmp_path / "c"), never_again, **options)
    drain(spark, table, query)
    got = [(r.raw, r.next_retry_count) for r in table.given_back(spark).collect()]
    assert sorted(got) == sorted((f"m{n}", n % 2 + 1) for n in range(40))
    assert table.messages(spark).count() == 40 and table.dead_letters(spark).count() == 0


def test_a_crash_after_the_output_is_replayed_once(spark, tmp_path, monkeypatch):
    table = M.RetryTable(str(tmp_path / "t"))
    table.add_failed(planted(spark, [(f"m{n}", 0) for n in range(10)]), "first")
    mark = M.Ledger.mark_processed
    crashes = []

    def crash(self, query, run_id, batch_id):
        if not crashes and list((tmp_path / "t" / "released").rglob("part-*")):
            crashes.append(batch_id)
            raise RuntimeError("lost the driver")
        mark(self, query, run_id, batch_id)

    monkeypatch.setattr(M.Ledger, "mark_processed", crash)
    options = {"scale": 0.1, "trigger": {"processingTime": "0 seconds"}}
    with pytest.raises(Exception, match="lost the driver"):
        drain(spark, table, M.start_retries(spark, table, str(tmp_path / "c"), always_fails, **options))
    drain(spark, table, M.start_retries(spark, table, str(tmp_path / "c"), always_fails, **options))
    got = sorted((r.raw, r.route) for r in table.given_back(spark).collect())
    assert crashes and got == sorted((f"m{n}", route) for n in range(10) for route in ("DLQ", "RETRY_1", "RETRY_2"))


def landed(folder):
    return [json.loads(line) for p in folder.glob("part-*.json") for line in p.read_text().splitlines()]


def test_batches_leave_full_or_in_time(spark, tmp_path):
    source = tmp_path / "in"
    schema = "queue int, place int"

    def send(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(str(source / name))

    send("a", [(0, n) for n in range(12)] + [(1, 7), (1, 3)])
    stream = spark.readStream.schema(schema).json(f"{source}/*")
    query = M.land_by_count(stream, str(tmp_path / "out"), str(tmp_path / "c"), "queue", "place",
                            millis=1500, every="0 seconds")
    end = time.monotonic() + 60
    while len(landed(tmp_path / "out")) < 14 and time.monotonic() < end:
        time.sleep(0.1)
    send("b", [(0, n) for n in range(12, 18)])
    while len(landed(tmp_path / "out")) < 20 and time.monotonic() < end:
        time.sleep(0.1)
    query.stop()
    got = {(r["queue"], r["place"]): r["batch_no"] for r in landed(tmp_path / "out")}
    want = {(0, n): n // 5 for n in range(12)} | {(1, 3): 0, (1, 7): 0}
    want |= {(0, n): 3 for n in range(12, 17)} | {(0, 17): 4}
    assert got == want and len(landed(tmp_path / "out")) == 20


class Running:
    """A query whose first micro-batch runs for ``seconds``, after which it brings no rows."""

    def __init__(self, seconds):
        self.isActive, self.end = True, time.monotonic() + seconds

    @property
    def recentProgress(self):
        return [{"batchId": 0, "numInputRows": 9}] if time.monotonic() > self.end else []

    @property
    def status(self):
        return {"isTriggerActive": time.monotonic() < self.end}

    def stop(self):
        self.isActive = False

    def exception(self):
        return None


def test_a_long_micro_batch_is_waited_for():
    query = Running(3)
    M.drain(query, lambda: bool(query.recentProgress), timeout=1)
    assert not query.isActive
    with pytest.raises(TimeoutError):
        M.drain(Running(0), lambda: False, timeout=1)


class Empty(Running):
    """A query whose micro-batches take a second each and bring no rows."""

    @property
    def recentProgress(self):
        return [{"batchId": n, "numInputRows": 0} for n in range(int(time.monotonic() - self.end))]

    @property
    def status(self):
        return {"isTriggerActive": True}


def test_empty_micro_batches_are_not_waited_for():
    begin = time.monotonic()
    with pytest.raises(TimeoutError):
        M.drain(Empty(0), lambda: False, timeout=3)
    assert time.monotonic() - begin < 5


class Cell:
    """State of one key."""

    def __init__(self):
        self.rows, self.value, self.timers = [], None, []

    def getListState(self, *_):
        return self

    getValueState = getListState

    def get(self):
        return list(self.rows) if self.value is None else self.value

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value = value

    def clear(self):
        self.rows = []

    def appendList(self, rows):
        self.rows += rows

    def registerTimer(self, at):
        self.timers.append(at)

    def getCurrentProcessingTimeInMs(self):
        return 1000


def test_a_large_micro_batch_of_one_queue_takes_time_in_proportion():
    schema = T.StructType([T.StructField("queue", T.LongType()), T.StructField("place", T.LongType())])
    one = M._Gather(schema, "queue", "place", 5, 500)
    cell = Cell()
    one.init(cell)
    one.waiting, one.opened = Cell(), Cell()
    rows = [(0, None), *((0, n) for n in reversed(range(400_000)))]
    begin = time.monotonic()
    got = [tuple(r) for r in one.handleInputRows((0,), iter(rows), cell)]
    assert time.monotonic() - begin < 10
    assert got == [(0, None, 0), *((0, n, (n + 1) // 5) for n in range(399_999))]
    assert one.waiting.rows == [(0, 399_999)] and one.opened.value == (80_000, 1500) and cell.timers == [1500]
    # The open batch goes on.
    more = [tuple(r) for r in one.handleInputRows((0,), iter([(0, 400_000 + n) for n in range(4)]), cell)]
    assert [r[2] for r in more] == [80_000] * 5 and one.opened.value == (80_001, None) and not one.waiting.rows

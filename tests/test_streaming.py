import os
import time

import pytest
from pyspark.sql import functions as F

from paywarden.functions.columns import with_date_parts, with_event_time
from paywarden.functions.rules import STREAM
from paywarden.operators.validation import outcome, validate
from paywarden.schema import TRANSACTION_SCHEMA
from paywarden.sources.readers import stream_transactions
from paywarden.streaming import jobs as J
from paywarden.streaming.ledger import Ledger
from paywarden.streaming.prepare import checked_stream, fold_copies
from rows import DAILY, DAY, REPEATED, STREAM_1, STREAM_2, tx, write_lines


def job_in(folder, **change):
    return J.StreamJob(
        str(folder / "out"), str(folder / "checkpoint"), trigger={"availableNow": True}, **change)


def drop_files(folder, *batches):
    """One file per batch, in order of modification time."""
    for n, rows in enumerate(batches):
        write_lines(folder, f"part-{n}.json", rows)
        os.utime(folder / f"part-{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    return str(folder)


def outcomes(spark, job):
    rows = J.committed_transactions(spark, job)
    return {r.outcome: r["count"] for r in rows.groupBy("outcome").count().collect()}


def run(spark, source, job, **options):
    return J.run_streams(stream_transactions(spark, source, max_files=1), job, **options)


def test_daily_rows(spark, tmp_path):
    job = job_in(tmp_path)
    run(spark, drop_files(tmp_path / "in", DAILY), job)
    assert outcomes(spark, job) == {"processed": 8, "rejected": 3, "high_value": 1}
    rows = J.committed_transactions(spark, job)
    assert J.transactions_of(rows, job).count() == 8
    (high,) = J.high_value_of(rows, job).collect()
    assert (high.transaction_id, high.fraud_rule) == ("A-3", "HIGH_VALUE_TRANSACTION")
    assert {r.transaction_id: r.rejection_reason for r in J.rejected_of(rows).collect()} == {
        "A-4": "INVALID_CUSTOMER",
        "A-5": "INVALID_TRANSACTION_TYPE,INVALID_STATUS",
        "A-6": "INVALID_AMOUNT",
    }
    (fast,) = J.latest_velocity(J.committed_velocity(spark, job)).collect()
    assert (fast.customer_id, fast.transaction_count) == ("ann", 6)


def test_a_micro_batch_is_written_in_few_files(spark, tmp_path):
    rows = [tx(f"T{n}", f"C{n % 5}", at=f"{DAY}10:00:{n % 60:02d}") for n in range(400)]
    job = job_in(tmp_path)
    run(spark, drop_files(tmp_path / "in", rows), job)
    assert outcomes(spark, job) == {"processed": 400}
    files = [p for p in (tmp_path / "out" / "checked").rglob("*.parquet") if "batch_id=0" in str(p)]
    assert len(files) == 1
    alerts = list((tmp_path / "out" / "fraud" / "velocity").rglob("*.parquet"))
    assert len([p for p in alerts if "batch_id=0" in str(p)]) == 1
    assert J.committed_velocity(spark, job).count() == 5


def test_two_micro_batches(spark, tmp_path):
    job = job_in(tmp_path)
    run(spark, drop_files(tmp_path / "in", STREAM_1, STREAM_2), job)
    rows = J.committed_transactions(spark, job)
    counted = rows.groupBy("batch_id", "outcome").count().collect()
    got = {(r.batch_id, r.outcome): r["count"] for r in counted}
    assert got == {(0, "processed"): 2, (0, "high_value"): 1, (1, "processed"): 1, (1, "high_value"): 1}


def test_stream_equals_batch(spark, tmp_path):
    odd = [tx(f"O{n}", **c) for n, c in enumerate([
        {"currency": None}, {"kind": None}, {"customer": ""}, {"amount": float("nan")},
        {"at": "?"}, {"merchant": ""}, {"amount": 100000.01}])]
    rows = DAILY + odd
    job = job_in(tmp_path)
    run(spark, drop_files(tmp_path / "in", rows), job)
    table = with_date_parts(
        with_event_time(spark.createDataFrame(rows, TRANSACTION_SCHEMA), keep=False))
    want = validate(table, STREAM).withColumn("outcome", outcome(STREAM))
    got = J.committed_transactions(spark, job).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_copies_and_rows_without_id(spark, tmp_path):
    rows = REPEATED + [tx(None, "n1"), tx(None, "n2"), tx("", "b1"), tx("", "b2")]
    job = job_in(tmp_path)
    run(spark, drop_files(tmp_path / "in", rows, REPEATED), job)
    # three ids once each; rows that cannot be told apart by id are all kept as rejected
    assert outcomes(spark, job) == {"processed": 3, "rejected": 4}


def test_unkeyed_rows_can_take_part_in_dedupe(spark, tmp_path):
    source = drop_files(tmp_path / "in", [tx(None, "n1"), tx(None, "n2"), tx("", "b1"), tx("", "b2")])
    stream = checked_stream(stream_transactions(spark, source), keep_unkeyed=False)
    query = (stream.writeStream.format("parquet").option("path", str(tmp_path / "o"))
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2


@pytest.mark.parametrize("bounded, copies", [(True, 2), (False, 1)])
def test_memory_of_ids(spark, tmp_path, bounded, copies):
    late = tx("OLD", at=DAY + "14:00:00"), tx("MID", at=DAY + "15:00:00")
    again = tx("OLD", at=DAY + "15:10:00")
    source = drop_files(tmp_path / "in", [late[0]], [late[1]], [tx("X", at=DAY + "15:01:00")], [again])
    stream = checked_stream(stream_transactions(spark, source, max_files=1), bounded=bounded)
    query = (stream.writeStream.format("parquet").option("path", str(tmp_path / "o"))
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "o"))
    assert got.filter("transaction_id = 'OLD'").count() == copies


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    source = drop_files(
        tmp_path / "in", [tx("A", at=DAY + "15:00:00")], [tx("B", at=DAY + "15:01:00")],
        [tx("LATE", at=DAY + "14:40:00"), tx("EDGE", at=DAY + "14:51:00.001")])
    job = job_in(tmp_path)
    late = counting(spark)
    query = J.start_transactions(stream_transactions(spark, source, max_files=1), job)
    query.awaitTermination()
    ids = {r.transaction_id for r in J.committed_transactions(spark, job).collect()}
    assert ids == {"A", "B", "EDGE"}
    assert reported(spark, late, query) == 1


def counting(spark):
    late = J.LateRows()
    spark.streams.addListener(late)
    return late


def reported(spark, late, query):
    """Late rows once Spark has reported the end of the query."""
    for _ in range(300):
        if str(query.id) in late.ended:
            break
        time.sleep(0.1)
    spark.streams.removeListener(late)
    return late.of(query)


def test_late_rows_are_counted_over_more_batches_than_spark_remembers(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "100")
    try:
        files = [[tx("NOW", at=DAY + "15:00:00")]] + [
            [tx(f"L{n}", at=DAY + "14:00:00"), tx(f"N{n}", at=f"{DAY}15:00:{n % 60:02d}")] for n in range(104)]
        source = drop_files(tmp_path / "in", *files)
        late = counting(spark)
        raw = checked_stream(stream_transactions(spark, source, max_files=1), fold=False)
        query = (raw.writeStream.format("parquet").option("path", str(tmp_path / "o"))
                 .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
        query.awaitTermination()
        # The first file sets the watermark; the late row of the next comes in the same breath.
        assert reported(spark, late, query) in (103, 104)
        assert late.batches[str(query.id)] > 100 >= len(query.recentProgress)
        kept = spark.read.parquet(str(tmp_path / "o")).filter("transaction_id LIKE 'L%'").count()
        assert late.of(query) + kept == 104
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_a_copy_without_a_readable_time_is_stored_once(spark, tmp_path):
    odd = [tx("X", at="nope"), tx("Y", at=None), tx("Z", at=DAY + "15:00:00")]
    source = drop_files(tmp_path / "in", odd, [tx("W", at=DAY + "15:09:00")], odd,
                        [tx("Z", at="nope"), tx("X", at=DAY + "15:08:00")])
    job = job_in(tmp_path)
    J.start_transactions(stream_transactions(spark, source, max_files=1), job).awaitTermination()
    rows = J.committed_transactions(spark, job).collect()
    assert sorted(r.transaction_id for r in rows) == ["W", "X", "Y", "Z"]
    assert {r.transaction_id for r in rows if r.transaction_timestamp is None} == {"X", "Y"}
    assert {r.transaction_id for r in rows if r.day is None} == {"X", "Y"}


def test_idle_batches_write_nothing(spark, tmp_path):
    job = job_in(tmp_path)
    quiet = [[tx(f"Q{n}", f"q{n}", at=f"{DAY}15:0{n}:00")] for n in range(4)]
    source = drop_files(tmp_path / "in", *quiet)
    J.start_velocity(stream_transactions(spark, source, max_files=1), job).awaitTermination()
    assert not list((tmp_path / "out" / "fraud").rglob("part-*"))
    assert not list((tmp_path / "out" / "fraud").rglob("_SUCCESS"))
    assert job.ledger(spark).mark(J.VELOCITY_QUERY).batch_id >= 3
    assert J.committed_velocity(spark, job).count() == 0


def busy(n, first=0):
    return [tx(f"V{k}", "CV", at=f"{DAY}12:0{k // 2}:{30 * (k % 2):02d}") for k in range(first, n)]


def test_update_mode_repeats_and_append_mode_does_not(spark, tmp_path):
    later = [tx("END", "CE", at=DAY + "13:00:00")], [tx("END2", "CE", at=DAY + "13:01:00")]
    source = drop_files(tmp_path / "in", busy(6), busy(7, 6), *later)
    counts = {}
    for mode in ("update", "append"):
        job = job_in(tmp_path / mode)
        query = J.start_velocity(stream_transactions(spark, source, max_files=1), job, mode)
        query.awaitTermination()
        alerts = J.committed_velocity(spark, job)
        counts[mode] = sorted(r.transaction_count for r in alerts.collect())
        assert [r.transaction_count for r in J.latest_velocity(alerts).collect()] == [7]
    assert counts == {"update": [6, 7], "append": [7]}


def checked_batch(spark, rows):
    table = with_date_parts(
        with_event_time(spark.createDataFrame(rows, TRANSACTION_SCHEMA), keep=False))
    return validate(table, STREAM)


def test_replayed_batch(spark, tmp_path):
    job = job_in(tmp_path)
    batch = checked_batch(spark, DAILY)
    assert J.process_transactions(batch, 0, job, "r1")
    before = sorted(map(str, J.committed_transactions(spark, job).collect()))
    assert not J.process_transactions(batch, 0, job, "r1")
    assert sorted(map(str, J.committed_transactions(spark, job).collect())) == before
    # the same number under a new checkpoint is another batch
    assert J.process_transactions(batch, 0, job, "r2")
    assert J.committed_transactions(spark, job).count() == 12
    assert J.committed_transactions(spark, job, "r1").select("run_id").distinct().first()[0] == "r1"


def test_replay_after_a_crash_replaces_the_whole_batch(spark, tmp_path):
    job = job_in(tmp_path)
    parts = ("outcome", "year", "month", "day")

    def written(rows):
        batch = checked_batch(spark, rows).withColumn("outcome", outcome(STREAM))
        J.write_batch(batch, job.checked, "r1", 3, parts)

    written([tx("A"), tx("B", at="2027-03-09T10:00:00")])
    # written but not marked: invisible
    assert J.committed_transactions(spark, job).count() == 0
    written([tx("A"), tx("B", at="2027-03-10T10:00:00")])
    job.ledger(spark).mark_processed(J.TRANSACTIONS_QUERY, "r1", 3)
    days = {r.transaction_id: r.day for r in J.committed_transactions(spark, job).collect()}
    assert days == {"A": 8, "B": 10}


def test_crash_between_write_and_mark(spark, tmp_path, monkeypatch):
    source = drop_files(tmp_path / "in", DAILY, STREAM_1)
    job = job_in(tmp_path)
    mark = Ledger.mark_processed

    def crash(*_):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(Ledger, "mark_processed", crash)
    with pytest.raises(Exception, match="lost the driver"):
        run(spark, source, job)
    assert J.committed_transactions(spark, job).count() == 0
    monkeypatch.setattr(Ledger, "mark_processed", mark)
    run(spark, source, job)
    assert outcomes(spark, job) == {"processed": 10, "rejected": 3, "high_value": 2}
    # nothing new: a further start adds nothing
    run(spark, source, job)
    assert J.committed_transactions(spark, job).count() == 15
    assert J.committed_transactions(spark, job).select("run_id").distinct().count() == 1


def test_hot_id_is_folded_in_front_of_the_state_store(spark, tmp_path):
    rows = [tx("HOT" if n % 3 == 0 else f"K{n}", at=f"{DAY}10:{n % 60:02d}:00") for n in range(6000)]
    source = drop_files(tmp_path / "in", rows)
    dropped = {}
    for fold in (True, False):
        stream = checked_stream(stream_transactions(spark, source), fold=fold)
        folder = tmp_path / str(fold)
        query = (stream.writeStream.format("parquet").option("path", str(folder / "o"))
                 .option("checkpointLocation", str(folder / "c")).trigger(availableNow=True).start())
        query.awaitTermination()
        assert spark.read.parquet(str(folder / "o")).count() == 4001
        dropped[fold] = sum(
            op["customMetrics"]["numDroppedDuplicateRows"]
            for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == {True: 0, False: 1999}


def test_ledger(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.marks("q") == [] and ledger.mark("q") is None
    assert not ledger.is_processed("q", "r", 0)
    assert not ledger.begin("q", "r", 0) and ledger.begin("q", "r", 0)
    assert not ledger.is_processed("q", "r", 0)
    for n in (0, 0, 1, 2, 1):
        ledger.mark_processed("q", "r", n)
    assert ledger.is_processed("q", "r", 0) and ledger.is_processed("q", "r", 2)
    for other in (("q", "r", 3), ("q", "s", 0), ("p", "r", 0)):
        assert not ledger.is_processed(*other)
    (mark,) = ledger.marks("q")
    assert (mark.run_id, mark.batch_id) == ("r", 2)
    assert abs(mark.at / 1000 - time.time()) < 60
    # one mark a run is left, however many batches there were
    assert len([p for p in (tmp_path / "ledger").rglob("done-*")]) == 1
    time.sleep(0.01)
    ledger.mark_processed("q", "s", 0)
    assert [m.run_id for m in ledger.marks("q")] == ["s", "r"]
    assert ledger.mark("q", "r").batch_id == 2


def test_committed_read_skips_folders_of_other_batches(spark, tmp_path):
    job = job_in(tmp_path)
    for n in range(3):
        J.process_transactions(checked_batch(spark, [tx(f"T{n}")]), n, job, "r1")
    rows = J.committed_transactions(spark, job)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "batch_id" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert rows.count() == 3


def test_stop_together_when_one_fails(spark, tmp_path):
    source = drop_files(tmp_path / "in", DAILY)

    def broken(batch, batch_id):
        raise ValueError("broken sink")

    raw = stream_transactions(spark, source)
    bad = (raw.writeStream.foreachBatch(broken).option("checkpointLocation", str(tmp_path / "c1"))
           .start())
    good = J.start_transactions(raw, J.StreamJob(str(tmp_path / "o"), str(tmp_path / "c2")))
    with pytest.raises(Exception, match="broken sink"):
        J.await_together([good, bad])
    assert not good.isActive and not bad.isActive


def test_folding_keeps_every_key_and_the_latest_copy(spark):
    rows = [tx(f"K{n % 7}", amount=float("nan") if n == 20 else float(n),
               at=None if n % 5 == 0 else f"{DAY}10:00:{n:02d}") for n in range(21)]
    table = with_event_time(spark.createDataFrame(rows, TRANSACTION_SCHEMA).coalesce(1))
    folded = fold_copies(table)
    assert folded.schema == table.schema
    newest = {r.transaction_id: r.t for r in
              table.groupBy("transaction_id").agg(F.max("transaction_timestamp").alias("t")).collect()}
    got = folded.collect()
    assert {r.transaction_id: r.transaction_timestamp for r in got} == newest
    assert len(got) == 7
    # NULL and NaN amounts come through as they are
    odd = spark.createDataFrame([tx("A", amount=float("nan")), tx("B", amount=None)], TRANSACTION_SCHEMA)
    back = {r.transaction_id: r.amount for r in fold_copies(with_event_time(odd)).collect()}
    assert back["A"] != back["A"] and back["B"] is None

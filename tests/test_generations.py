import shutil
import threading

import pytest
from pyspark.sql import functions as F

from paywarden import schema as S
from paywarden.operators.fraud import velocity_alerts
from paywarden.operators.validation import validate
from paywarden.functions.columns import with_date_parts, with_event_time
from paywarden.functions.rules import STREAM
from paywarden.schema import TRANSACTION_SCHEMA
from paywarden.sinks import writers as W
from paywarden.sources.readers import read_table
from paywarden.streaming import generations as G
from paywarden.streaming import jobs as J
from paywarden.streaming.ledger import Fenced, Ledger
from rows import DAY, tx


def job_in(folder, **change):
    return J.StreamJob(str(folder / "out"), str(folder / "checkpoint"), **change)


def checked(spark, rows):
    table = with_date_parts(with_event_time(spark.createDataFrame(rows, TRANSACTION_SCHEMA), keep=False))
    return validate(table, STREAM)


def ids(frame):
    return sorted((r.batch_id, r.transaction_id) for r in frame.select("batch_id", "transaction_id").collect())


def small(spark, folder, ledger, n, first=0):
    """Batches of two rows each under a plain schema."""
    for k in range(first, first + n):
        rows = spark.createDataFrame([(k, f"{k}a"), (k, f"{k}b")], "day int, transaction_id string")
        rows.coalesce(1).write.mode("overwrite").partitionBy("day").parquet(
            f"{folder}/run_id=r/batch_id={k}")
        ledger.mark_processed("q", "r", k)


SCHEMA = "transaction_id string, day int"


def test_many_batches_become_few_folders(spark, tmp_path, monkeypatch):
    path, ledger = str(tmp_path / "data"), Ledger(spark, str(tmp_path / "ledger"))
    schema = spark.createDataFrame([], SCHEMA).schema
    # Folders are made by plain files: the batches themselves are not what is tested.
    one = spark.createDataFrame([("x", 1)], SCHEMA).coalesce(1)
    one.write.partitionBy("day").parquet(str(tmp_path / "one"))
    for k in range(200):
        shutil.copytree(tmp_path / "one", tmp_path / "data" / "run_id=r" / f"batch_id={k}")
        ledger.mark_processed("q", "r", k)
        if k % 10 == 9:
            assert G.compact(spark, path, schema, ledger, "q", "r", ("day",), at_least=10, fan=4)
    rows = J.committed(spark, path, schema, ledger, "q")
    assert [r.batch_id for r in rows.orderBy("batch_id").collect()] == list(range(200))
    folders = {f.rsplit("/day=", 1)[0] for f in rows.inputFiles()}
    assert len(folders) == len(ledger.manifest("q", "r").generations) <= 8
    assert not any("batch_id=" in f for f in folders)
    # Old folders go when the manifest is old enough; what is read stays.
    assert G.vacuum(spark, path, ledger, "q", "r") == 0
    assert G.vacuum(spark, path, ledger, "q", "r", older_than=0) > 200
    assert J.committed(spark, path, schema, ledger, "q").count() == 200
    assert not list((tmp_path / "data" / "run_id=r").iterdir())


def test_reads_around_a_compaction_see_every_row_once(spark, tmp_path):
    path, ledger = str(tmp_path / "data"), Ledger(spark, str(tmp_path / "ledger"))
    schema = spark.createDataFrame([], SCHEMA).schema
    small(spark, path, ledger, 6)
    want = sorted((k, f"{k}{x}") for k in range(6) for x in "ab")
    before = J.committed(spark, path, schema, ledger, "q")
    assert not G.compact(spark, path, schema, ledger, "q", "r", ("day",), at_least=7)
    assert G.compact(spark, path, schema, ledger, "q", "r", ("day",), at_least=3)
    small(spark, path, ledger, 1, first=6)
    # A reader from before keeps its files, a new one sees the newer batch too.
    assert ids(before) == want
    assert ids(J.committed(spark, path, schema, ledger, "q")) == want + [(6, "6a"), (6, "6b")]
    assert J.committed(spark, path, schema, ledger, "q").filter("batch_id = 3").count() == 2


def test_a_crash_before_the_swap_changes_nothing(spark, tmp_path, monkeypatch):
    path, ledger = str(tmp_path / "data"), Ledger(spark, str(tmp_path / "ledger"))
    schema = spark.createDataFrame([], SCHEMA).schema
    small(spark, path, ledger, 4)
    publish = Ledger.publish

    def crash(*_):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(Ledger, "publish", crash)
    with pytest.raises(RuntimeError):
        G.compact(spark, path, schema, ledger, "q", "r", ("day",), at_least=2)
    assert J.committed(spark, path, schema, ledger, "q").count() == 8
    monkeypatch.setattr(Ledger, "publish", publish)
    # Another compaction publishes first: this one gives way and leaves no folder.
    def late(self, query, run_id, manifest):
        assert publish(self, query, run_id, manifest)
        return publish(self, query, run_id, manifest)

    monkeypatch.setattr(Ledger, "publish", late)
    assert not G.compact(spark, path, schema, ledger, "q", "r", ("day",), at_least=2)


def test_jobs_compact_as_they_go(spark, tmp_path):
    job = job_in(tmp_path, compact_every=3)
    for n in range(7):
        J.process_transactions(checked(spark, [tx(f"T{n}")]), n, job, "r1")
    kept = job.ledger(spark).manifest(J.TRANSACTIONS_QUERY, "r1").generations
    assert [(g.first, g.last) for g in kept] == [(0, 2), (3, 5)]
    rows = J.committed_transactions(spark, job)
    assert ids(rows) == [(n, f"T{n}") for n in range(7)]
    assert rows.select("outcome", "day").distinct().collect() == [("processed", 8)]


def test_an_older_driver_cannot_commit(spark, tmp_path):
    job = job_in(tmp_path)
    ledger = job.ledger(spark)
    old = ledger.take("transactions", "r1")
    assert J.process_transactions(checked(spark, [tx("A")]), 0, job, "r1", old)
    new = ledger.take("transactions", "r1")
    with pytest.raises(Fenced):
        J.process_transactions(checked(spark, [tx("B")]), 1, job, "r1", old)
    assert J.process_transactions(checked(spark, [tx("C")]), 1, job, "r1", new)
    assert ids(J.committed_transactions(spark, job)) == [(0, "A"), (1, "C")]
    assert not list((tmp_path / "out" / "checked" / "_staged").iterdir())


def test_of_two_writers_one_wins(spark, tmp_path):
    """Both drivers try the same batch at the same time."""
    job = job_in(tmp_path)
    ledger = job.ledger(spark)
    rows = checked(spark, [tx("A"), tx("B")])
    done = []

    def work(epoch):
        try:
            done.append(J.process_transactions(rows, 0, job, "r", epoch))
        except Fenced:
            done.append("fenced")

    epochs = [ledger.take(J.TRANSACTIONS_QUERY, "r") for _ in range(2)]
    threads = [threading.Thread(target=work, args=(e,)) for e in epochs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(map(str, done)) in (["True", "fenced"], ["False", "True"])
    assert ids(J.committed_transactions(spark, job)) == [(0, "A"), (0, "B")]


def test_a_crash_between_name_and_mark_is_replayed_by_the_next_epoch(spark, tmp_path, monkeypatch):
    job = job_in(tmp_path)
    mark = Ledger.mark_processed
    monkeypatch.setattr(Ledger, "mark_processed", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        J.process_transactions(checked(spark, [tx("A"), tx("B")]), 0, job, "r",
                               job.ledger(spark).take(J.TRANSACTIONS_QUERY, "r"))
    assert J.committed_transactions(spark, job).count() == 0
    monkeypatch.setattr(Ledger, "mark_processed", mark)
    assert J.process_transactions(checked(spark, [tx("A")]), 0, job, "r",
                                  job.ledger(spark).take(J.TRANSACTIONS_QUERY, "r"))
    assert ids(J.committed_transactions(spark, job)) == [(0, "A")]


def busy(day, customers, n=6):
    return [tx(f"{day}-{c}-{k}", f"C{c}", at=f"2027-04-{day:02d}T12:00:{k:02d}")
            for c in range(customers) for k in range(n)]


def test_alert_append_reads_only_the_days_of_its_windows(spark, tmp_path, monkeypatch):
    """What is read of the table for a batch does not grow with the table's other days."""
    job = job_in(tmp_path, tables={"folder": str(tmp_path / "tables")})
    read, plans = [], []
    unseen = W.unseen

    def seen(df, existing, key):
        keys = existing.select(key)
        plans.append(existing._jdf.queryExecution().executedPlan().toString())
        read.append(keys.count())
        return unseen(df, existing, key)

    monkeypatch.setattr(W, "unseen", seen)
    for n, day in enumerate((1, 2, 3, 4, 4)):
        alerts = velocity_alerts(checked(spark, busy(day, 5 + (n == 4))))
        J.process_velocity(alerts, n, job, "r1")
    table = read_table(spark, f"{job.tables['folder']}/fraud_alerts")
    assert table.count() == 5 * 4 + 1
    assert "table_day" not in table.columns
    # The last batch met the five alerts of its own day and none of the fifteen others.
    assert read == [0, 0, 0, 5]
    assert all("PartitionFilters: [isnotnull(table_day" in p for p in plans)


def test_rows_without_a_time_are_looked_up_too(spark, tmp_path):
    folder = str(tmp_path / "tables")
    schema = f"fraud_alert_id string, {S.EVENT_TIME} timestamp"
    rows = spark.createDataFrame([("a", None), ("b", None)], schema)
    W.append_table(rows, "fraud_alerts", "fraud_alert_id", folder=folder)
    more = rows.unionByName(spark.createDataFrame([("c", None)], schema)).withColumn(
        S.EVENT_TIME, F.when(F.col("fraud_alert_id") == "c", F.lit(DAY + "10:00:00").cast("timestamp")))
    W.append_table(more, "fraud_alerts", "fraud_alert_id", True, folder=folder)
    got = read_table(spark, f"{folder}/fraud_alerts")
    assert sorted(r.fraud_alert_id for r in got.collect()) == ["a", "b", "c"]

import glob

import pytest

from paywarden.session import build_session, require_utc, work_folder
from paywarden.sinks import writers as W
from paywarden.sources.readers import read_table
from paywarden.streaming.jobs import StreamJob


def test_partitioned_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame(
        [(1, 2026, 9, 25), (2, 2026, 9, 26), (3, None, None, None)], "id int, year int, month int, day int")
    W.write_partitioned(rows, path)
    W.write_partitioned(rows.filter("id = 1"), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 4 and stored.filter("year IS NULL").count() == 1
    assert glob.glob(f"{path}/year=2026/month=9/day=25/*.parquet")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        W.write_partitioned(rows.filter("id = 2"), path, mode="overwrite")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.id for r in spark.read.parquet(path).collect()] == [2]


def test_a_heavy_day_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(0, 200000, 1, 8).selectExpr(
        "id", "uuid() AS text", "2026 AS year", "9 AS month", "if(id % 100 = 0, 1 + id % 28, 28) AS day")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        W.write_partitioned(rows, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {d: len(glob.glob(f"{path}/year=2026/month=9/day={d}/*.parquet")) for d in (1, 28)}
    assert files[28] > 3
    # a quiet day is not spread over all eight input tasks
    assert files[1] == 1
    assert spark.read.parquet(path).count() == 200000


def test_capped_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(0, 100, 1, 8).selectExpr("id", "2026 AS year", "1 AS month", "1 AS day")
    W.write_partitioned(rows, path, coalesce_to=2)
    assert len(glob.glob(f"{path}/*/*/*/*.parquet")) == 2


def test_write_if_any(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(3)
    assert W.write_if_any(rows, path)
    assert not W.write_if_any(rows.limit(0), path)
    assert not W.write_if_any(rows, path, evidence=rows.limit(0))
    assert spark.read.parquet(path).count() == 3


def test_tables_and_preview(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "transaction_id string, n int")
    W.write_table(rows, path)
    W.write_table(rows, path)
    assert read_table(spark, path, view="stored").count() == 6
    assert spark.sql("SELECT sum(n) FROM stored").first()[0] == 12
    assert W.preview(rows, ["n"], 2).collect()[0].asDict().keys() == {"n"}
    known = rows.filter("n = 1")
    assert {r.n for r in W.unseen(rows, known).collect()} == {2, 3}


class Recorder:
    """Stands in for a writer; no database is started for tests."""

    def __init__(self):
        self.calls = []
        self.write = self

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


def test_jdbc_options_are_passed_through():
    rows = Recorder()
    W.write_table(rows, "fraud_alerts", url="jdbc:x:y", numPartitions=4)
    assert rows.calls == [
        ("format", ("jdbc",), {}), ("mode", ("append",), {}),
        ("options", (), {"dbtable": "fraud_alerts", "url": "jdbc:x:y", "numPartitions": 4}),
        ("save", (), {}),
    ]


def test_jdbc_appends_of_a_micro_batch(spark, tmp_path, monkeypatch):
    from paywarden.streaming import jobs as J
    from rows import DAILY
    from test_streaming import checked_batch

    sent = []
    monkeypatch.setattr(J, "append_table", lambda df, target, key, again, **o: sent.append(
        (target, df.count(), again, o)))
    job = StreamJob(str(tmp_path / "o"), str(tmp_path / "c"), tables={"url": "jdbc:x:y"})
    J.process_transactions(checked_batch(spark, DAILY), 0, job, "r1")
    assert sent == [("transactions", 8, False, job.tables), ("fraud_alerts", 1, False, job.tables)]
    # a replayed batch is not sent again
    J.process_transactions(checked_batch(spark, DAILY), 0, job, "r1")
    assert len(sent) == 2


def test_work_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first.startswith(base) and first != second


def test_build_session_reuses_the_running_one(spark):
    assert build_session("other").sparkContext is spark.sparkContext


def test_a_batch_run_again_appends_nothing(spark, tmp_path):
    from paywarden.plans.batch import BatchRun, run_batch
    from rows import DAILY, write_lines

    source = write_lines(tmp_path / "in", "a.json", DAILY)
    tables = {"folder": str(tmp_path / "tables")}
    for _ in range(2):
        run_batch(spark, source, BatchRun(str(tmp_path / "out"), "r1"), tables)
    assert read_table(spark, f"{tables['folder']}/transactions").count() == 9
    assert read_table(spark, f"{tables['folder']}/fraud_alerts").count() == 2


def test_work_needs_a_shared_folder_and_utc(spark):
    from types import SimpleNamespace

    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None),
                           sparkContext=SimpleNamespace(getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="checkpoint"):
        work_folder(bare, "x")
    require_utc(spark)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        with pytest.raises(ValueError, match="UTC"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

import datetime as dt
import os

from pyspark.sql import functions as F

from paywarden.sources.readers import stream_transactions
from paywarden.streaming import jobs as J
from paywarden.streaming.history import KeyHistory
from rows import tx, write_lines


def on(day, *ids):
    return [tx(i, at=f"2027-03-{day:02d}T12:{n % 60:02d}:00") for n, i in enumerate(ids)]


def test_copies_days_apart_are_stored_once_with_bounded_state(spark, tmp_path):
    batches = [on(1, *(f"A{n}" for n in range(30))), on(2, *(f"B{n}" for n in range(30)), "A3"),
               on(5, "A3", "B4", "C1", None, "", None), on(9, "C1", "A29", *(f"D{n}" for n in range(5)), "D1"),
               on(12, "D1", "A0", "E")]
    for n, rows in enumerate(batches):
        write_lines(tmp_path / "in", f"part-{n}.json", rows)
        os.utime(tmp_path / "in" / f"part-{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    job = J.StreamJob(str(tmp_path / "out"), str(tmp_path / "c"), trigger={"availableNow": True}, keep_keys=True)
    query = J.start_transactions(stream_transactions(spark, str(tmp_path / "in"), max_files=1), job)
    query.awaitTermination()
    ids = sorted(r.transaction_id or "" for r in J.committed_transactions(spark, job).collect())
    assert ids == sorted([*(f"A{n}" for n in range(30)), *(f"B{n}" for n in range(30)), "C1",
                          *(f"D{n}" for n in range(5)), "E", "", "", ""])
    first = {r.transaction_id: r.day for r in J.committed_transactions(spark, job).collect()}
    assert (first["A3"], first["B4"], first["C1"], first["D1"], first["A0"]) == (1, 2, 5, 9, 1)
    # State holds the keys within the watermark, not all that ever came.
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert held[-1] <= 10


def test_look_ups_read_the_days_that_a_filter_names(spark, tmp_path):
    history = KeyHistory(spark, str(tmp_path / "h"), key="id")
    days = [dt.date(2027, 1, d) for d in range(1, 9)]
    for n, day in enumerate(days):
        rows = spark.range(n * 100, n * 100 + 100).select(F.concat(F.lit("k"), F.col("id")).alias("id"))
        history.add(rows, F.lit(day), f"b{n}")
    asked = spark.createDataFrame([("k5",), ("k707",), ("new",), (None,)], "id string")
    keys = asked.filter("id IS NOT NULL").select(F.col("id").alias("key"), history._bucket("id").alias("bucket"))
    met = {(r.key, r.day) for r in history.candidates(keys, "x").collect()}
    assert {("k5", days[0]), ("k707", days[7])} <= met and len(met) <= 4
    assert sorted(str(r.id) for r in history.unseen(asked, "x").collect()) == ["None", "new"]
    # A batch that is tried again does not know its own keys.
    assert sorted(str(r.id) for r in history.unseen(asked, "b0").collect()) == ["None", "k5", "new"]
    assert history.settle(dt.date(2027, 1, 7)) == 6
    assert len(list((tmp_path / "h" / "keys").iterdir())) == 3
    assert sorted(str(r.id) for r in history.unseen(asked, "x").collect()) == ["None", "new"]


def test_an_empty_history(spark, tmp_path):
    history = KeyHistory(spark, str(tmp_path / "h"), key="id")
    rows = spark.createDataFrame([("a",), (None,)], "id string")
    assert history.unseen(rows, "0").count() == 2
    history.add(rows.filter("false"), F.lit(None).cast("date"), "0")
    assert history.unseen(rows, "1").count() == 2
    history.add(rows, F.lit(None).cast("date"), "1")
    assert [r.id for r in history.unseen(rows, "2").collect()] == [None]
    assert history.settle(dt.date(2027, 1, 1)) in (0, 1, 2)
    assert [r.id for r in history.unseen(rows, "2").collect()] == [None]

"""Late rows as rows, and ids that hold a large share of the stream."""

import os
import time

from paywarden.sources.readers import stream_transactions
from paywarden.streaming import jobs as J
from paywarden.streaming.prepare import checked_stream
from rows import DAY, tx, write_lines


def drop_files(folder, *batches):
    for n, rows in enumerate(batches):
        write_lines(folder, f"part-{n}.json", rows)
        os.utime(folder / f"part-{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    return str(folder)


def test_late_rows_are_stored_as_they_came(spark, tmp_path):
    """All of them, and as many as Spark counts as dropped."""
    odd = tx("L3", None, amount=None, at=DAY + "14:50:00", status=None)
    source = drop_files(
        tmp_path / "in", [tx("A", at=DAY + "15:00:00"), tx("N", at="?")], [tx("B", at=DAY + "15:01:00")],
        [tx("L1", at=DAY + "14:40:00"), tx("EDGE", at=DAY + "14:51:00.001"), odd, tx(None, at=DAY + "13:00:00")],
        [tx("L2", at=DAY + "14:51:00"), tx("A", at=DAY + "15:00:00")])
    job = J.StreamJob(str(tmp_path / "out"), str(tmp_path / "c"), trigger={"availableNow": True}, keep_late=True)
    counted = J.LateRows()
    spark.streams.addListener(counted)
    query = J.start_transactions(stream_transactions(spark, source, max_files=1), job)
    query.awaitTermination()
    end = time.monotonic() + 30
    while str(query.id) not in counted.ended and time.monotonic() < end:
        time.sleep(0.1)
    spark.streams.removeListener(counted)
    rows = J.committed_transactions(spark, job)
    late = J.late_of(rows).collect()
    assert sorted(r.transaction_id or "" for r in late) == ["", "L1", "L2", "L3"]
    assert counted.of(query) == len(late)
    kept = {r.transaction_id: r for r in late}
    assert kept["L3"].amount is None and kept["L3"].rejection_reason.startswith("INVALID_CUSTOMER")
    assert str(kept["L2"].transaction_timestamp) == "2027-03-08 14:51:00"
    others = rows.filter("outcome <> 'late'").collect()
    assert sorted(r.transaction_id for r in others) == ["A", "B", "EDGE", "N"]


def test_a_hot_id_reaches_the_last_stage_once_a_salt(spark, tmp_path):
    """A third of the rows have one id, each copy in an Arrow batch of its own."""
    salts, n = 4, 90
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        rows = [tx("HOT" if k % 3 == 0 else f"K{k}", at=f"{DAY}10:{k % 60:02d}:00") for k in range(n)]
        source = drop_files(tmp_path / "in", rows, rows)
        stream = checked_stream(stream_transactions(spark, source, max_files=1), salts=salts)
        query = (stream.writeStream.format("parquet").option("path", str(tmp_path / "o"))
                 .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert spark.read.parquet(str(tmp_path / "o")).count() == 61
    # The last stage comes first in the report. What it drops are copies that differ in their salt.
    last = [p["stateOperators"][0]["customMetrics"]["numDroppedDuplicateRows"]
            for p in query.recentProgress if p["numInputRows"]]
    first = [p["stateOperators"][1]["customMetrics"]["numDroppedDuplicateRows"]
             for p in query.recentProgress if p["numInputRows"]]
    assert len(last) == 2 and 0 < last[0] <= salts - 1
    assert first[0] >= 30 - salts
    # A key met under a salt before stays in the first stage; others may bring a row a salt.
    assert last[1] <= salts + 60 * salts and first[1] >= 30 - salts

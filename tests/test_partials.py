import random

import pytest
from pyspark.sql import functions as F

from paywarden import schema as S
from paywarden.operators import reports as R
from paywarden.plans.batch import BatchRun, run_batch
from paywarden.plans.partials import ReportPartials
from paywarden.sinks.writers import write_clustered
from paywarden.sources.readers import read_lines

ALERT = ("customer_id string, merchant string, transaction_type string, location string, amount double, "
         "fraud_rule string, transaction_timestamp timestamp")


def alerts(spark, n, seed=1):
    pick = random.Random(seed)
    rows = [(pick.choice([None, *(f"C{k}" for k in range(40))]), pick.choice(["M1", None, ""]), "UPI", None,
             pick.choice([None, float("nan"), 1e30, 0.1 * pick.randrange(1000)]), f"RULE{pick.randrange(2)}",
             None if pick.random() < 0.1 else pick.randrange(20)) for _ in range(n)]
    frame = spark.createDataFrame(rows, ALERT.replace("transaction_timestamp timestamp", "day int"))
    at = F.to_timestamp(F.lit("2027-03-01 10:00:00")) + F.make_interval(days=F.col("day"))
    return frame.withColumn("transaction_timestamp", at).drop("day")


def same(ours, theirs):
    assert list(map(repr, ours.collect())) == list(map(repr, theirs.select(*ours.columns).collect()))


def test_partials_of_many_batches_equal_the_alerts(spark, tmp_path):
    import datetime as dt
    rows = alerts(spark, 600).cache()
    partials = ReportPartials(spark, str(tmp_path / "p"))
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(3))
    for n in (0, 1, 2, 1, 0):
        partials.add(rows.filter(part == n), f"b{n}")
    dates = (dt.date(2027, 3, 3), dt.date(2027, 3, 12))
    for choice in ({}, {"rule": "RULE1"}, {"dates": dates}, {"rule": "RULE0", "dates": dates},
                   {"customer": "C7"}, {"customer": "C7", "dates": dates}, {"customer": "nobody"}):
        same(partials.kpi_alerts(**choice), R.kpi_alerts(R.alert_filter(rows, **choice)))
    for column in ("customer_id", "merchant", "fraud_rule", "location"):
        same(partials.alerts_by(column, "money", dates=dates),
             R.alerts_by(R.alert_filter(rows, dates=dates), column, "money"))
        same(partials.distinct_values(column), R.distinct_values(rows, column))
    same(partials.alert_trend(), R.alert_trend(rows))
    same(partials.date_bounds(), R.date_bounds(rows))
    numbers = [r.number for r in spark.read.parquet(str(tmp_path / "p" / "customers")).collect()]
    assert sorted(numbers) == list(range(min(numbers), min(numbers) + len(numbers)))
    rows.unpersist()


def test_a_report_opens_the_partials_alone(spark, tmp_path):
    alerts(spark, 50).write.parquet(str(tmp_path / "alerts"))
    partials = ReportPartials(spark, str(tmp_path / "p"))
    partials.add(spark.read.parquet(str(tmp_path / "alerts")), "1")
    for frame in (partials.kpi_alerts(), partials.alert_trend(), partials.alerts_by("merchant")):
        assert frame.inputFiles() and all("/p/" in f for f in frame.inputFiles())
    assert all("/dimension=merchant/" in f for f in partials.alerts_by("merchant").inputFiles()) or \
        "PartitionFilters: [isnotnull(dimension" in partials.alerts_by("merchant")._jdf.queryExecution().toString()


def test_no_batches(spark, tmp_path):
    partials = ReportPartials(spark, str(tmp_path / "p"))
    empty = spark.createDataFrame([], ALERT)
    same(partials.kpi_alerts(), R.kpi_alerts(empty))
    partials.add(empty, "1")
    same(partials.kpi_alerts(), R.kpi_alerts(empty))
    same(partials.alert_trend(), R.alert_trend(empty))


def scanned(frame):
    """Rows that left the scan, and files that it opened."""
    rows = len(frame.collect())
    plan = frame._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().apply(0)
    return rows, leaf.metrics().apply("numOutputRows").value(), leaf.metrics().apply("numFiles").value()


def test_filters_open_only_what_may_match(spark, tmp_path):
    path = str(tmp_path / "clustered")
    days = spark.range(40_000).select(
        F.concat(F.lit("C"), F.xxhash64("id").cast("string")).alias("customer_id"),
        (F.to_timestamp(F.lit("2027-03-01")) + F.make_interval(mins=F.col("id"))).alias(S.EVENT_TIME))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_clustered(days, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    table = spark.read.parquet(path)
    files = len(table.inputFiles())
    assert files >= 4
    import datetime as dt
    rows, read, _ = scanned(R.alert_filter(table, dates=(dt.date(2027, 3, 2), dt.date(2027, 3, 3))))
    assert rows == 2880 and read < 40_000 / files * 2
    one = table.filter("customer_id IS NOT NULL").first().customer_id
    rows, read, _ = scanned(R.alert_filter(table, customer=one))
    assert rows == 1 and 0 < read < 40_000 / files * 2
    rows, read, _ = scanned(R.alert_filter(table, customer="C12345"))
    assert rows == read == 0


LINES = ['{"transaction_id":"a","amount":1.5}', "{broken", "", '"text"', "17", '{"amount":"x"}', "{}", '{"amount":[1]}',
         '{"transaction_id":"b","amount":"x"}', '{"transaction_id":"c"', "é{"]


def test_malformed_lines_are_kept_with_their_file(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "x.json").write_text("\n".join(LINES))
    rows = read_lines(spark, str(source)).collect()
    broken = {r.malformed_line for r in rows if r.malformed_line is not None}
    assert broken == {"{broken", '"text"', "17", '{"transaction_id":"c"', "é{"}
    assert len(rows) == len(LINES) - 1 and {r.source_file.rsplit("/", 1)[-1] for r in rows} == {"x.json"}
    run = BatchRun(str(tmp_path / "out"), "r")
    summary = run_batch(spark, str(source), run).first()
    assert (summary.total_transactions, summary.rejected_transactions) == (10, 10)
    kept = run.read_malformed(spark).collect()
    assert {r.malformed_line for r in kept} == broken and all(r.source_file.endswith("x.json") for r in kept)
    assert run.read_rejected(spark).count() == 10
    assert (tmp_path / "out" / "checked" / "run_id=r" / "outcome=malformed").is_dir()


@pytest.mark.parametrize("columns", [["transaction_id"], ["amount", "status"]])
def test_columns_that_are_not_asked_for_are_not_parsed(spark, tmp_path, columns):
    (tmp_path / "x.json").write_text("\n".join(LINES))
    plan = read_lines(spark, str(tmp_path)).select(*columns)._jdf.queryExecution().executedPlan().toString()
    assert "_broken" not in plan and "merchant" not in plan.split("ReadSchema")[1]

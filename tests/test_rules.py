import pytest
from pyspark.sql import functions as F

from paywarden.functions.columns import with_date_parts, with_event_time
from paywarden.functions.rules import BATCH, STREAM, STRICT
from paywarden.operators.validation import outcome, rejected_rows, rejections_by_label, split, validate
from paywarden.schema import TRANSACTION_SCHEMA
from rows import DAILY, tx

NAN = float("nan")


def frame(spark, rows):
    return with_event_time(spark.createDataFrame(rows, TRANSACTION_SCHEMA))


def reasons(spark, rows, profile):
    checked = validate(frame(spark, rows), profile)
    return {r.transaction_id: r.rejection_reason for r in checked.collect()}


def test_daily_reasons(spark):
    batch = reasons(spark, DAILY, BATCH)
    assert {k: v for k, v in batch.items() if v} == {
        "A-4": "MISSING_CUSTOMER_ID",
        "A-5": "INVALID_STATUS,INVALID_TRANSACTION_TYPE",
        "A-6": "INVALID_AMOUNT",
    }
    stream = reasons(spark, DAILY, STREAM)
    assert {k: v for k, v in stream.items() if v} == {
        "A-4": "INVALID_CUSTOMER",
        "A-5": "INVALID_TRANSACTION_TYPE,INVALID_STATUS",
        "A-6": "INVALID_AMOUNT",
    }


# change to a good row, then the reason under BATCH, STREAM and STRICT
EDGES = [
    ({}, "", "", ""),
    ({"currency": None}, "INVALID_CURRENCY", "", "INVALID_CURRENCY"),
    ({"currency": "USD"}, "INVALID_CURRENCY", "INVALID_CURRENCY", "INVALID_CURRENCY"),
    ({"kind": None}, "", "", "INVALID_TRANSACTION_TYPE"),
    ({"status": None}, "", "", "INVALID_STATUS"),
    ({"customer": ""}, "MISSING_CUSTOMER_ID", "", "INVALID_CUSTOMER"),
    ({"account": ""}, "MISSING_ACCOUNT_ID", "INVALID_ACCOUNT", "INVALID_ACCOUNT"),
    ({"merchant": None}, "MISSING_MERCHANT", "INVALID_MERCHANT", "INVALID_MERCHANT"),
    ({"i": ""}, "MISSING_TRANSACTION_ID", "INVALID_TRANSACTION_ID", "INVALID_TRANSACTION_ID"),
    ({"i": None}, "MISSING_TRANSACTION_ID", "INVALID_TRANSACTION_ID", "INVALID_TRANSACTION_ID"),
    ({"amount": 0.0}, "INVALID_AMOUNT", "INVALID_AMOUNT", "INVALID_AMOUNT"),
    ({"amount": None}, "INVALID_AMOUNT", "INVALID_AMOUNT", "INVALID_AMOUNT"),
    ({"amount": NAN}, "", "", "INVALID_AMOUNT"),
    ({"location": None}, "", "", ""),
    ({"at": "not a time"}, "", "", "INVALID_TIMESTAMP"),
]


def test_edge_rows(spark):
    # location is not checked by any rule, so it carries the case number
    rows = frame(spark, [tx(**{"location": str(n), **edge[0]}) for n, edge in enumerate(EDGES)])
    for profile, want in ((BATCH, 1), (STREAM, 2), (STRICT, 3)):
        got = {r.location: r.rejection_reason for r in validate(rows, profile).collect()}
        for n, edge in enumerate(EDGES):
            key = edge[0].get("location", str(n))
            assert got[key] == edge[want], (profile.name, edge[0])


@pytest.mark.parametrize("profile", [BATCH, STREAM, STRICT], ids=lambda p: p.name)
def test_split_agrees_with_reason(spark, profile):
    odd = [tx(f"E{n}", **c) for n, c in enumerate([
        {"currency": None}, {"kind": None}, {"status": None}, {"customer": ""}, {"amount": NAN},
        {"customer": None}, {"merchant": ""}, {"amount": None}, {"at": None},
    ])]
    rows = frame(spark, DAILY + odd)
    checked = validate(rows, profile)
    valid, rejected = split(checked, profile)
    assert valid.filter("rejection_reason <> ''").count() == 0
    assert rejected.filter("rejection_reason = ''").count() == 0
    assert valid.count() + rejected.count() == len(DAILY + odd)
    # The split also works on rows that were not given a reason.
    assert rejected_rows(rows, profile).count() == rejected.count()
    routes = checked.groupBy(outcome(profile).alias("o")).count().collect()
    assert {r.o: r["count"] for r in routes}["rejected"] == rejected.count()


def test_flags_are_kept_by_stream_profile_only(spark):
    assert set(STREAM.flags) <= set(validate(frame(spark, DAILY), STREAM).columns)
    assert not set(BATCH.flags) & set(validate(frame(spark, DAILY), BATCH).columns)


def test_labels_are_counted_one_by_one(spark):
    counted = rejections_by_label(frame(spark, DAILY), BATCH).collect()
    assert {r.label: r.rejected_count for r in counted} == {
        "MISSING_CUSTOMER_ID": 1, "INVALID_STATUS": 1, "INVALID_TRANSACTION_TYPE": 1,
        "INVALID_AMOUNT": 1,
    }


def test_event_time_and_parts(spark):
    rows = [tx("a", at="2027-03-08T14:00:00.123456"), tx("b", at="junk"), tx("c", at=None)]
    timed = with_date_parts(frame(spark, rows))
    got = {
        r.transaction_id: (r.at, r.year, r.month, r.day)
        for r in timed.withColumn("at", F.col("transaction_timestamp").cast("string")).collect()
    }
    assert got["a"] == ("2027-03-08 14:00:00.123456", 2027, 3, 8)
    assert got["b"] == got["c"] == (None, None, None, None)


def test_rules_reach_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    frame(spark, DAILY).write.parquet(path)
    valid, _ = split(spark.read.parquet(path), BATCH)
    plan = valid._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    for part in ("IsNotNull(customer_id)", "GreaterThan(amount,0.0)", "EqualTo(currency,INR)"):
        assert part in pushed

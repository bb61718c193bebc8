from paywarden.functions.columns import with_date_parts, with_event_time
from paywarden.functions.rules import BATCH, STREAM
from paywarden.operators import fraud as X
from paywarden.operators.validation import valid_rows, validate
from paywarden.schema import ALERT_COLUMNS, TRANSACTION_SCHEMA
from rows import DAILY, DAY, tx


def frame(spark, rows):
    return with_date_parts(with_event_time(spark.createDataFrame(rows, TRANSACTION_SCHEMA)))


def burst(n, customer="C9", start=0):
    at = [f"{DAY}10:0{start + k // 60}:{k % 60:02d}" for k in range(n)]
    return [tx(f"{customer}-{k}", customer, at=when) for k, when in enumerate(at)]


def test_daily_alerts(spark):
    valid = valid_rows(frame(spark, DAILY), BATCH)
    (high,) = X.high_value_alerts(valid).collect()
    assert high.transaction_id == "A-3"
    assert (high.fraud_rule, high.fraud_reason, high.fraud_status) == (
        "HIGH_VALUE_TRANSACTION", "Transaction amount exceeds INR 100000", "POTENTIAL_FRAUD")
    (fast,) = X.velocity_alerts(valid).collect()
    assert (fast.customer_id, fast.transaction_count) == ("ann", 6)
    assert str(fast.window_start) == "2027-03-08 09:20:00"
    assert str(fast.window_end) == "2027-03-08 09:25:00"
    assert fast.window.start == fast.window_start
    assert (fast.fraud_rule, fast.fraud_reason) == (
        "HIGH_TRANSACTION_VELOCITY", "More than 5 transactions within 5 minutes")


def test_amount_limits(spark):
    amounts = [100000.0, 100000.01, float("nan"), 0.0, None]
    rows = frame(spark, [tx(f"A{n}", amount=a) for n, a in enumerate(amounts)])
    valid = valid_rows(rows, BATCH)
    assert {r.transaction_id for r in X.high_value(valid).collect()} == {"A1", "A2"}
    assert {r.transaction_id for r in X.normal_value(valid).collect()} == {"A0"}


def test_velocity_limits(spark):
    five, six = burst(5, "C5"), burst(6, "C6")
    # six rows on both sides of 10:05 share no window
    across = [tx(f"X{k}", "CX", at=f"{DAY}10:0{4 + k // 3}:{30 + k}") for k in range(6)]
    failed = [tx(f"F{k}", "CF", at=f"{DAY}11:00:0{k}", status="FAILED", amount=500000.0) for k in range(6)]
    timeless = [tx(f"N{k}", "CN", at="?") for k in range(7)]
    alerts = X.velocity_alerts(frame(spark, five + six + across + failed + timeless))
    assert {r.customer_id: r.transaction_count for r in alerts.collect()} == {"C6": 6, "CF": 6}


def test_blank_customers_pool_in_the_stream_profile(spark):
    rows = frame(spark, burst(6, ""))
    assert X.velocity_alerts(valid_rows(rows, STREAM)).count() == 1
    assert X.velocity_alerts(valid_rows(rows, BATCH)).count() == 0


def test_alert_layouts(spark):
    valid = valid_rows(frame(spark, DAILY), BATCH)
    velocity = X.velocity_alerts(valid)
    (batch,) = X.conform_velocity(velocity, BATCH).collect()
    (stream,) = X.conform_velocity(velocity, STREAM).collect()
    assert list(batch.asDict()) == list(stream.asDict()) == list(ALERT_COLUMNS)
    empty = ("transaction_id", "account_id", "amount")
    assert all(batch[c] is None and stream[c] is None for c in empty)
    assert [batch[c] for c in ("currency", "transaction_type", "merchant", "location", "status")] == [
        None, None, None, None, "SUCCESS"]
    assert [stream[c] for c in ("currency", "transaction_type", "merchant", "location", "status")] == [
        "INR", "MULTIPLE", "MULTIPLE", "MULTIPLE", "DETECTED"]
    assert str(batch.transaction_timestamp) == "2027-03-08 09:20:00"
    both = X.all_alerts(X.high_value_alerts(valid), velocity, BATCH)
    assert both.columns == list(ALERT_COLUMNS) and both.count() == 2
    stamped = X.stamp_alerts(both)
    assert stamped.select("fraud_alert_id").distinct().count() == 2
    assert stamped.filter("created_at is null").count() == 0


def test_routes(spark):
    rows = frame(spark, DAILY)
    batch = {k: v.count() for k, v in X.route(validate(rows, BATCH), BATCH).items()}
    stream = {k: v.count() for k, v in X.route(validate(rows, STREAM), STREAM).items()}
    assert batch == {"processed": 9, "rejected": 3, "high_value": 1}
    assert stream == {"processed": 8, "rejected": 3, "high_value": 1}


def test_summary(spark):
    odd = [tx("N1", at="?"), tx("N2", "CZ", at="?"), tx(None), tx("", None)] + burst(6, "C7")
    rows = frame(spark, DAILY + odd)
    got = X.transaction_summary(rows, BATCH).first()
    valid = valid_rows(rows, BATCH)
    assert got.asDict() == {
        "total_transactions": 22,
        "valid_transactions": valid.count(),
        "rejected_transactions": 22 - valid.count(),
        "high_value_alerts": X.high_value(valid).count(),
        "velocity_alerts": X.velocity_alerts(valid).count(),
    }
    assert X.transaction_summary(frame(spark, DAILY), BATCH).first() == (12, 9, 3, 1, 1)
    assert X.transaction_summary(rows.limit(0), BATCH).first() == (0, 0, 0, 0, 0)

"""Random rows against plain Python: rules, routing, alerts and duplicates."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from paywarden.functions.columns import with_event_time
from paywarden.functions.rules import BATCH, STREAM
from paywarden.operators import duplicates as D
from paywarden.operators import fraud as X
from paywarden.operators.validation import outcome, valid_rows, validate
from paywarden.schema import TRANSACTION_SCHEMA
from rows import FIELDS

TYPES = ["UPI", "ATM", "CARD", "NET_BANKING", "IMPS", "NEFT"]
START = datetime(2027, 3, 8, tzinfo=timezone.utc)


def some_rows(seed, n=1500):
    pick = random.Random(seed)

    def rarely(good, *bad):
        return pick.choice(bad) if pick.random() < 0.04 else good

    def row():
        at = START + timedelta(seconds=pick.randrange(3600), microseconds=pick.randrange(10**6))
        hot = pick.random() < 0.33
        return (
            rarely("HOT" if pick.random() < 0.3 else f"T{pick.randrange(1200)}", None, ""),
            rarely("C0" if hot else f"C{pick.randrange(60)}", None, ""),
            rarely("A", None, ""),
            rarely(round(pick.uniform(1, 150000), 2), None, 0.0, -1.0, 100000.0, 100000.01),
            rarely("INR", None, "USD", "inr", ""),
            rarely(pick.choice(TYPES), None, "INVALID", ""),
            rarely("M", None, ""),
            rarely("L", None),
            rarely(at.strftime("%Y-%m-%dT%H:%M:%S.%f"), None, "never"),
            rarely(pick.choice(["SUCCESS", "FAILED"]), None, "UNKNOWN"),
        )

    return [row() for _ in range(n)]


def batch_reason(r):
    found = []
    if not r["customer_id"]:
        found.append("MISSING_CUSTOMER_ID")
    if r["amount"] is None or r["amount"] <= 0:
        found.append("INVALID_AMOUNT")
    if r["status"] not in (None, "SUCCESS", "FAILED"):
        found.append("INVALID_STATUS")
    if r["transaction_type"] not in (None, *TYPES):
        found.append("INVALID_TRANSACTION_TYPE")
    if r["currency"] != "INR":
        found.append("INVALID_CURRENCY")
    if not r["transaction_id"]:
        found.append("MISSING_TRANSACTION_ID")
    if not r["account_id"]:
        found.append("MISSING_ACCOUNT_ID")
    if not r["merchant"]:
        found.append("MISSING_MERCHANT")
    return ",".join(found)


def stream_reason(r):
    found = []
    if r["customer_id"] is None:
        found.append("INVALID_CUSTOMER")
    if r["amount"] is None or r["amount"] <= 0:
        found.append("INVALID_AMOUNT")
    if r["currency"] not in (None, "INR"):
        found.append("INVALID_CURRENCY")
    if r["transaction_type"] not in (None, *TYPES):
        found.append("INVALID_TRANSACTION_TYPE")
    if r["status"] not in (None, "SUCCESS", "FAILED"):
        found.append("INVALID_STATUS")
    if not r["transaction_id"]:
        found.append("INVALID_TRANSACTION_ID")
    if not r["account_id"]:
        found.append("INVALID_ACCOUNT")
    if not r["merchant"]:
        found.append("INVALID_MERCHANT")
    return ",".join(found)


def moment(text):
    try:
        return datetime.strptime(text or "", "%Y-%m-%dT%H:%M:%S.%f").replace(tzinfo=timezone.utc)
    except ValueError:
        return None


def busy_windows(rows):
    counts = Counter()
    for r in rows:
        at = moment(r["timestamp"])
        if at:
            counts[r["customer_id"], int(at.timestamp()) // 300 * 300] += 1
    return {key: n for key, n in counts.items() if n > 5}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("profile, reason", [(BATCH, batch_reason), (STREAM, stream_reason)],
                         ids=["batch", "stream"])
def test_rules_and_alerts(spark, seed, profile, reason):
    raw = some_rows(seed)
    plain = [dict(zip(FIELDS, r)) for r in raw]
    rows = with_event_time(spark.createDataFrame(raw, TRANSACTION_SCHEMA).repartition(5))
    checked = validate(rows, profile).withColumn("outcome", outcome(profile))
    got = Counter(tuple(r[f] for f in FIELDS) + (r.rejection_reason, r.outcome)
                  for r in checked.collect())

    def route(r):
        if reason(r):
            return "rejected"
        return "high_value" if profile is STREAM and r["amount"] > 100000 else "processed"

    assert got == Counter(tuple(r[f] for f in FIELDS) + (reason(r), route(r)) for r in plain)

    good = [r for r in plain if not reason(r)]
    alerts = X.velocity_alerts(valid_rows(rows, profile)).select(
        "customer_id", F.unix_seconds("window_start").alias("w"), "transaction_count").collect()
    assert {(a.customer_id, a.w): a.transaction_count for a in alerts} == busy_windows(good)
    assert X.transaction_summary(rows, profile).first() == (
        len(plain), len(good), len(plain) - len(good),
        sum(r["amount"] > 100000 for r in good), len(busy_windows(good)))


@pytest.mark.parametrize("seed", [3, 4])
def test_duplicates(spark, seed):
    raw = some_rows(seed)
    rows = spark.createDataFrame(raw, TRANSACTION_SCHEMA).repartition(5)
    groups = defaultdict(list)
    for r in raw:
        groups[r[0]].append(r)
    repeated = {k: g for k, g in groups.items() if len(g) > 1}
    copies = [r for k, g in repeated.items() if k is not None for r in g]

    assert {r[0]: r[1] for r in D.duplicate_ids(rows).collect()} == {
        k: len(g) for k, g in repeated.items()}
    assert Counter(map(tuple, D.duplicate_records(rows, D.duplicate_ids(rows)).collect())) == Counter(copies)
    assert D.duplicate_summary(rows).first() == (
        len(raw), len(groups), len(copies), len(repeated))

    def order(r):  # NULL first, as in an ascending sort
        return [(v is not None, v) for v in r[1:]]

    assert Counter(map(tuple, D.dedupe(rows).collect())) == Counter(
        min(g, key=order) for g in groups.values())

"""Reporting queries over the transactions and fraud_alerts tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywarden.functions.columns import money_left_out, money_total
from paywarden.schema import EVENT_TIME, RECENT_ALERT_COLUMNS

ALL = "All"


def alert_filter(
    alerts: DataFrame,
    customer: str | None = None,
    rule: str | None = None,
    dates: Sequence[dt.date] | None = None,
) -> DataFrame:
    """Optional customer, rule and inclusive date range, combined with AND.

    ``None`` or "All" means no restriction; dates count only when both ends are
    given. The range is put on the raw time column so that it can reach the scan.
    """
    if customer not in (None, ALL):
        alerts = alerts.filter(F.col("customer_id") == customer)
    if rule not in (None, ALL):
        alerts = alerts.filter(F.col("fraud_rule") == rule)
    if dates is not None and len(dates) == 2:
        first, last = dates
        alerts = alerts.filter(
            (F.col(EVENT_TIME) >= F.lit(first).cast("timestamp"))
            & (F.col(EVENT_TIME) < F.lit(last + dt.timedelta(days=1)).cast("timestamp"))
        )
    return alerts


def count_successful(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.col("status") == "SUCCESS").agg(F.count("*").alias("total"))


def kpi_transactions(transactions: DataFrame) -> DataFrame:
    """Count, successful count and amount of all transactions, in one pass."""
    return transactions.agg(
        F.count("*").alias("total_transactions"),
        F.count_if(F.col("status") == "SUCCESS").alias("successful_transactions"),
        money_total().alias("total_amount"),
        money_left_out().alias("amounts_left_out"),
    )


def kpi_alerts(alerts: DataFrame) -> DataFrame:
    """Count, amount and number of customers of the (filtered) alerts."""
    return alerts.agg(
        F.count("*").alias("total_alerts"),
        money_total().alias("total_amount"),
        money_left_out().alias("amounts_left_out"),
        F.count_distinct("customer_id").alias("customers"),
    )


def alerts_by(alerts: DataFrame, column: str, amount_as: str | None = None) -> DataFrame:
    """Alerts per value of ``column``, most first; ties by the value itself."""
    measures = [F.count("*").alias("alert_count")]
    if amount_as:
        measures += [money_total().alias(amount_as), money_left_out().alias("amounts_left_out")]
    return alerts.groupBy(column).agg(*measures).orderBy(F.desc("alert_count"), F.asc(column))


def alerts_by_rule(alerts: DataFrame) -> DataFrame:
    return alerts_by(alerts, "fraud_rule", amount_as="total_amount")


def alerts_by_customer(alerts: DataFrame) -> DataFrame:
    return alerts_by(alerts, "customer_id", amount_as="fraud_amount")


def alerts_by_merchant(alerts: DataFrame) -> DataFrame:
    return alerts_by(alerts, "merchant")


def alerts_by_type(alerts: DataFrame) -> DataFrame:
    return alerts_by(alerts, "transaction_type")


def alerts_by_location(alerts: DataFrame) -> DataFrame:
    return alerts_by(alerts, "location")


def alert_trend(alerts: DataFrame) -> DataFrame:
    """Alerts per day, in date order."""
    return (
        alerts.groupBy(F.to_date(EVENT_TIME).alias("fraud_date"))
        .agg(F.count("*").alias("fraud_alert_count"))
        .orderBy("fraud_date")
    )


def distinct_values(alerts: DataFrame, column: str) -> DataFrame:
    return alerts.select(column).distinct().orderBy(column)


def date_bounds(alerts: DataFrame) -> DataFrame:
    """First and last alert date; NULLs when there are no alerts."""
    return alerts.agg(
        F.to_date(F.min(EVENT_TIME)).alias("min_date"),
        F.to_date(F.max(EVENT_TIME)).alias("max_date"),
    )


def recent_alerts(alerts: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` newest alerts (top-k per task, then merged)."""
    return (
        alerts.select(*RECENT_ALERT_COLUMNS)
        .orderBy(F.desc("created_at"), F.desc("fraud_alert_id"))
        .limit(n)
    )


def register_views(alerts: DataFrame) -> None:
    """Temp views: alert summary by rule, by customer and by day."""
    alerts.createOrReplaceTempView("fraud_alerts")
    alerts_by_rule(alerts).createOrReplaceTempView("fraud_summary")
    alerts_by_customer(alerts).createOrReplaceTempView("customer_fraud")
    alert_trend(alerts).createOrReplaceTempView("daily_fraud")

"""The alert report: all its queries over one filtered alert table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from paywarden.operators import reports as R


def report_choices(alerts: DataFrame) -> dict[str, DataFrame]:
    """What a reader can filter by."""
    return {
        "customers": R.distinct_values(alerts, "customer_id"),
        "rules": R.distinct_values(alerts, "fraud_rule"),
        "dates": R.date_bounds(alerts),
    }


def report(
    transactions: DataFrame,
    alerts: DataFrame,
    customer: str | None = None,
    rule: str | None = None,
    dates: Sequence[dt.date] | None = None,
    recent: int = 50,
) -> dict[str, DataFrame]:
    """Key figures, breakdowns, trend and newest alerts; nothing runs until used.

    The filter applies to the alerts. Transaction figures are always over all rows.
    """
    chosen = R.alert_filter(alerts, customer, rule, dates)
    return {
        "transactions": R.kpi_transactions(transactions),
        "alerts": R.kpi_alerts(chosen),
        "by_rule": R.alerts_by_rule(chosen),
        "by_customer": R.alerts_by_customer(chosen),
        "by_merchant": R.alerts_by_merchant(chosen),
        "by_type": R.alerts_by_type(chosen),
        "by_location": R.alerts_by_location(chosen),
        "trend": R.alert_trend(chosen),
        "recent": R.recent_alerts(chosen, recent),
    }

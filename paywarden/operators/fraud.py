"""Fraud rules: high value and high velocity, and the common alert layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden import schema as S
from paywarden.functions.columns import blank
from paywarden.functions.rules import Profile


def high_value(df: DataFrame, threshold: float = S.HIGH_VALUE_THRESHOLD) -> DataFrame:
    return df.filter(F.col("amount") > threshold)


def normal_value(df: DataFrame, threshold: float = S.HIGH_VALUE_THRESHOLD) -> DataFrame:
    return df.filter(F.col("amount") <= threshold)


def tag(df: DataFrame, rule: str, reason: str, status: str = S.FRAUD_STATUS) -> DataFrame:
    """Add the three fraud columns as constants."""
    return df.withColumns(
        {"fraud_rule": F.lit(rule), "fraud_reason": F.lit(reason), "fraud_status": F.lit(status)}
    )


def high_value_alerts(valid: DataFrame, threshold: float = S.HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Valid rows above the threshold, tagged."""
    return tag(
        high_value(valid, threshold),
        S.HIGH_VALUE_RULE,
        f"Transaction amount exceeds {S.CURRENCY} {threshold}",
    )


def velocity_counts(
    valid: DataFrame, window: str = S.VELOCITY_WINDOW, watermark: str | None = None
) -> DataFrame:
    """Transactions per customer and tumbling event-time window.

    Counts are combined within each task before the shuffle, so a customer who
    holds a large share of the rows sends one partial count per task and window.
    """
    if watermark is not None:
        valid = valid.withWatermark(S.EVENT_TIME, watermark)
    return valid.groupBy(F.window(S.EVENT_TIME, window), "customer_id").agg(
        F.count("*").alias("transaction_count")
    )


def velocity_alerts(
    valid: DataFrame,
    window: str = S.VELOCITY_WINDOW,
    threshold: int = S.VELOCITY_THRESHOLD,
    watermark: str | None = None,
) -> DataFrame:
    """Customer windows with more than ``threshold`` transactions, tagged.

    Keeps the ``window`` struct next to flat ``window_start``/``window_end``.
    """
    busy = velocity_counts(valid, window, watermark).filter(
        F.col("transaction_count") > threshold
    )
    tagged = tag(
        busy, S.VELOCITY_RULE, f"More than {threshold} transactions within {window}"
    )
    return tagged.withColumns(
        {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    )


def flat_velocity(alerts: DataFrame) -> DataFrame:
    """Velocity alerts without the window struct."""
    return alerts.select(*S.VELOCITY_SCHEMA.names)


def conform_high_value(alerts: DataFrame) -> DataFrame:
    return alerts.select(*S.ALERT_COLUMNS)


def conform_velocity(alerts: DataFrame, profile: Profile) -> DataFrame:
    """Velocity alerts in the alert-table layout; the profile fills the gaps."""
    filled = {
        "transaction_id": blank("string"),
        "account_id": blank("string"),
        "amount": blank("double"),
        S.EVENT_TIME: F.col("window_start"),
    }
    for name, value in profile.velocity_fill:
        filled[name] = blank("string") if value is None else F.lit(value)
    return alerts.select(*(filled[c].alias(c) if c in filled else c for c in S.ALERT_COLUMNS))


def all_alerts(high_value: DataFrame, velocity: DataFrame, profile: Profile) -> DataFrame:
    """Both kinds of alert as one table."""
    return conform_high_value(high_value).unionByName(conform_velocity(velocity, profile))


def stamp_alerts(alerts: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Add ``fraud_alert_id`` and ``created_at`` where no database does it.

    The id is a digest of the business key, so a re-run gives the same id.
    """
    parts = ("fraud_rule", "transaction_id", "customer_id", "account_id",
             f"CAST(unix_micros({S.EVENT_TIME}) AS STRING)")
    key = ", ".join(f"coalesce({part}, '')" for part in parts)
    return alerts.withColumns(
        {
            "fraud_alert_id": F.expr(f"md5(concat_ws('|', {key}))"),
            "created_at": F.current_timestamp() if created_at is None else created_at,
        }
    )


def route(
    checked: DataFrame, profile: Profile, threshold: float = S.HIGH_VALUE_THRESHOLD
) -> dict[str, DataFrame]:
    """Processed, rejected and high-value rows of a checked table.

    In the batch profile the processed rows include the high-value ones; in the
    stream profile they do not.
    """
    valid = checked.filter(profile.is_valid())
    return {
        "processed": valid if profile.processed_has_high_value else normal_value(valid, threshold),
        "rejected": checked.filter(profile.is_invalid()),
        "high_value": high_value_alerts(valid, threshold),
    }


def transaction_summary(
    df: DataFrame,
    profile: Profile,
    high_threshold: float = S.HIGH_VALUE_THRESHOLD,
    window_minutes: int = 5,
    velocity_threshold: int = S.VELOCITY_THRESHOLD,
) -> DataFrame:
    """Total, valid, rejected, high-value and velocity counts as one row.

    One scan: rows are counted by (window, customer), where every row that
    cannot raise a velocity alert falls into one common group that each task
    folds to a single row, and the groups are then added up.
    """
    width = window_minutes * 60 * 1_000_000
    micros = F.unix_micros(S.EVENT_TIME)
    good = ~profile.is_invalid()
    counted = (
        df.select(
            F.when(good, micros - F.pmod(micros, F.lit(width))).alias("window_key"),
            F.when(good & F.col(S.EVENT_TIME).isNotNull(), F.col("customer_id")).alias("who"),
            good.alias("good"),
            (good & (F.col("amount") > high_threshold)).alias("high"),
        )
        .groupBy("window_key", "who")
        .agg(
            F.count("*").alias("n"),
            F.count_if("good").alias("n_good"),
            F.count_if("high").alias("n_high"),
        )
    )
    busy = F.col("window_key").isNotNull() & (F.col("n_good") > velocity_threshold)

    def added(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    return counted.agg(
        added("n").alias("total_transactions"),
        added("n_good").alias("valid_transactions"),
        (added("n") - added("n_good")).alias("rejected_transactions"),
        added("n_high").alias("high_value_alerts"),
        F.count_if(busy).alias("velocity_alerts"),
    )

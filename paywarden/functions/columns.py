"""Column helpers: event time, date parts, exact money sums, typed NULLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.schema import EVENT_TIME


def with_event_time(df: DataFrame, source: str = "timestamp", keep: bool = True) -> DataFrame:
    """Parse the ISO text into ``transaction_timestamp``; unreadable text gives NULL."""
    timed = df.withColumn(EVENT_TIME, F.try_to_timestamp(F.col(source)))
    return timed if keep else timed.drop(source)


def with_date_parts(df: DataFrame, source: str = EVENT_TIME) -> DataFrame:
    """Add year, month and day of month (integers, also partition columns)."""
    return df.withColumns(
        {"year": F.year(source), "month": F.month(source), "day": F.dayofmonth(source)}
    )


# Amounts below 1e22; the sum of ten billion of them still fits.
MONEY = "decimal(24,2)"


def _money(amount: str) -> Column:
    """The amount as a decimal; NULL for NaN, infinite or larger ones."""
    return F.col(amount).try_cast(MONEY)


def money_total(amount: str = "amount") -> Column:
    """Sum of amounts, 0 when there are none.

    Added up as decimals with two places, so the result does not depend on how
    rows are split over tasks. What cannot be added is counted by ``money_left_out``.
    """
    return F.coalesce(F.sum(_money(amount)), F.lit(0)).cast("double")


def money_left_out(amount: str = "amount") -> Column:
    """How many amounts ``money_total`` could not add: NaN, infinite, or 1e22 and more."""
    return F.count_if(F.col(amount).isNotNull() & _money(amount).isNull())


def blank(kind: str) -> Column:
    """A NULL of the given type."""
    return F.expr(f"CAST(NULL AS {kind})")

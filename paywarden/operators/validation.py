"""Validation, the valid/rejected split, and routing of checked rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.functions.rules import Profile
from paywarden.schema import HIGH_VALUE_THRESHOLD

# Where a checked row goes.
PROCESSED = "processed"
REJECTED = "rejected"
HIGH_VALUE = "high_value"
MALFORMED = "malformed"
LATE = "late"


def validate(df: DataFrame, profile: Profile) -> DataFrame:
    """Add ``rejection_reason`` (comma-joined labels, ``''`` when valid).

    Profiles that keep flags also get one nullable label column per rule.
    """
    if profile.keeps_flags:
        flagged = df.withColumns(profile.flag_columns())
        return flagged.withColumn("rejection_reason", F.concat_ws(",", *profile.flags))
    return df.withColumn("rejection_reason", F.concat_ws(",", profile.labels()))


def valid_rows(df: DataFrame, profile: Profile) -> DataFrame:
    """Rows that break no rule; works before or after ``validate``."""
    return df.filter(profile.is_valid())


def rejected_rows(df: DataFrame, profile: Profile) -> DataFrame:
    return df.filter(profile.is_invalid())


def split(df: DataFrame, profile: Profile) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected)."""
    return valid_rows(df, profile), rejected_rows(df, profile)


def outcome(profile: Profile, threshold: float = HIGH_VALUE_THRESHOLD) -> Column:
    """Route of a row as one column, so all routes can be written in one pass."""
    route = F.when(profile.is_invalid(), F.lit(REJECTED))
    if not profile.processed_has_high_value:
        route = route.when(F.col("amount") > threshold, F.lit(HIGH_VALUE))
    return route.otherwise(F.lit(PROCESSED))


def rejections_by_label(df: DataFrame, profile: Profile) -> DataFrame:
    """How many rows each label was given to, from one pass over the rows."""
    return (
        df.select(F.explode(F.array_compact(profile.labels())).alias("label"))
        .groupBy("label")
        .agg(F.count("*").alias("rejected_count"))
    )

"""Batch job: check transactions, raise alerts, store results, summarise."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden import schema as S
from paywarden.functions.columns import with_date_parts, with_event_time
from paywarden.functions.rules import BATCH, Profile
from paywarden.operators.fraud import (
    all_alerts,
    high_value_alerts,
    stamp_alerts,
    velocity_alerts,
)
from paywarden.operators.validation import HIGH_VALUE, MALFORMED, PROCESSED, REJECTED, outcome, validate
from paywarden.session import require_utc
from paywarden.sinks.writers import append_table, write_partitioned, write_velocity
from paywarden.sources.readers import read_lines
from paywarden.streaming.ledger import Ledger


LINE_FIELDS = (("malformed_line", T.StringType()), ("source_file", T.StringType()), ("block_start", T.LongType()))


@dataclass(frozen=True)
class BatchRun:
    """Folders of one run. Running it again replaces its output, and only its own."""

    output: str
    run_id: str
    profile: Profile = BATCH

    def _folder(self, name: str) -> str:
        return f"{self.output.rstrip('/')}/{name}/run_id={self.run_id}"

    @property
    def checked(self) -> str:
        return self._folder("checked")

    @property
    def high_value(self) -> str:
        return self._folder("fraud/high_value")

    @property
    def velocity(self) -> str:
        return self._folder("fraud/velocity")

    # Schemas are stated, so that a run without rows of a kind still reads back.
    def checked_schema(self) -> T.StructType:
        fields = list(S.TRANSACTION_SCHEMA.fields)
        fields.append(T.StructField(S.EVENT_TIME, T.TimestampType()))
        names = self.profile.flags if self.profile.keeps_flags else []
        fields += [T.StructField(n, T.StringType()) for n in (*names, "rejection_reason")]
        fields.append(T.StructField("outcome", T.StringType()))
        fields += [T.StructField(n, T.IntegerType()) for n in S.DATE_PARTS]
        return T.StructType(fields)

    def high_value_schema(self) -> T.StructType:
        kept = [f for f in self.checked_schema().fields if f.name != "outcome"]
        tags = [T.StructField(n, T.StringType()) for n in S.FRAUD_COLUMNS]
        return T.StructType(kept + tags)

    def read_checked(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.checked_schema()).parquet(self.checked)

    def read_valid(self, spark: SparkSession) -> DataFrame:
        return self.read_checked(spark).filter(~F.col("outcome").isin(REJECTED, MALFORMED))

    def read_processed(self, spark: SparkSession) -> DataFrame:
        return self.read_checked(spark).filter(F.col("outcome") == PROCESSED)

    def read_rejected(self, spark: SparkSession) -> DataFrame:
        """Rows that break a rule; lines that are no JSON object break many."""
        return self.read_checked(spark).filter(F.col("outcome").isin(REJECTED, MALFORMED))

    def read_malformed(self, spark: SparkSession) -> DataFrame:
        """Lines that are no JSON object, with the file and block that they stood in."""
        fields = [T.StructField(n, t) for n, t in LINE_FIELDS]
        lines = spark.read.schema(T.StructType([*fields, T.StructField("outcome", T.StringType())]))
        rows = lines.parquet(self.checked).filter(F.col("outcome") == MALFORMED)
        return rows.select(*(n for n, _ in LINE_FIELDS))

    def read_high_value(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.high_value_schema()).parquet(self.high_value)

    def read_velocity(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(S.VELOCITY_SCHEMA).parquet(self.velocity)

    def transactions(self, spark: SparkSession) -> DataFrame:
        """The transactions table: ten columns of the processed rows."""
        return self.read_processed(spark).select(*S.TRANSACTION_COLUMNS)

    def fraud_alerts(self, spark: SparkSession) -> DataFrame:
        """The alert table: both kinds of alert in one layout."""
        return all_alerts(self.read_high_value(spark), self.read_velocity(spark), self.profile)


def run_batch(
    spark: SparkSession,
    path: str,
    run: BatchRun,
    tables: dict | None = None,
    clustered: bool = False,
) -> DataFrame:
    """Check the JSON lines at ``path`` and return the summary row.

    The text is read once. Everything after that comes from the checked Parquet,
    where ``outcome`` is a folder and only the needed columns are read. With ``tables``
    (JDBC options, or ``folder`` for Parquet) both result tables are appended as well; a
    second run under the same ``run_id`` leaves out the rows that they have.

    ``clustered`` says that each input file holds few days. The checked rows are
    then written where they were read; otherwise one shuffle gathers each day first.
    """
    require_utc(spark)
    timed = with_date_parts(with_event_time(read_lines(spark, path)))
    checked = validate(timed, run.profile)
    malformed = F.col("malformed_line").isNotNull()
    routed = checked.withColumn("outcome", F.when(malformed, F.lit(MALFORMED)).otherwise(outcome(run.profile)))
    # Where a line stood is kept of malformed ones.
    routed = routed.withColumns({n: F.when(malformed, F.col(n)) for n, _ in LINE_FIELDS[1:]})
    write_partitioned(
        routed, run.checked, ("outcome", *S.DATE_PARTS), mode="overwrite", rebalance=not clustered
    )

    valid = run.read_valid(spark)
    write_partitioned(high_value_alerts(valid.drop("outcome")), run.high_value, mode="overwrite")
    write_velocity(velocity_alerts(valid), run.velocity, mode="overwrite")

    if tables:
        ledger = Ledger(spark, f"{run.output.rstrip('/')}/table_appends")
        again = ledger.begin("batch", run.run_id, 0)
        append_table(run.transactions(spark), "transactions", "transaction_id", again, **tables)
        alerts = stamp_alerts(run.fraud_alerts(spark))
        append_table(alerts, "fraud_alerts", "fraud_alert_id", again, **tables)
        ledger.mark_processed("batch", run.run_id, 0)
    return batch_summary(spark, run)


def batch_summary(spark: SparkSession, run: BatchRun) -> DataFrame:
    """Counts of a finished run, from Parquet row counts alone."""
    parts = (
        run.read_checked(spark).select(F.col("outcome").alias("part")),
        run.read_high_value(spark).select(F.lit(S.HIGH_VALUE_RULE).alias("part")),
        run.read_velocity(spark).select(F.lit(S.VELOCITY_RULE).alias("part")),
    )
    counted = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("part").count()

    def of(*names: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("part").isin(*names), F.col("count"))), F.lit(0))

    return counted.agg(
        of(PROCESSED, HIGH_VALUE, REJECTED, MALFORMED).alias("total_transactions"),
        of(PROCESSED, HIGH_VALUE).alias("valid_transactions"),
        of(REJECTED, MALFORMED).alias("rejected_transactions"),
        of(S.HIGH_VALUE_RULE).alias("high_value_alerts"),
        of(S.VELOCITY_RULE).alias("velocity_alerts"),
    )

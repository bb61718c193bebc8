"""Report figures kept as partials that batches of alerts add to.

For each batch of alerts three small tables are written: counts and money by day, rule and the
value of each breakdown; numbers for customers not met before; and bitmaps of the customers'
numbers by day and rule. Sums of sums and unions of bitmaps give the same figures as the
alert rows, distinct customers included, so a report opens the partials alone.

A batch is written under its name; the same name again replaces it. Batches are added one after the
other: the numbering of new customers is one writer's work.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paywarden.functions.columns import MONEY, money_left_out
from paywarden.operators.reports import ALL
from paywarden.schema import EVENT_TIME

# Breakdowns of the report, beside the total.
DIMENSIONS = ("customer_id", "merchant", "transaction_type", "location", "fraud_rule")
TOTAL = "total"

MEASURES = "fraud_date date, fraud_rule string, value string, n long, total decimal(38,2), left_out long, " \
           "dimension string, batch string"
CUSTOMERS = "customer_id string, number long, batch string"
BITMAPS = "fraud_date date, fraud_rule string, bucket long, bits binary, batch string"


class ReportPartials:
    """Partials below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, table: str, batch: str, *by: str) -> None:
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(f"{self.path}/{table}/batch={batch}")

    def add(self, alerts: DataFrame, batch: str) -> None:
        """Add a batch of alerts, which is read three times and should be a stored table."""
        dated = alerts.withColumn("fraud_date", F.to_date(EVENT_TIME))
        values = [F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in DIMENSIONS]
        values.append(F.struct(F.lit(TOTAL).alias("dimension"), F.lit(None).cast("string").alias("value")))
        cut = dated.select("fraud_date", "fraud_rule", "amount", F.explode(F.array(*values)).alias("of"))
        counted = cut.groupBy("fraud_date", "fraud_rule", "of.value", "of.dimension").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").try_cast(MONEY)).cast("decimal(38,2)").alias("total"),
            money_left_out().alias("left_out"))
        self._write(counted, "measures", batch, "dimension")
        self._number(alerts.select("customer_id"), batch)
        numbers = self._read("customers", CUSTOMERS).select("customer_id", "number")
        met = dated.select("fraud_date", "fraud_rule", "customer_id").distinct().join(numbers, "customer_id")
        maps = met.groupBy("fraud_date", "fraud_rule", F.bitmap_bucket_number("number").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
        self._write(maps, "bitmaps", batch)

    def _number(self, customers: DataFrame, batch: str) -> None:
        """Numbers without gaps for customers not met before; a batch that comes again keeps its own."""
        known = self._read("customers", CUSTOMERS)
        first = (known.agg(F.max("number")).first()[0] or 0) + 1
        new = customers.filter("customer_id IS NOT NULL").distinct().join(known, "customer_id", "left_anti")
        # Where they are written they have a part and a place in it; parts follow one another.
        draft = f"{self.path}/_drafts/{batch}"
        new = new.select("customer_id", F.lit(None).cast("long").alias("number"),
                         F.monotonically_increasing_id().alias("at"))
        own = known.filter(F.col("batch") == batch).select("customer_id", "number", F.lit(None).cast("long").alias("at"))
        new.unionByName(own).write.mode("overwrite").parquet(draft)
        placed = self.spark.read.parquet(draft).select(
            "customer_id", "number", F.shiftright("at", 33).alias("part"),
            F.col("at").bitwiseAND((1 << 33) - 1).alias("place"))
        starts, start = [], first
        counts = placed.filter("part IS NOT NULL").groupBy("part").count().collect()  # a row a task that wrote
        for part, n in sorted(tuple(r) for r in counts):
            starts.append((part, start))
            start += n
        starts = self.spark.createDataFrame(starts, "part long, start long")
        self._write(placed.join(F.broadcast(starts), "part", "left").select(
            "customer_id", F.coalesce("number", F.col("start") + F.col("place")).alias("number")), "customers", batch)

    def _chosen(self, rows: DataFrame, rule: str | None, dates: Sequence[dt.date] | None) -> DataFrame:
        if rule not in (None, ALL):
            rows = rows.filter(F.col("fraud_rule") == rule)
        if dates is not None and len(dates) == 2:
            rows = rows.filter(F.col("fraud_date").between(*dates))
        return rows

    def _measures(self, dimension: str, rule: str | None, dates: Sequence[dt.date] | None) -> DataFrame:
        rows = self._read("measures", MEASURES).filter(F.col("dimension") == dimension)
        return self._chosen(rows, rule, dates)

    def kpi_alerts(
        self, customer: str | None = None, rule: str | None = None, dates: Sequence[dt.date] | None = None
    ) -> DataFrame:
        """Count, amount and number of customers of the chosen alerts."""
        if customer not in (None, ALL):
            rows = self._measures("customer_id", rule, dates).filter(F.col("value") == customer)
            return rows.agg(*_sums("total_amount"), F.count_distinct("value").alias("customers"))
        sums = self._measures(TOTAL, rule, dates).agg(*_sums("total_amount"))
        # Both are one row.
        return sums.crossJoin(self._customers(rule, dates))

    def _customers(self, rule: str | None, dates: Sequence[dt.date] | None) -> DataFrame:
        merged = self._chosen(self._read("bitmaps", BITMAPS), rule, dates).groupBy("bucket").agg(
            F.bitmap_or_agg("bits").alias("bits"))
        return merged.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("customers"))

    def alerts_by(
        self, column: str, amount_as: str | None = None, rule: str | None = None,
        dates: Sequence[dt.date] | None = None,
    ) -> DataFrame:
        """Alerts per value of a breakdown, most first; ties by the value itself."""
        measures = _sums(amount_as or "amount", "alert_count")
        rows = self._measures(column, rule, dates).groupBy(F.col("value").alias(column)).agg(
            *(measures if amount_as else measures[:1]))
        return rows.orderBy(F.desc("alert_count"), F.asc(column))

    def alert_trend(self, rule: str | None = None) -> DataFrame:
        """Alerts per day, in date order."""
        return self._measures(TOTAL, rule, None).groupBy("fraud_date").agg(
            F.sum("n").alias("fraud_alert_count")).orderBy("fraud_date")

    def date_bounds(self) -> DataFrame:
        return self._measures(TOTAL, None, None).agg(
            F.min("fraud_date").alias("min_date"), F.max("fraud_date").alias("max_date"))

    def distinct_values(self, column: str) -> DataFrame:
        return self._measures(column, None, None).select(F.col("value").alias(column)).distinct().orderBy(column)


def _sums(amount_as: str, count_as: str = "total_alerts") -> list[Column]:
    return [
        F.coalesce(F.sum("n"), F.lit(0)).alias(count_as),
        F.coalesce(F.sum("total"), F.lit(0)).cast("double").alias(amount_as),
        F.coalesce(F.sum("left_out"), F.lit(0)).alias("amounts_left_out"),
    ]

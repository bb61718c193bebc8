"""Keys of all earlier micro-batches, for copies that come after the state has forgotten them.

De-duplication in state is exact within the watermark and bounded. What it lets through is held
against this table, which makes it exact for good: the keys of every batch by day, and for each
day a Bloom filter in BUCKETS parts by the key's hash. A look-up asks the filters first; the keys
themselves are read only of the days and buckets where a filter says that one may be there.

A batch writes its keys and filters under its own name before it is marked, and a replay
replaces them and does not count them as seen. ``settle`` brings the batches of past days together.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paywarden.streaming.writing import remove

BUCKETS = 64
# Bits of a day's filter in each bucket, and how many a key sets: one key in 10,000 is found by
# chance while a bucket has up to 3,400 keys a day.
BITS = 1 << 16
PROBES = 10
NO_DAY = dt.date(1970, 1, 1)

KEYS = "key string, bucket int, batch string, day date"
FILTERS = "day date, bucket int, bits binary, batch string"


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """Places in the filter, a row a key, from two halves of a 64-bit hash."""
    first, second = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)
    return ((first[:, None] + steps * second[:, None]) % np.uint64(bits)).astype(np.int64)


def _set(keys: np.ndarray, bits: int) -> bytes:
    marks = np.zeros(bits, bool)
    marks[_places(keys, bits).ravel()] = True
    return np.packbits(marks).tobytes()


class KeyHistory:
    """Keys below ``path``; ``key`` is the column that tells rows apart."""

    def __init__(
        self, spark: SparkSession, path: str, key: str = "transaction_id", buckets: int = BUCKETS, bits: int = BITS
    ):
        self.spark, self.path, self.key, self.buckets, self.bits = spark, path.rstrip("/"), key, buckets, bits

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def add(self, rows: DataFrame, day: Column, batch: str) -> None:
        """The keys of a batch; ``day`` says to which day's filter a row belongs."""
        keys = rows.filter(F.col(self.key).isNotNull()).select(
            F.col(self.key).alias("key"), F.coalesce(day, F.lit(NO_DAY)).alias("day"))
        keys = keys.withColumn("bucket", self._bucket("key")).distinct()
        self._write(keys, batch)

    def _write(self, keys: DataFrame, batch: str) -> None:
        ordered = keys.repartition("day").sortWithinPartitions("day", "bucket")
        ordered.select("key", "bucket", "day").write.mode("overwrite").partitionBy("day").parquet(
            f"{self.path}/keys/batch={batch}")
        stored = self._read("keys", KEYS).filter(F.col("batch") == batch)
        bits = self.bits

        def made(table: pa.Table) -> pa.Table:
            hashes = table["hash"].to_numpy().view(np.uint64)
            return pa.table({"day": table["day"][:1], "bucket": table["bucket"][:1],
                             "bits": pa.array([_set(hashes, bits)], pa.binary())})

        filters = stored.select("day", "bucket", F.xxhash64(F.lit(1), "key").alias("hash")).groupBy(
            "day", "bucket").applyInArrow(made, "day date, bucket int, bits binary")
        filters.write.mode("overwrite").parquet(f"{self.path}/filters/batch={batch}")

    def candidates(self, keys: DataFrame, batch: str) -> DataFrame:
        """Keys (key, bucket) with the days on whose filters they may be: key, bucket, day."""
        filters = self._read("filters", FILTERS).filter(F.col("batch") != batch).select("day", "bucket", "bits")
        wanted = keys.select("key", "bucket", F.xxhash64(F.lit(1), "key").alias("hash"))
        size = self.bits

        def met(left: pa.Table, right: pa.Table) -> pa.Table:
            places = _places(left["hash"].to_numpy().view(np.uint64), size)
            found, days = [], []
            for day, raw in zip(right["day"].to_pylist(), right["bits"].to_pylist()):
                marks = np.unpackbits(np.frombuffer(raw, np.uint8)).astype(bool)
                at = np.flatnonzero(marks[places].all(axis=1))
                found.append(at)
                days += [day] * len(at)
            at = np.concatenate(found) if found else np.empty(0, np.int64)
            return pa.table({"key": left["key"].take(pa.array(at)), "bucket": left["bucket"].take(pa.array(at)),
                             "day": pa.array(days, pa.date32())})

        return wanted.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(
            met, "key string, bucket int, day date")

    def unseen(self, rows: DataFrame, batch: str) -> DataFrame:
        """Rows of a stored batch whose key no other batch has brought; rows without a key stay."""
        name = self.key
        keys = rows.filter(F.col(name).isNotNull()).select(F.col(name).alias("key")).distinct()
        may = self.candidates(keys.withColumn("bucket", self._bucket("key")), batch).persist()
        try:
            # At most a row a day and bucket.
            places = may.select("day", "bucket").distinct().collect()
            if not places:
                return rows
            days, buckets = sorted({p.day for p in places}), sorted({p.bucket for p in places})
            known = self._read("keys", KEYS).filter(
                F.col("day").isin(days) & F.col("bucket").isin(buckets) & (F.col("batch") != batch))
            seen = known.select("key").join(may.select("key").distinct(), "key", "left_semi").distinct()
            folder = f"{self.path}/seen/batch={batch}"
            seen.write.mode("overwrite").parquet(folder)
        finally:
            may.unpersist()
        seen = self.spark.read.schema("key string").parquet(folder)
        return rows.join(seen, rows[name] == seen["key"], "left_anti")

    def done(self, batch: str) -> None:
        """Remove what the look-up of a batch has left."""
        remove(self.spark, f"{self.path}/seen/batch={batch}")

    def settle(self, before: dt.date) -> int:
        """Bring together the keys of days before ``before``, a folder a run; returns how many batches went.

        Keys are there twice for a moment, which changes no answer. Only batches that have no later
        day go.
        """
        keys = self._read("keys", KEYS)
        last = keys.groupBy("batch").agg(F.max("day").alias("last"))
        old = [r.batch for r in last.filter(F.col("last") < F.lit(before)).collect()]
        if len(old) < 2:
            return 0
        name = f"until-{before}"
        old = [b for b in old if b != name]
        some = keys.filter(F.col("batch").isin(*old, name)).select("key", "day", "bucket").distinct()
        draft = f"{self.path}/drafts/{name}"
        some.write.mode("overwrite").parquet(draft)
        self._write(self.spark.read.parquet(draft), name)
        for batch in old:
            remove(self.spark, f"{self.path}/filters/batch={batch}")
            remove(self.spark, f"{self.path}/keys/batch={batch}")
        remove(self.spark, draft)
        return len(old)

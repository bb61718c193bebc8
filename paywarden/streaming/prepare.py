"""Streaming preparation: event time, watermark, de-duplication, validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from paywarden.functions.columns import with_date_parts, with_event_time
from paywarden.functions.rules import STREAM, Profile
from paywarden.operators.fraud import velocity_alerts
from paywarden.operators.validation import valid_rows, validate
from paywarden.schema import EVENT_TIME, VELOCITY_THRESHOLD, VELOCITY_WINDOW, WATERMARK_DELAY

KEYS = ("transaction_id",)
# Later than any event; a row without a time stands there while its key is remembered.
NEVER = "9999-01-01 00:00:00"


def fold_copies(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keep one row per key within each Arrow batch, the one with the latest event time.

    Runs in front of the shuffle to the state store, which has no partial stage
    of its own: a key repeated by a large share of the input would otherwise
    reach one task row by row. The latest copy is the one least likely to be
    late, so folding never turns a key that is on time into a late one. Whole
    rows are kept, so any later exact de-duplication gives the same set of keys.
    """
    names = list(keys)

    def fold(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            table = pa.Table.from_batches([batch])
            ids = table.select(names)
            if ids.group_by(names, use_threads=False).aggregate([]).num_rows == table.num_rows:
                yield batch
                continue
            order = pc.sort_indices(
                table, sort_keys=[(EVENT_TIME, "descending")], null_placement="at_end"
            )
            ranked = ids.take(order).append_column("row", order)
            kept = ranked.group_by(names, use_threads=False).aggregate([("row", "first")])
            yield from table.take(kept["row_first"]).combine_chunks().to_batches()

    return df.mapInArrow(fold, df.schema)


def dedupe_stream(
    df: DataFrame, keys: Sequence[str] = KEYS, bounded: bool = True, salts: int = 0
) -> DataFrame:
    """One row per key of a watermarked stream.

    With ``salts`` there are two stages: the first cuts each key to one row a salt, in as many tasks, so
    that of a key with a large share of all rows no more than that reach the task of the
    second. It doubles the state and adds a shuffle.

    Bounded: a key is forgotten once the watermark passes its event time, so
    state stays proportional to the delay. A row without a time has no such moment:
    it enters under the end of time, which keeps its key for good, and leaves without.
    Unbounded: a key is remembered for good and state grows with the number of keys
    ever seen.
    """
    if salts:
        # Spark fixes the seed of the salt for a micro-batch, so a task that is run again gives the same.
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.uuid()), F.lit(salts)))
        df = dedupe_stream(salted, (*keys, "_salt"), bounded).drop("_salt")
    if not bounded:
        return df.dropDuplicates(list(keys))
    never = F.to_timestamp(F.lit(NEVER))
    # The replaced column is still the one that carries the watermark.
    timed = F.coalesce(EVENT_TIME, never).alias(EVENT_TIME, metadata=_delay(df))
    places = [timed if c == EVENT_TIME else F.col(c) for c in df.columns]
    single = df.select(*places).dropDuplicatesWithinWatermark(list(keys))
    back = F.nullif(EVENT_TIME, never).alias(EVENT_TIME, metadata=_delay(df))
    return single.select(*(back if c == EVENT_TIME else F.col(c) for c in df.columns))


def _delay(df: DataFrame) -> dict:
    return df.schema[EVENT_TIME].metadata


def has_key(keys: Sequence[str] = KEYS):
    """Every key column present and not blank."""
    filled = [F.col(k).isNotNull() & (F.col(k) != "") for k in keys]
    keyed = filled[0]
    for part in filled[1:]:
        keyed = keyed & part
    return keyed


def prepare_stream(
    raw: DataFrame, delay: str = WATERMARK_DELAY, fold_keys: Sequence[str] = (), parts: bool = True
) -> DataFrame:
    """Event time in place of the raw text, date parts if wanted, and the watermark.

    With ``fold_keys``, copies that lie next to each other are folded first.
    """
    timed = with_event_time(raw, keep=False)
    if parts:
        timed = with_date_parts(timed)
    if fold_keys:
        timed = fold_copies(timed, fold_keys)
    return timed.withWatermark(EVENT_TIME, delay)


def _deduplicated(
    raw: DataFrame, keys: Sequence[str], delay: str, bounded: bool, fold: bool, parts: bool = True,
    salts: int = 0,
) -> DataFrame:
    prepared = prepare_stream(raw, delay, keys if fold else (), parts)
    return dedupe_stream(prepared, keys, bounded, salts)


def keyed_stream(
    raw: DataFrame, delay: str = WATERMARK_DELAY, bounded: bool = True, fold: bool = True,
    parts: bool = True,
) -> DataFrame:
    """De-duplicated rows that carry a transaction id."""
    return _deduplicated(raw.filter(has_key()), KEYS, delay, bounded, fold, parts)


def checked_stream(
    raw: DataFrame,
    profile: Profile = STREAM,
    delay: str = WATERMARK_DELAY,
    bounded: bool = True,
    keep_unkeyed: bool = True,
    fold: bool = True,
    salts: int = 0,
    late: bool = False,
) -> DataFrame:
    """De-duplicated and validated rows, from one read of the source.

    Rows without a transaction id cannot be copies of one another. By default
    each gets a token of its own that joins the key, which also spreads them
    over all tasks, and validation rejects each of them. Spark fixes the seed of
    the token for a micro-batch, so a task that is run again gives the same.
    With ``keep_unkeyed=False`` one row stands for all NULL ids and one for all
    blank ids.

    ``salts`` are for ids that hold a large share of the rows (``dedupe_stream``). With ``late``,
    rows that come after the watermark are there too, as they came, and ``is_late`` tells
    them apart; the source is then read twice.
    """
    if not keep_unkeyed:
        single = _deduplicated(raw, KEYS, delay, bounded, fold, salts=salts)
    else:
        marked = raw.withColumn("_token", F.when(has_key(), F.lit("")).otherwise(F.uuid()))
        single = _deduplicated(marked, (*KEYS, "_token"), delay, bounded, fold, salts=salts).drop("_token")
    if late:
        single = single.withColumn("is_late", F.lit(False)).unionByName(late_rows(raw, delay))
    return validate(single, profile)


class _Late(StatefulProcessor):
    """Lets through what the watermark has passed; keeps nothing."""

    def __init__(self, names: list[str]):
        self.row = T.Row(*names)

    def init(self, handle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        for row in rows:
            given = row.asDict()
            # As Spark has it: a row on the watermark is late.
            if given["_micros"] <= mark:
                yield self.row(*(given.get(n) for n in self.row))

    def close(self) -> None:
        pass


LATE_SLOTS = 200


def late_rows(raw: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """The rows of a stream that come after its watermark, which stateful operators drop.

    The rows' time goes along as a plain number: Spark would drop late ones here as well if the column
    still carried the watermark. Rows are spread over the tasks at random and none is kept.
    """
    timed = with_event_time(raw, keep=False).withWatermark(EVENT_TIME, delay)
    names = [c for c in timed.columns if c != EVENT_TIME]
    plain = timed.filter(F.col(EVENT_TIME).isNotNull()).select(
        *names, F.unix_micros(EVENT_TIME).alias("_micros"),
        F.pmod(F.xxhash64(F.uuid()), F.lit(LATE_SLOTS)).alias("_slot"))
    schema = T.StructType([f for f in plain.schema.fields if f.name != "_slot"])
    found = plain.groupBy("_slot").transformWithState(
        statefulProcessor=_Late(schema.names), outputStructType=schema, outputMode="append",
        timeMode="eventTime")
    back = found.select(*names, F.timestamp_micros("_micros").alias(EVENT_TIME))
    return with_date_parts(back).withColumn("is_late", F.lit(True))


def velocity_stream(
    raw: DataFrame,
    profile: Profile = STREAM,
    delay: str = WATERMARK_DELAY,
    bounded: bool = True,
    window: str = VELOCITY_WINDOW,
    threshold: int = VELOCITY_THRESHOLD,
    fold: bool = True,
) -> DataFrame:
    """Velocity alerts over the valid, de-duplicated rows.

    In update mode a window is emitted again each time its count grows; in
    append mode once, when the watermark passes its end. Only what rules, windows and
    keys need is carried along, and rows without a time, which have no window, are not.
    """
    needed = [c for c in raw.columns if c != "location"]
    timed = raw.select(*needed).filter(F.try_to_timestamp("timestamp").isNotNull())
    valid = valid_rows(keyed_stream(timed, delay, bounded, fold, parts=False), profile)
    return velocity_alerts(valid, window, threshold)

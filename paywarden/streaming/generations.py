"""Compaction of committed micro-batches into generations.

A run leaves a folder for each micro-batch. Compaction writes the rows of many batches, batch
numbers included, into one folder and publishes a manifest that names it; readers go by the
newest manifest. Generations of one level are merged into one of the next when there are
enough of them, so a row is rewritten as often as there are levels, the logarithm of the number
of batches.

A manifest is published in one step and only if its version is new, so of two compactions one
counts. A crash before that leaves a folder that no manifest names and no reader sees. A
reader that has listed its files keeps reading them: old folders go only by ``vacuum``, some time later.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from paywarden.sinks.writers import adaptive, balanced
from paywarden.streaming.ledger import Generation, Ledger, Manifest, batch_folder
from paywarden.streaming.writing import file_at

# Batches that are worth a generation, and generations of a level that are merged.
AT_LEAST = 16
FAN = 8
FOLDER = "_generations"


def compact(
    spark: SparkSession, path: str, schema: T.StructType, ledger: Ledger, query: str, run_id: str,
    by: Sequence[str] = (), at_least: int = AT_LEAST, fan: int = FAN,
) -> bool:
    """Bring together the committed batches of a run that no generation holds yet.

    Returns False when there are fewer than ``at_least``, or another compaction was faster.
    """
    path = path.rstrip("/")
    mark, manifest = ledger.mark(query, run_id), ledger.manifest(query, run_id)
    kept = list(manifest.generations)
    first = kept[-1].last + 1 if kept else 0
    if mark is None or mark.batch_id - first + 1 < at_least:
        return False
    numbers = ledger.batches(path, run_id, first, mark.batch_id)
    stored = T.StructType([f for f in schema.fields if f.name not in ("run_id", "batch_id")]
                          + [T.StructField("batch_id", T.LongType())])
    parts = []
    if numbers:
        parts.append(spark.read.schema(stored).option("basePath", f"{path}/run_id={run_id}").parquet(
            *(batch_folder(path, run_id, n) for n in numbers)))
    level = 0
    while len(kept) >= fan and all(g.level == level for g in kept[-fan:]):
        merged, kept = kept[-fan:], kept[:-fan]
        first, level = merged[0].first, level + 1
        parts += [spark.read.schema(stored).parquet(f"{path}/{g.folder}") for g in merged if g.folder]
    folder = None
    if parts:
        folder = f"{FOLDER}/run_id={run_id}/{first}-{mark.batch_id}-{uuid.uuid4().hex}"
        rows = reduce(DataFrame.unionByName, parts)
        with adaptive(spark):
            writer = balanced(rows, by).write
            (writer.partitionBy(*by) if by else writer).parquet(f"{path}/{folder}")
    new = Manifest(manifest.version + 1, (*kept, Generation(first, mark.batch_id, level, folder)))
    if ledger.publish(query, run_id, new):
        return True
    if folder:
        place, files = file_at(spark, f"{path}/{folder}")
        files.delete(place, True)
    return False


def vacuum(
    spark: SparkSession, path: str, ledger: Ledger, query: str, run_id: str, older_than: float = 86_400.0
) -> int:
    """Delete folders that the newest manifest has replaced; returns how many.

    Nothing goes unless that manifest is ``older_than`` seconds old, which no reader of the
    folders before it may outlast.
    """
    path = path.rstrip("/")
    manifest = ledger.manifest(query, run_id)
    if not manifest.generations or time.time() - ledger.published(query, run_id) < older_than:
        return 0
    gone = [batch_folder(path, run_id, n)
            for n in ledger.batches(path, run_id, 0, manifest.generations[-1].last)]
    place, files = file_at(spark, f"{path}/{FOLDER}/run_id={run_id}")
    if files.exists(place):
        named = {g.folder for g in manifest.generations}
        for status in files.listStatus(place):
            folder = f"{FOLDER}/run_id={run_id}/{status.getPath().getName()}"
            # Younger ones may be of a compaction that has not published yet.
            if folder not in named and time.time() - status.getModificationTime() / 1000 >= older_than:
                gone.append(f"{path}/{folder}")
    for folder in gone:
        place, files = file_at(spark, folder)
        files.delete(place, True)
    return len(gone)

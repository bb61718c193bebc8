"""What the operators share: tables, the shared folder, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows turned into Python objects at once; bounds a task's memory beside the Arrow batch.
ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Lists that new folders are noted in; the last one counts.
_owners: list[list[str]] = []


@contextmanager
def owned(folders: list[str]) -> Iterator[list[str]]:
    """Note the folders that are made meanwhile in ``folders``, for whoever is to drop them."""
    _owners.append(folders)
    try:
        yield folders
    finally:
        _owners.pop()


def drop(spark: SparkSession, folders: list[str]) -> None:
    """Delete noted folders, and forget them."""
    context = spark.sparkContext
    while folders:
        path = context._jvm.org.apache.hadoop.fs.Path(folders.pop())
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the one that ``spark.checkpoint.dir`` names, which all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    folder = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _owners:
        _owners[-1].append(folder)
    return folder


# Spark's own option: what a finished query has shuffled is removed at once, not when the driver
# next collects its garbage. Nothing runs a stored table's query again.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stash(frame: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """The frame, written to the shared folder and read back: no lineage, computed once."""
    spark = frame.sparkSession
    folder = shared_folder(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        frame.write.parquet(folder, compression=codec)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(folder)


def once(docs: DataFrame, text: str = "text", *others: str) -> DataFrame:
    """The different texts, or rows of text and other columns. Only those that have copies move,
    folded in each task first."""
    mark = fresh(docs, "_digest")
    names = [text, *others]
    marked = docs.select(*names, F.xxhash64(*names).alias(mark))
    # Stored, so that Spark knows the size and broadcasts it where it is small.
    copied = stash(marked.groupBy(mark).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(mark), "copied")
    folded = marked.join(copied, mark, "left_semi").groupBy(mark).agg(*(F.first(c).alias(c) for c in names))
    return marked.join(copied, mark, "left_anti").select(*names).unionByName(folded.select(*names))


_resident: dict[str, object] = {}


def resident(name: str, make: Callable[[], object]) -> object:
    """What a Python worker keeps from task to task: one thing, the one asked for last.

    Workers serve one operator after the other; what an earlier one kept is let go.
    """
    if name not in _resident:
        _resident.clear()
        _resident[name] = make()
    return _resident[name]


def columns(batch: pa.RecordBatch, *names: str, rows: int = ROWS) -> Iterator[tuple[list, ...]]:
    """The named columns as Python lists, a bounded number of rows at a time."""
    for start in range(0, batch.num_rows, rows):
        part = batch.slice(start, rows)
        yield tuple(part.column(part.schema.get_field_index(n)).to_pylist() for n in names)


def fresh(frame: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame does not have in any spelling."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name

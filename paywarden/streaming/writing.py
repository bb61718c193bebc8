"""The folder that a micro-batch owns."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from paywarden.sinks.writers import adaptive, balanced, write_partitioned
from paywarden.streaming.ledger import Epoch, Fenced, batch_folder, rename


def write_batch(
    df: DataFrame, path: str, run_id: str, batch_id: int, by: Sequence[str] = (), epoch: Epoch | None = None
) -> str:
    """Write a micro-batch into the folder that it owns, replacing all of it.

    A replay of the batch therefore leaves exactly its own rows, also when a
    row has moved to another day in between. A batch without rows leaves no folder,
    and "" is returned. What was written tells: asking the batch would compute it twice.

    With an epoch the rows are written aside and get their name in one step, after a look at
    who holds the run; a driver that was fenced off raises and leaves nothing.
    """
    target = batch_folder(path, run_id, batch_id)
    folder = target if epoch is None else f"{path.rstrip('/')}/_staged/{uuid.uuid4().hex}"
    with adaptive(df.sparkSession):
        if by:
            write_partitioned(df, folder, by, mode="overwrite")
        else:
            balanced(df).write.mode("overwrite").parquet(folder)
        empty = df.sparkSession.read.schema(df.schema).parquet(folder).isEmpty()
    if empty:
        remove(df.sparkSession, folder)
    if epoch is not None:
        try:
            _name(df.sparkSession, folder, target, empty, epoch)
        except Fenced:
            remove(df.sparkSession, folder)
            raise
    return "" if empty else target


def _name(spark: SparkSession, staged: str, target: str, empty: bool, epoch: Epoch) -> None:
    """Put a staged batch in place of what an earlier try of the run's own left there."""
    source, files = file_at(spark, staged)
    place, _ = file_at(spark, target)
    epoch.check()
    if files.exists(place):
        files.delete(place, True)
    if empty:
        return
    files.mkdirs(place.getParent())
    if not rename(spark, source, place):
        raise Fenced(f"another driver has written {target}")


def file_at(spark: SparkSession, folder: str):
    """(path, file system) of a folder or file."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, folder: str) -> None:
    path, files = file_at(spark, folder)
    files.delete(path, True)


def batch_exists(spark: SparkSession, folder: str) -> bool:
    """Whether a folder was written to the end."""
    path, files = file_at(spark, f"{folder}/_SUCCESS")
    return files.exists(path)

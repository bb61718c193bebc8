"""Ledger of committed micro-batches, fencing of writers, and reads that see only what is committed.

Batches of a run are committed in order, so a run needs one mark: the number up to which
its batches are committed. A mark is an empty file that carries the number in its name and
the time in its date; a newer mark is made before older ones go. Looking at the ledger lists
a few names and runs no job. A run is the life of one checkpoint: a new checkpoint starts
again at batch 0 and so must have a new run id.

A driver that takes a run over takes an epoch first, a file that only one can create. From
then on drivers of older epochs cannot commit: they look before they publish a batch and before
they mark it, both of which happen only if nobody else has.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_KEY_FIELDS = [
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
]


@dataclass(frozen=True)
class Mark:
    """The batches of a run up to ``batch_id`` are committed, the last of them at ``at`` (ms)."""

    run_id: str
    batch_id: int
    at: int


@dataclass(frozen=True)
class Generation:
    """Batches ``first`` to ``last`` brought together in a folder; none where they have no rows."""

    first: int
    last: int
    level: int
    folder: str | None


@dataclass(frozen=True)
class Manifest:
    """What a run's compacted batches are read from, in order."""

    version: int
    generations: tuple[Generation, ...]


class Fenced(RuntimeError):
    """Another driver has taken the run over, or has committed the batch."""


@dataclass(frozen=True)
class Epoch:
    """A driver's turn at a run."""

    ledger: Ledger
    query: str
    run_id: str
    number: int

    def check(self) -> None:
        newest = self.ledger.newest_epoch(self.query, self.run_id)
        if newest != self.number:
            raise Fenced(f"epoch {self.number} of {self.query} {self.run_id} has ended, {newest} holds")


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _file(self, *parts: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _listed(self, *parts: str) -> list:
        path, files = self._file(*parts)
        return list(files.listStatus(path)) if files.exists(path) else []

    def _numbers(self, query: str, run_id: str, kind: str) -> dict[int, int]:
        """Number and time of each file of a kind."""
        found = {}
        for status in self._listed(query, run_id):
            name, _, number = status.getPath().getName().partition("-")
            if name == kind:
                found[int(number)] = status.getModificationTime()
        return found

    def _set(self, query: str, run_id: str, kind: str, number: int) -> None:
        path, files = self._file(query, run_id, f"{kind}-{number}")
        files.create(path, True).close()
        for older in self._numbers(query, run_id, kind):
            if older < number:
                old, _ = self._file(query, run_id, f"{kind}-{older}")
                files.delete(old, False)

    def _create(self, query: str, run_id: str, name: str, content: bytes = b"") -> bool:
        """Create a file with its content unless there is one; False if there is."""
        path, files = self._file(query, run_id, name)
        draft, _ = self._file(query, run_id, f".{name}.{uuid.uuid4().hex}")
        out = files.create(draft, False)
        out.write(bytearray(content))
        out.close()
        if rename(self.spark, draft, path):
            return True
        files.delete(draft, False)
        return False

    def newest_epoch(self, query: str, run_id: str) -> int:
        return max(self._numbers(query, run_id, "epoch"), default=-1)

    def take(self, query: str, run_id: str) -> Epoch:
        """A new epoch of a run; drivers of older ones are fenced off from here on."""
        while True:
            number = self.newest_epoch(query, run_id) + 1
            if self._create(query, run_id, f"epoch-{number}"):
                return Epoch(self, query, run_id, number)

    def is_processed(self, query: str, run_id: str, batch_id: int) -> bool:
        return batch_id <= max(self._numbers(query, run_id, "done"), default=-1)

    def begin(self, query: str, run_id: str, batch_id: int) -> bool:
        """Note that a batch is tried; True when it was tried before."""
        again = batch_id <= max(self._numbers(query, run_id, "begun"), default=-1)
        if not again:
            self._set(query, run_id, "begun", batch_id)
        return again

    def mark_processed(self, query: str, run_id: str, batch_id: int, epoch: Epoch | None = None) -> None:
        """Set last, after all output of the batch. Marking twice changes nothing.

        With an epoch, a driver that was fenced off raises and leaves no mark.
        """
        if epoch is not None:
            epoch.check()
            if not self._create(query, run_id, f"done-{batch_id}"):
                raise Fenced(f"batch {batch_id} of {query} {run_id} is committed already")
        if not self.is_processed(query, run_id, batch_id) or epoch is not None:
            self._set(query, run_id, "done", batch_id)

    def batches(self, path: str, run_id: str, first: int, last: int) -> list[int]:
        """Numbers of a run's batches that have a folder, in order; one listing."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/run_id={run_id}")
        _, files = self._file()
        if not files.exists(folder):
            return []
        names = (status.getPath().getName().partition("=") for status in files.listStatus(folder))
        return sorted(n for name, _, value in names if name == "batch_id" and first <= (n := int(value)) <= last)

    def manifest(self, query: str, run_id: str) -> Manifest:
        """The newest manifest of a run; an empty one, version -1, before the first."""
        version = max(self._numbers(query, run_id, "manifest"), default=-1)
        if version < 0:
            return Manifest(-1, ())
        path, files = self._file(query, run_id, f"manifest-{version}")
        stream = files.open(path)
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        return Manifest(version, tuple(Generation(**g) for g in json.loads(text)))

    def published(self, query: str, run_id: str) -> float:
        """When the newest manifest was published, in seconds."""
        times = self._numbers(query, run_id, "manifest")
        return times[max(times)] / 1000 if times else 0.0

    def publish(self, query: str, run_id: str, manifest: Manifest) -> bool:
        """Make a manifest the newest, unless its version is there already."""
        content = json.dumps([vars(g) for g in manifest.generations]).encode()
        return self._create(query, run_id, f"manifest-{manifest.version}", content)

    def marks(self, query: str) -> list[Mark]:
        """One mark a run, the newest first."""
        found = []
        for status in self._listed(query):
            run_id = status.getPath().getName()
            if done := self._numbers(query, run_id, "done"):
                found.append(Mark(run_id, max(done), done[max(done)]))
        return sorted(found, key=lambda mark: (mark.at, mark.run_id), reverse=True)

    def mark(self, query: str, run_id: str | None = None) -> Mark | None:
        """The mark of a run, by default of that which committed last."""
        return next((m for m in self.marks(query) if run_id in (None, m.run_id)), None)


def batch_folder(path: str, run_id: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/run_id={run_id}/batch_id={batch_id}"


def rename(spark: SparkSession, source, target) -> bool:
    """Give a file or folder its name if no other has it; False if one has."""
    context = spark.sparkContext
    fs = context._jvm.org.apache.hadoop.fs
    files = fs.FileContext.getFileContext(target.toUri(), context._jsc.hadoopConfiguration())
    options = context._gateway.new_array(fs.Options.Rename, 0)
    try:
        files.rename(files.makeQualified(source), files.makeQualified(target), options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception) or "DirectoryNotEmpty" in str(
                error.java_exception):
            return False
        raise
    return True


def committed(
    spark: SparkSession, path: str, schema: T.StructType, ledger: Ledger, query: str,
    run_id: str | None = None,
) -> DataFrame:
    """Rows of a run's committed micro-batches; half-written ones are invisible.

    Batches that were brought together are read as the run's manifest says, and only the folders
    of later ones are looked at. Without ``run_id`` it is the run that committed last.
    """
    key = [f.name for f in BATCH_KEY_FIELDS]
    fields = [f for f in schema.fields if f.name not in key]
    whole = T.StructType(fields + BATCH_KEY_FIELDS)
    mark = ledger.mark(query, run_id)
    empty = spark.createDataFrame([], whole)
    if mark is None:
        return empty
    generations = ledger.manifest(query, mark.run_id).generations
    parts = []
    if folders := [g.folder for g in generations if g.folder]:
        stored = T.StructType(fields + BATCH_KEY_FIELDS[1:])
        # Each folder is a table of its own; together they are one frame a generation.
        parts += [spark.read.schema(stored).parquet(f"{path.rstrip('/')}/{folder}")
                  .withColumn("run_id", F.lit(mark.run_id)) for folder in folders]
    first = max((g.last for g in generations), default=-1) + 1
    if batches := ledger.batches(path, mark.run_id, first, mark.batch_id):
        rows = spark.read.schema(whole).option("basePath", path).parquet(
            *(batch_folder(path, mark.run_id, n) for n in batches))
        parts.append(rows.filter((F.col("run_id") == mark.run_id) & (F.col("batch_id") <= mark.batch_id)))
    return reduce(DataFrame.unionByName, parts).select(*whole.names) if parts else empty

"""Merkle manifest of a corpus with a witness for every document (operator 13).

A leaf is the digest of a document's fields. Each group (language) has a tree of runs of
WIDTH nodes over its leaves in the order of their keys, and the groups' roots in turn
have one, whose root stands for the corpus.

Trees grow by streaming aligned append. A run that is not yet full is an open subtree; a
node that joins it takes the digests already there as its partial witness, and every
later sibling that is completed extends the witnesses of those before it. Witnesses hang on
subtrees, so a digest is noted once for all leaves below.

Spark ranks the leaves and deals them in aligned blocks of BLOCK, a power of WIDTH; a task
appends the leaves of one block. The blocks' roots are further appends: they are dealt in
blocks again, until each group has one node. On the way down each block is appended once
more together with the witness of its own root, and every leaf's witness is what its block
says followed by that. So no task, and nothing at the driver, ever holds more than a block.

Fields count as their text: NULL as a mark of its own, all else with its length in bytes.
NULL and empty texts therefore differ. A NULL group is a group of its own, the first; NULL
keys come first. Rows with the same key stand in the order of their digests, and rows that are equal in all
fields are leaves each. An empty table has no rows and no root. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden.llm.common import stash

WIDTH = 8
LEVELS = 3
BLOCK = WIDTH ** LEVELS

# Fixed value: the fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_BYTES = 32


def joined(digests: list[bytes]) -> bytes:
    """The digest of some digests, which count as hex text."""
    return sha256(b"".join(digests).hex().encode()).digest()


@dataclass(eq=False)
class Node:
    """A completed subtree, with the witness that its siblings make."""

    digest: bytes
    below: list[Node] = field(default_factory=list)
    left: list[bytes] = field(default_factory=list)
    right: list[bytes] = field(default_factory=list)

    def step(self) -> bytes:
        """The witness as bytes: how many siblings stand left and right, and their digests."""
        return bytes((len(self.left), len(self.right))) + b"".join(self.left) + b"".join(self.right)


class Append:
    """Open subtrees of a streaming aligned append, one run a level."""

    def __init__(self):
        self.open: list[list[Node]] = [[]]

    def add(self, digest: bytes) -> None:
        self._place(0, Node(digest))

    def _place(self, level: int, node: Node) -> None:
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        node.left = [other.digest for other in run]
        for other in run:
            other.right.append(node.digest)
        run.append(node)
        if len(run) == WIDTH:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        self._place(level + 1, Node(joined([node.digest for node in run]), run))

    def finish(self, levels: int) -> Node:
        """The subtree of that many levels that holds all that was added."""
        for level in range(levels):
            if self.open[level]:
                self._complete(level)
        return self.open[levels][0]


def levels_of(n: int) -> int:
    """Levels that a block takes in a tree of ``n`` nodes."""
    levels = 0
    while levels < LEVELS and WIDTH ** levels < n:
        levels += 1
    return levels


def appended(digests: list[bytes], n: int) -> Node:
    """The subtree of a block in a tree of ``n`` nodes."""
    tree = Append()
    for digest in digests:
        tree.add(digest)
    return tree.finish(levels_of(n))


def witnesses(node: Node, above: bytes = b"") -> list[bytes]:
    """Of each leaf below, in order, its witness up to ``node`` and then ``above``."""
    if not node.below:
        return [above]
    return [x for child in node.below for x in witnesses(child, child.step() + above)]


def folded(leaf: str, witness: bytes) -> tuple[str, str]:
    """The root that a leaf and its witness give, and the digest of the witness's digests."""
    at, siblings = 0, []
    while at < len(witness):
        middle = at + 2 + witness[at] * _BYTES
        stop = middle + witness[at + 1] * _BYTES
        left, right = witness[at + 2:middle].hex(), witness[middle:stop].hex()
        siblings.append(left + right)
        leaf = sha256((left + leaf + right).encode()).hexdigest()
        at = stop
    return leaf, sha256("".join(siblings).encode()).hexdigest()


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Digest of the fields in their order, as hex text."""
    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(told, fields.values())).cast("binary"), 256)


def tampered(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Column:
    """The text with A-Z lower-cased where 3 divides the checksum of the key; NULL keys count as empty."""
    chosen = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 3 == 0
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(chosen, lower).otherwise(F.col(text))


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with pos, the place in their group by ``order``, and n, the size of the group.

    Rows are dealt by ranges of (grp, order), which splits a hot group; only the sizes of the
    ranges meet by group, one row a range and group.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_first() for c in ("grp", *order)]
    sorted_ = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    sorted_ = stash(sorted_.withColumn("at", F.monotonically_increasing_id()), "ranked")
    sorted_ = sorted_.withColumn("part", F.shiftright("at", 33))
    sizes = sorted_.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    whole = Window.partitionBy("grp")
    sizes = sizes.select("grp", "part", "first",
                         (F.sum("held").over(whole.orderBy("part")) - F.col("held")).alias("before"),
                         F.sum("held").over(whole).alias("n"))
    placed = sorted_.join(sizes, ["grp", "part"])
    return placed.withColumn("pos", F.col("before") + F.col("at") - F.col("first")).drop(
        "at", "part", "first", "before")


def _block() -> Column:
    return F.floor(F.col("pos") / BLOCK).alias("block")


NODES = "grp string, pos long, n long, digest binary"


def climb(nodes: DataFrame) -> list[DataFrame]:
    """The nodes (grp, pos, n, digest) and, round by round, the roots of their blocks."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        n = table["n"][0].as_py()
        root = appended(table["digest"].to_pylist(), n)
        return pa.table({"grp": [table["grp"][0].as_py()], "pos": pa.array([key[1].as_py()], pa.int64()),
                         "n": pa.array([-(-n // BLOCK)], pa.int64()), "digest": [root.digest]})

    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        last = rounds[-1].select("grp", "pos", "n", "digest")
        rounds.append(stash(last.groupBy("grp", _block()).applyInArrow(run, NODES), "nodes"))
    return rounds


def _witnessed(names: tuple[str, ...]):
    """A block's nodes with their witnesses, from the block's own."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("pos")
        head = right.to_pylist()[0]
        block = appended(left["digest"].to_pylist(), left["n"][0].as_py())
        told = left.select(list(names))
        told = told.append_column("witness", pa.array(witnesses(block, head["witness"]), pa.binary()))
        for name in ("subroot", "root"):
            told = told.append_column(name, pa.array([head[name]] * left.num_rows, pa.string()))
        return told

    return run


def descend(rounds: list[DataFrame], top: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Witness, subroot and root of the nodes of the first round, with its columns ``keep``.

    ``top`` has them for the one node that each group has in the last round: grp, block (0),
    witness, subroot, root.
    """
    above = top
    for number in range(len(rounds) - 1, 0, -1):
        nodes = rounds[number - 1]
        names = ("grp", "pos", *(keep if number == 1 else ()))
        schema = T.StructType([*(nodes.schema[c] for c in names), T.StructField("witness", T.BinaryType()),
                               T.StructField("subroot", T.StringType()), T.StructField("root", T.StringType())])

        above = nodes.withColumn("block", _block()).groupBy("grp", "block").cogroup(
            above.groupBy("grp", "block")).applyInArrow(_witnessed(names), schema)
        if number > 1:
            above = stash(above.withColumnRenamed("pos", "block"), "witnesses")
    if len(rounds) == 1:
        nodes = rounds[0]
        above = nodes.select("grp", "pos", *keep).join(above.drop("block"), "grp")
    return above


@dataclass(frozen=True)
class Manifest:
    """Rounds of the groups' trees, the first with the leaves, and of the tree over their roots."""

    groups: list[DataFrame]
    top: list[DataFrame]
    columns: tuple[str, ...]

    def root(self) -> DataFrame:
        """One row with the root; none for an empty table."""
        return self.top[-1].select(F.lower(F.hex("digest")).alias("root"))

    def proofs(self) -> DataFrame:
        """For every document its columns, leaf, witness, subroot and root."""
        root = self.top[-1].select("grp", F.lit(0).cast("long").alias("block"),
                                   F.lit(b"").alias("witness"), F.lit("").alias("subroot"),
                                   F.lower(F.hex("digest")).alias("root"))
        over = descend(self.top, root, ("name", "digest"))
        over = over.select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("block"), "witness",
                           F.lower(F.hex("digest")).alias("subroot"), "root")
        found = descend(self.groups, stash(over, "subroots"), (*self.columns, "digest"))
        return found.select(*self.columns, F.lower(F.hex("digest")).alias("leaf"), "witness",
                            "subroot", "root")


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "lang",
          changed: dict[str, Column] | None = None) -> Manifest:
    """The manifest of all documents.

    With ``changed``, values to put in place of some fields, each document also carries the
    digest of its changed fields as other.
    """
    before = {c: F.col(c) for c in fields}
    other = leaf_digest(before | changed) if changed else F.lit(None).cast("string")
    # A group's name in a form that is never NULL and sorts alike.
    name = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    leaves = docs.select(F.col(key).alias("key"), name.alias("grp"),
                         F.unhex(leaf_digest(before)).alias("digest"), F.unhex(other).alias("other"),
                         F.monotonically_increasing_id().alias("row"))
    leaves = ranked(stash(leaves, "leaves"), "key", "digest", "row").drop("row")
    groups = climb(stash(leaves, "placed"))
    roots = groups[-1].select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    return Manifest(groups, climb(stash(ranked(roots, "name"), "roots")), ("key", "other"))


def verified(proofs: DataFrame) -> DataFrame:
    """``proofs`` with proof_sha256, and the root that the other leaf gives with the witness."""
    names = [c for c in proofs.columns if c not in ("witness", "other")]
    schema = T.StructType([*(proofs.schema[c] for c in names), T.StructField("proof_sha256", T.StringType()),
                           T.StructField("folded_root", T.StringType())])

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index
            found = [folded(other.hex(), witness) for other, witness in zip(
                batch.column(at("other")).to_pylist(), batch.column(at("witness")).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(at(c)) for c in names), pa.array([p for _, p in found], pa.string()),
                 pa.array([f for f, _ in found], pa.string())], names=schema.names)

    return proofs.mapInArrow(run, schema).withColumn("verified", F.col("folded_root") == F.col("root"))


def audit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's leaf, roots and witness digest, and whether it holds after tampering."""
    manifest = build(docs, key=key, changed={text: tampered(docs, key, text)})
    return verified(manifest.proofs()).select(
        F.col("key").alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")

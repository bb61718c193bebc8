"""Secret scans over an incremental ledger of blobs (operator 3, DataFrame functions only).

Every version of a text is addressed by its content. The ledger is a Parquet folder with
a row for each finding of a blob under a rule and its version, and one row without a
place for every pair of blob and rule version that was scanned. A scan looks only at pairs that
the ledger lacks, adds them as one batch, and joins the findings back to all paths.

Only texts that have copies are shuffled, folded in each task first, and, where a ledger is
there already, those that are held against it. Matches of a blob are numbered
and placed by the lengths of what lies between them, in code points, end exclusive.

NULL texts count as empty. Repeated rows give repeated rows. An empty table has no
findings. Texts are scanned whole. Columns besides key and text are ignored.
"""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from paywarden.llm.common import fresh, once, shared_folder, stash


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


# Kinds in the order of the spans, patterns and lengths. Runs of hex digits
# and keys are asked for at full length in the pattern, which finds the same matches.
RULES = (
    Rule("assign", 1,
         r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6),
    Rule("access", 1, r"(AKIA[A-Z0-9]{16,})", 1, 20),
    Rule("hex", 1, r"([0-9a-f]{24,})", 1, 24),
)

LEDGER = "blob string, kind string, version int, start long, end long, batch string"


def _blob(text: str):
    return F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """All committed batches; none where the folder is still missing."""
    try:
        return spark.read.schema(LEDGER).parquet(folder)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LEDGER)


def scan_unseen(docs: DataFrame, ledger: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """Ledger rows for pairs of blob and rule version that ``ledger`` lacks."""
    bodies = once(docs.select(F.coalesce(F.col(text), F.lit("")).alias("body")), "body")
    blobs = bodies.select(_blob("body").alias("blob"), "body")
    seen = ledger.groupBy("blob").agg(
        F.collect_set(F.concat_ws("@", "kind", F.col("version").cast("string"))).alias("seen"))
    blobs = blobs.join(seen, "blob", "left")
    scanned = F.array(*(
        F.when(F.coalesce(F.array_contains("seen", f"{r.kind}@{r.version}"), F.lit(False)), None)
        .otherwise(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
                            _lengths(r).alias("found")))
        for r in rules))
    pairs = blobs.select("blob", F.explode(F.filter(scanned, lambda x: x.isNotNull())).alias("x"))
    # After its matches, if any, each pair has an entry without a place.
    rows = pairs.select("blob", "x.kind", "x.version", F.posexplode("x.found").alias("i", "f"))
    # The place of a match is what all matches before it, and all gaps up to it, take.
    order = Window.partitionBy("blob", "kind").orderBy("i")
    rows = rows.select("blob", "kind", "version", "f.size", "f.good",
                       F.sum(F.col("f.gap") + F.col("f.size")).over(order).alias("stop"))
    none = F.col("size").isNull()
    good = rows.filter(none | F.col("good"))
    return good.select("blob", "kind", "version",
                       F.expr("stop - size").cast("long").alias("start"),
                       F.when(~none, F.col("stop")).cast("long").alias("end"))


def _lengths(rule: Rule):
    """An entry for each match: the gap before it, its size, and whether it is long enough; and an empty one."""
    body, pattern = F.col("body"), F.lit(rule.pattern)
    whole = F.regexp_extract_all(body, pattern, F.lit(0))
    inner = F.regexp_extract_all(body, pattern, F.lit(rule.group))
    gaps = F.split(body, rule.pattern, -1)
    entries = F.transform(
        F.arrays_zip(whole.alias("w"), inner.alias("g"), F.slice(gaps, 1, F.size(whole)).alias("p")),
        lambda x: F.struct(F.length(x["p"]).alias("gap"), F.length(x["w"]).alias("size"),
                           (F.length(x["g"]) >= rule.least).alias("good")))
    kind = "array<struct<gap:int,size:int,good:boolean>>"
    empty = F.array(F.struct(*(F.lit(None) for _ in range(3)))).cast(kind)
    return F.when(body.rlike(rule.pattern), F.concat(entries.cast(kind), empty)).otherwise(empty)


def commit(rows: DataFrame, folder: str, batch: str) -> None:
    """Add a batch to the ledger. The same batch again replaces itself."""
    rows.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch={batch}")


def update(docs: DataFrame, folder: str, batch: str, rules=RULES, text: str = "text") -> DataFrame:
    """Scan what the ledger in ``folder`` lacks, commit it as ``batch``, and return the ledger.

    A batch that is tried again does not count its own earlier rows as seen.
    """
    spark = docs.sparkSession
    known = read_ledger(spark, folder).filter(F.col("batch").cast("string") != batch)
    commit(scan_unseen(docs, known, rules, text), folder, batch)
    return read_ledger(spark, folder)


def by_blob(ledger: DataFrame, rules=RULES) -> DataFrame:
    """For each blob with findings under the given rule versions its spans, in order."""
    current = " OR ".join(f"(kind = '{r.kind}' AND version = {r.version})" for r in rules)
    number = F.expr("CASE kind " + " ".join(
        f"WHEN '{r.kind}' THEN {n}" for n, r in enumerate(rules)) + " END")
    return (ledger.filter(current).filter(F.col("start").isNotNull())
            .groupBy("blob").agg(F.array_sort(F.collect_set(F.struct(
                "start", number.alias("rank"), "kind", "end"))).alias("spans")))


def findings(docs: DataFrame, ledger: DataFrame, rules=RULES, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """For every path its blob and its spans: start, rank of the kind, kind, end."""
    paths = docs.select(F.col(key), _blob(text).alias("blob"))
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return paths.join(by_blob(ledger, rules), "blob", "left").select(
        key, "blob", F.coalesce("spans", empty).alias("spans"))


def digest(found: DataFrame, rules=RULES, key: str = "doc_id") -> DataFrame:
    """Counts of each kind, digest and text of the spans."""
    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = {f"n_{r.kind}": of(r.kind) for r in rules}
    text = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    return found.select(key, *(c.alias(n) for n, c in counts.items()),
                        F.sha2(text.cast("binary"), 256).alias("base_sha256"), text.alias("spans"))


def clean(docs: DataFrame, rules=RULES, text: str = "text", mask: str = "<secret>") -> DataFrame:
    """``docs`` with each secret masked, through a ledger of its own. No document is dropped."""
    blob, spans = fresh(docs, "_blob"), fresh(docs, "_spans")
    ledger = update(docs, shared_folder(docs.sparkSession, "ledger"), "0", rules, text)
    # A text without any match has no span: it stays where it is.
    matches = F.coalesce(functools.reduce(operator.or_, (F.col(text).rlike(r.pattern) for r in rules)), F.lit(False))
    found = stash(by_blob(ledger, rules).withColumnsRenamed({"blob": blob, "spans": spans}), "spans")
    joined = docs.filter(matches).withColumn(blob, _blob(text)).join(found, blob, "left")
    # Spans that overlap are masked as one; then the text is put together from what is between.
    merged = F.aggregate(
        spans, F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda out, s: F.when(
            (F.size(out) > 0) & (F.element_at(out, -1)["end"] > s["start"]),
            F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(
                F.element_at(out, -1)["start"].alias("start"),
                F.greatest(F.element_at(out, -1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(out, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))
    rows = joined.withColumn(spans, merged)
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]),
                    F.array(F.length(text).cast("long")))
    between = F.zip_with(begins, ends, lambda a, b: F.substring(
        F.col(text), (a + 1).cast("int"), (b - a).cast("int")))
    masked = F.when(F.col(spans).isNull(), F.col(text)).otherwise(F.concat_ws(mask, between))
    return docs.filter(~matches).unionByName(rows.withColumn(text, masked).select(*docs.columns))

"""Token counts as rollups that take signed changes (operator 10).

A change inserts, deletes or revises one document under one tokenizer version. It
becomes signed counts: an insert adds, a delete subtracts, a revision subtracts the old
and adds the new. Each batch of changes is summed by source, language and tokenizer
version and written to a folder of its own, which a second try of the same batch replaces
with equal content or, with ``replace=False``, leaves alone. Totals are sums over the
committed folders; documents are never read again.

Sums are formed in each task before the shuffle, so a source with a third of all rows
sends one row a task. NULL sources and languages are groups of their own. Groups whose
counts come to nothing vanish. NULL and empty texts have no tokens. An empty table or no
batch has no groups. Repeated rows count as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paywarden.llm import bpe

KEYS = ("source", "lang", "tokenizer")
BATCH = "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_rows long"

# Versions of the counting tokenizers, as patterns of one token. Vocabulary files are further versions.
TOKENIZERS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "pieces-1": r"\p{L}+|\p{N}+|[^\x20\x09-\x0D\p{L}\p{N}]+",
}


def n_tokens(text: str, tokenizer: str) -> Column:
    """Tokens of a text under one of the versions; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(TOKENIZERS[tokenizer])), F.lit(0)).cast("long")


def counted(docs: DataFrame, vocabulary: str | None = None, text: str = "text") -> DataFrame:
    """Tokens of each document under every version: source, lang, tokenizer, n.

    With the file of a vocabulary, its version is there too, named after the file, and counts what the
    codec of ``bpe`` gives.
    """
    versions = F.array(*(F.struct(F.lit(v).alias("tokenizer"), n_tokens(text, v).alias("n")) for v in TOKENIZERS))
    rows = docs.select("source", "lang", F.explode(versions).alias("v")).select("source", "lang", "v.*")
    if vocabulary is None:
        return rows
    ids = bpe.encode(docs.select("source", "lang", F.col(text).alias("text")), vocabulary)
    name = vocabulary.rsplit("/", 1)[-1].removesuffix(".json")
    return rows.unionByName(ids.select(
        "source", "lang", F.lit(name).alias("tokenizer"), F.size("ids").cast("long").alias("n")))


def signed(changes: DataFrame) -> DataFrame:
    """Signed counts of changes.

    Columns of ``changes``: source, lang, tokenizer, op (insert, delete, revise),
    n_tokens, and old_n_tokens for revisions. Other ops and NULL count as nothing.
    """
    sign = F.expr("CASE op WHEN 'insert' THEN 1 WHEN 'delete' THEN -1 WHEN 'revise' THEN 0 END")
    tokens = F.expr("""CASE op WHEN 'insert' THEN n_tokens WHEN 'delete' THEN -n_tokens
                       WHEN 'revise' THEN n_tokens - coalesce(old_n_tokens, 0) END""")
    return changes.select(*(F.col(k).cast("string").alias(k) for k in KEYS),
                          sign.cast("long").alias("n_docs"),
                          F.coalesce(tokens, F.lit(0)).cast("long").alias("n_tokens"),
                          F.when(sign.isNotNull(), 1).otherwise(0).cast("long").alias("n_rows"))


def _exists(spark: SparkSession, path: str) -> bool:
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there)


def commit(changes: DataFrame, folder: str, batch: str, replace: bool = True) -> None:
    """Add one batch of changes. Its folder appears whole or, without _SUCCESS, is not read."""
    spark = changes.sparkSession
    target = f"{folder.rstrip('/')}/{batch}"
    if not replace and _exists(spark, f"{target}/_SUCCESS"):
        return
    sums = signed(changes).groupBy(*KEYS).agg(
        *(F.sum(c).alias(c) for c in ("n_docs", "n_tokens", "n_rows")))
    sums.write.mode("overwrite").parquet(target)


def committed(spark: SparkSession, folder: str) -> list[str]:
    """Folders of the batches that were written to the end."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    found = [s.getPath().toString() for s in files.listStatus(root)]
    return sorted(p for p in found if _exists(spark, f"{p}/_SUCCESS"))


def totals(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and tokens of each group, over all committed batches."""
    paths = committed(spark, folder)
    rows = (spark.read.schema(BATCH).parquet(*paths) if paths
            else spark.createDataFrame([], BATCH))
    sums = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"),
                                   F.sum("n_tokens").alias("n_tokens"))
    return sums.filter("n_docs <> 0 OR n_tokens <> 0")

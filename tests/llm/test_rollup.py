import re
from collections import Counter

from corpus_rows import ODD

from paywarden.llm import rollup

CHANGES = "source string, lang string, tokenizer string, op string, n_tokens long, old_n_tokens long"


def totals(spark, folder):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"])
            for r in rollup.totals(spark, folder).collect()}


def test_changes_add_up(spark, tmp_path):
    folder = str(tmp_path / "rollup")
    assert totals(spark, folder) == {}

    def batch(name, rows, **how):
        rollup.commit(spark.createDataFrame(rows, CHANGES), folder, name, **how)

    batch("1", [("a", "en", "t1", "insert", 5, None), ("a", "en", "t1", "insert", 7, None),
                ("a", None, "t1", "insert", 0, None), (None, None, "t2", "insert", 3, None),
                ("a", "en", "t1", "other", 9, None), ("a", "en", "t1", None, 9, None)])
    assert totals(spark, folder) == {
        ("a", "en", "t1"): (2, 12), ("a", None, "t1"): (1, 0), (None, None, "t2"): (1, 3)}
    batch("2", [("a", "en", "t1", "revise", 10, 7), ("a", "en", "t1", "delete", 5, None),
                (None, None, "t2", "delete", 3, None), ("b", "en", "t1", "revise", 4, None)])
    after = {("a", "en", "t1"): (1, 10), ("a", None, "t1"): (1, 0), ("b", "en", "t1"): (0, 4)}
    assert totals(spark, folder) == after
    # The same batch again changes nothing; with replace=False not even a changed one does.
    batch("2", [("c", "en", "t1", "insert", 99, None)], replace=False)
    assert totals(spark, folder) == after
    batch("3", [])
    assert totals(spark, folder) == after


def test_batch_without_success_is_not_read(spark, tmp_path):
    folder = tmp_path / "rollup"
    changes = spark.createDataFrame([("a", "en", "t1", "insert", 5, None)], CHANGES)
    rollup.commit(changes, str(folder), "1")
    rollup.commit(changes, str(folder), "2")
    (folder / "2" / "_SUCCESS").unlink()
    assert totals(spark, str(folder)) == {("a", "en", "t1"): (1, 5)}
    rollup.commit(changes, str(folder), "2", replace=False)
    assert totals(spark, str(folder)) == {("a", "en", "t1"): (2, 10)}


def test_token_counts(documents):
    docs = documents(ODD)
    rows = docs.select("text", *(rollup.n_tokens("text", v).alias(v.replace("-", "_")) for v in rollup.TOKENIZERS))
    got = Counter((r["text"], r["words_1"]) for r in rows.collect())
    assert got == Counter((r[1], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in ODD)
    pieces = {r["text"]: r["pieces_1"] for r in rows.collect()}
    assert pieces["password: hunter2hunter2 <|endoftext|> | * $ #"] == 13


def test_a_vocabulary_counts_as_the_codec_does(spark, documents, tmp_path):
    """Totals are the sums of what op1 gives, by group; also with clashing columns and on an empty table."""
    import public_tokenizers
    from corpus_rows import ODD
    from paywarden.llm import bpe

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = documents(ODD).selectExpr("*", "1 AS n", "2 AS tokenizer", "3 AS ids", "4 AS v")
    load = rollup.counted(docs, path).withColumnsRenamed({"n": "n_tokens"}).selectExpr(
        "*", "'insert' AS op", "CAST(NULL AS long) AS old_n_tokens")
    rollup.commit(load, str(tmp_path / "r"), "load")
    rollup.commit(load.filter("false"), str(tmp_path / "r"), "empty")
    got = {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in rollup.totals(spark, str(tmp_path / "r")).filter(
        "tokenizer = 'byte_bpe_50k'").collect()}
    want = {}
    for r in bpe.encode(documents(ODD), path).collect():
        n, total = want.get((r.source, r.lang), (0, 0))
        want[r.source, r.lang] = n + 1, total + len(r.ids)
    assert got == want
    assert rollup.counted(docs.filter("false"), path).count() == 0
    assert rollup.totals(spark, str(tmp_path / "none")).count() == 0

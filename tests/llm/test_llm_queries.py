import pytest
from compare import connect, difference

import __spark_entry__
import corpus_pipeline
from paywarden.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_a_row_for_each_of_the_table(spark, name):
    if name not in ("op10_rollup", "op12_search"):
        table = "pages" if name == "op9_pages" else "documents"
        assert QUERIES[name](spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "secret_scan", "bpe"]

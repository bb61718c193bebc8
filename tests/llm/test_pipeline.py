import random

import corpus_pipeline
import public_tokenizers
from corpus_rows import ODD
from tokenizers import Tokenizer

from paywarden.llm.decontam import normalised
from test_secrets import _ASSIGN

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def prose(pick, n=150):
    return " ".join(pick.choice("the of and to in that it was for on are with as his they at be this".split())
                    + str(pick.randrange(40)) for _ in range(n))


def planted():
    """Clean texts, junk, copies, near copies, leaks and secrets; what is to stay of them."""
    pick = random.Random(8)
    item = prose(pick, 30)
    clean = [(i, prose(pick), "en", "s") for i in range(60)]
    rows = list(clean)
    rows.append((100, "spam " * 200, "en", "s"))
    rows.append((101, "too short", "en", "s"))
    rows += [(102 + i, clean[0][1], "en", "s") for i in range(5)]
    rows += [(110 + i, clean[1][1] + f" tail{i}", "en", "s") for i in range(5)]
    rows.append((120, prose(pick, 60) + " " + item + " " + prose(pick, 60), "en", "s"))
    rows.append((121, prose(pick) + ' password = "abcdef123456" ' + prose(pick), "en", "s"))
    return rows + ODD, [(1, item), (2, None)]


def through(spark, documents, tmp_path, rows, items):
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    return corpus_pipeline.run(spark, str(tmp_path))


def test_planted_cases(spark, documents, tmp_path):
    rows, items = planted()
    found = through(spark, documents, tmp_path, rows, items)
    assert found.columns == [*spark.read.parquet(str(tmp_path / "documents.parquet")).columns, "ids"]
    kept = {r["doc_id"]: r for r in found.collect()}
    assert set(range(2, 60)) <= set(kept)
    assert sum(k in kept for k in (0, *range(102, 107))) == 1
    assert sum(k in kept for k in (1, *range(110, 115))) == 1
    assert not {100, 101, 120} & set(kept) and 121 in kept
    for r in kept.values():
        assert r["ids"] == LIBRARY.encode(r["text"], add_special_tokens=False).ids
        assert r["n_chars"] == len(r["text"])
        assert not _ASSIGN.search(r["text"])
    assert "<secret>" in kept[121]["text"]
    wanted = [normalised(t) for _, t in items if t]
    for r in kept.values():
        words = normalised(r["text"])
        windows = {tuple(words[i:i + 10]) for i in range(len(words))}
        assert not any(tuple(w[i:i + 10]) in windows for w in wanted for i in range(len(w) - 9))


def test_empty_table(spark, documents, tmp_path):
    assert through(spark, documents, tmp_path, [], []).count() == 0


def test_stages_return_the_columns_of_documents(spark, documents, tmp_path):
    rows, items = planted()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents(rows[:65])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes

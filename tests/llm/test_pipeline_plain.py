"""All five stages against plain versions: every text is judged, compared, searched and encoded by itself."""

import re

import corpus_pipeline
import public_tokenizers
from corpus_rows import ODD
from test_decontam import words
from test_language_bands import corpus, plain_verdicts, sentences
from test_neardup import plain_classes
from test_secrets import _ASSIGN
from tokenizers import Tokenizer

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def masked(text):
    spans = [m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    out, done = "", 0
    for start, end in sorted(spans):
        if start >= done:
            out += text[done:start] + "<secret>"
        done = max(done, end)
    return out + text[done:]


def leaks(text, items, width=10):
    w = words(text)
    for _, item in items:
        i = words(item)
        size = min(width, len(i))
        wanted = {tuple(i[k:k + size]) for k in range(len(i) - size + 1)} if i else set()
        if any(tuple(w[k:k + size]) in wanted for k in range(len(w) - size + 1)):
            return True
    return False


def rows_and_items():
    pick, vocabulary, rows = corpus(40, seed=21, least=60, most=110)
    rows = [(key, text, lang, "s") for key, text, lang, _ in rows]
    item = sentences(pick, vocabulary["en"], 25)
    key = 90_000

    def plant(text, lang="en"):
        nonlocal key
        key += 1
        rows.append((key, text, lang, "s"))

    for n in range(4):
        plant(rows[0][1])
        plant(rows[1][1] + f" tail{n}.")
        plant(sentences(pick, vocabulary["fr"], 90))
    plant(rows[2][1] + " " + item)
    plant(sentences(pick, vocabulary["en"], 60) + ' password = "abcdef123456" AKIA' + "Z9" * 9)
    plant(sentences(pick, vocabulary["en"], 60) + " token:abcdef.g secret=ab:token=abcdef")
    plant("spam " * 200)
    plant(sentences(pick, vocabulary["de"], 80), None)
    odd = [(r[0] and r[0] + 500_000, *r[1:]) for r in ODD if len(r[1] or "") < 40_000]
    return rows + odd, [(1, item), (2, None), (3, "one")]


def test_stages_do_what_plain_versions_do(spark, documents, tmp_path):
    rows, items = rows_and_items()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    made = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"out{number}"))
        docs = spark.read.parquet(str(tmp_path / f"out{number}"))
        made[name] = [r.asDict() for r in docs.collect()]

    def told(stage):
        return sorted(repr((r["doc_id"], r["text"])) for r in made[stage])

    # Rules: what plain models and bands keep.
    verdicts = plain_verdicts([(r[0], r[1], r[2] if len(r) > 2 else None) for r in rows])
    kept = {v for v in verdicts if v.endswith("True)")}
    assert sorted(told("quality_rules")) == sorted(
        repr((r[0], r[1])) for r in rows if repr((r[0], True)) in kept)
    # Near-duplicates: of each class of what was kept one member, with its text.
    passed = [(r["doc_id"], r["text"]) for r in made["quality_rules"]]
    classes = {}
    for (key, first, _) in map(eval, plain_classes(passed)):
        classes.setdefault(first, set()).add(key)
    stayed = [r["doc_id"] for r in made["near_duplicates"]]
    assert len(stayed) == len(classes) and all(len(c & set(stayed)) == 1 for c in classes.values())
    assert set(told("near_duplicates")) <= set(told("quality_rules"))
    # Decontamination, secrets and encoding: each text by itself.
    clean = [(r["doc_id"], r["text"]) for r in made["near_duplicates"] if not leaks(r["text"], items)]
    assert 0 < len(clean) < len(stayed)
    assert told("decontamination") == sorted(map(repr, clean))
    assert told("secret_scan") == sorted(repr((k, masked(t))) for k, t in clean)
    assert any("<secret>" in r["text"] for r in made["secret_scan"])
    assert told("bpe") == told("secret_scan")
    for r in made["bpe"]:
        assert r["ids"] == LIBRARY.encode(r["text"], add_special_tokens=False).ids
        assert r["n_chars"] == len(r["text"])
    # The query gives the same documents, and nothing that the stages rested on is left.
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(repr((r["doc_id"], r["ids"])) for r in found) == sorted(
        repr((r["doc_id"], r["ids"])) for r in made["bpe"])
    assert corpus_pipeline._TABLES == []

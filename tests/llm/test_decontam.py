import hashlib
import re

import pytest
from corpus_rows import ODD

from paywarden.llm import decontam

_LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def plain(docs, items, width=10):
    found = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - width + 1)) if w else ():
            found.setdefault(tuple(w[k:k + width]), set()).add("" if item is None else str(item))
    out = []
    for key, text, *_ in docs:
        w, hit, of = words(text), set(), set()
        for size in {len(f) for f in found}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in found:
                    of |= found[tuple(w[k:k + size])]
                    hit |= set(range(k, k + size))
        digest = hashlib.sha256(",".join(sorted(of)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(of), digest, bool(hit)))
    return sorted(map(repr, out))


ITEM = "Alpha beta, gamma DELTA epsilon zeta eta theta iota kappa lambda mu"
ITEMS = [(1, ITEM), (2, "one"), (10, "x É y"), (9, "x É y"), (None, "two words"), (3, None), (4, " .,"),
         (5, "a a a a a a a a a a a"), (5, "long long"), (6, ITEM + " extra")]
DOCS = ODD + [
    (20, "pre " + ITEM.upper() + "!"), (21, ITEM[6:]), (22, ITEM[20:]), (23, "x-É\ty x É  y. ONE"),
    (24, "a " * 25), (25, "xé y x É yy one1"), (26, "É x É y" * 3), (27, ITEM + " " + ITEM),
]


@pytest.mark.parametrize("block_bytes", [decontam.BLOCK_BYTES, 150])
def test_hits_are_those_of_a_plain_search(documents, spark, block_bytes, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    scan = decontam.scan
    monkeypatch.setattr(decontam, "scan", lambda *a, **k: scan(*a, **k, block_bytes=block_bytes))
    found = decontam.contaminated(documents(DOCS), items).collect()
    assert sorted(repr(tuple(r)) for r in found) == plain(DOCS, ITEMS)


def test_spans_lead_back_to_the_text(documents, spark):
    items = spark.createDataFrame([(1, "É x y")], "item_id long, text string")
    docs = documents([(1, "日本 \U0001F600, É--x, Y! end. É X y")], extra=False)
    spans = decontam.scan(docs, items).first()["_hits"]["chars"]
    assert [docs.first()["text"][s["start"]:s["end"]] for s in spans] == ["É--x, Y", "É X y"]


def test_clean_keeps_all_else(documents, spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(DOCS)
    found = decontam.clean(docs, items)
    assert found.columns == docs.columns
    clean = [r for r in plain(DOCS, ITEMS) if r.endswith("False)")]
    assert found.count() == len(clean)


def test_empty_tables(documents, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents(DOCS)
    assert decontam.contaminated(docs, none).filter("contaminated").count() == 0
    assert decontam.contaminated(docs.filter("false"), none).count() == 0
    assert decontam.clean(docs, none).count() == len(DOCS)

import hashlib
import re

import pytest
from corpus_rows import ODD

from paywarden.llm import secrets

# The words of the first pattern in either case, ASCII only.
_ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    text = text or ""
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}")
              for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}")
              for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f[2] for f in sorted(found))


KEY = "AKIA" + "Z9" * 9
ROWS = ODD + [
    (20, f"a {KEY} b {KEY}\U0001F600{KEY}"), (21, "Token = 'abc' TOKEN='abcdef' token:abcdef.g"),
    (22, "api_key=token:abcdefg secret=ab:token=abcdef"), (23, "0123456789abcdef" * 2 + "x" + "f" * 24),
    (24, "password" + " " * 50 + "= \"s3cr3t/+=\" passwd:x"), (25, "AKIAAKIA" + "B" * 13 + " AKIA"),
    (26, "é" * 10 + "secret:abcdef0123456789abcdef0123456789"), (27, f"a {KEY} b {KEY}\U0001F600{KEY}"),
    (28, "token=abcdef " * 500), (29, "token: abc passwd=x"),
]


def scan(docs, folder, batch="0", rules=secrets.RULES):
    return secrets.digest(secrets.findings(docs, secrets.update(docs, folder, batch, rules), rules), rules)


def test_spans(documents, tmp_path):
    rows = scan(documents(ROWS), str(tmp_path / "ledger")).collect()
    assert len(rows) == len(ROWS)
    expected = sorted(repr((r[0], plain(r[1]))) for r in ROWS)
    assert sorted(repr((r["doc_id"], r["spans"])) for r in rows) == expected
    for r in rows:
        assert r["base_sha256"] == hashlib.sha256(r["spans"].encode()).hexdigest()
        kinds = [s.split(":")[0] for s in r["spans"].split(",") if s]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [
            kinds.count(k) for k in ("assign", "access", "hex")]


def test_only_unseen_pairs_are_scanned(documents, spark, tmp_path):
    folder = str(tmp_path / "ledger")
    docs = documents(ROWS)
    blobs = len({r[1] or "" for r in ROWS})
    ledger = secrets.update(docs, folder, "a")
    entries = ledger.count()
    assert ledger.select("blob", "kind").distinct().count() == 3 * blobs
    # Also for blobs that have but failing matches: one row without a place for every pair.
    assert ledger.filter("start IS NULL").count() == 3 * blobs
    assert secrets.scan_unseen(docs, ledger).count() == 0
    more = docs.union(documents([(50, f"new {KEY}")]))
    assert secrets.scan_unseen(more, ledger).select("blob").distinct().count() == 1
    newer = (secrets.Rule("access", 2, "(AKIA[A-Z]{16,})", 1, 20), *secrets.RULES[:1])
    rows = secrets.scan_unseen(docs, ledger, newer)
    assert {(r["kind"], r["version"]) for r in rows.select("kind", "version").collect()} == {("access", 2)}
    # A batch that is tried again replaces itself.
    again = secrets.update(docs, folder, "a")
    assert again.count() == entries
    assert scan(more, folder, "b").count() == len(ROWS) + 1


def test_masking_keeps_the_rest(documents):
    docs = documents(ROWS)
    found = secrets.clean(docs)
    assert found.columns == docs.columns
    rows = {r["doc_id"]: r["text"] for r in found.collect()}
    assert rows[20] == "a <secret> b <secret>\U0001F600<secret>"
    assert rows[26] == "é" * 10 + "<secret>"
    assert rows[28] == "<secret> " * 500
    assert rows[1] is None and rows[2] == "" and rows[7] == "x" * 50_000
    assert found.count() == len(ROWS)


def test_empty_table(documents, tmp_path):
    none = documents(ODD).filter("false")
    assert scan(none, str(tmp_path / "ledger")).count() == 0
    assert secrets.clean(none).count() == 0


def test_main_path_has_no_python(documents, tmp_path):
    docs = documents(ROWS)
    frame = scan(docs, str(tmp_path / "ledger"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("text", ["", "secret=", "AKIA", "abc"])
def test_no_match(text):
    assert plain(text) == ""

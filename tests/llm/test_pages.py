import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paywarden.llm import pages
from paywarden.llm.common import owned

ARTICLE = "<h1>Title &amp; more</h1><p>First   <b>bold</b> line.<p>Second &lt;line&gt;.</p>"
TEXT = "Title & more\nFirst bold line.\nSecond <line>."

LAYOUTS = {
    "article": f"<body><nav><a href=x>Menu</a></nav><article>{ARTICLE}</article><footer>(c)</footer>",
    "classes": f'<div class="site-header">H</div><div class="content with-sidebar">{ARTICLE}</div>'
               '<div id="sidebar"><p>Side text</p></div><div class="cookie-notice">Cookies</div>',
    "inside": f'<main>{ARTICLE}<div class="ad-slot">Buy</div><form><p>Mail</p></form>'
              '<aside>See also</aside><section class="comments"><p>A reader wrote this</p></section></main>',
    "scripts": f'<script>var t="</p><article>no";</script><style>p{{}}</style><article>{ARTICLE}'
               "<!-- <p>gone</p> --><noscript>no</noscript></article>",
    "roles": f'<div role="navigation">Menu</div><section>{ARTICLE}</section><div hidden>no</div>'
             '<div style="display: none">no</div><p role=contentinfo>no</p>',
    "unclosed": f"<article>{ARTICLE}<ul><li>one<li>two</ul></div></span>",
    "quotes": f"""<article title="a > b" data-x='1 > 0' lang=en>{ARTICLE}</article>""",
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    expected = TEXT + ("\none\ntwo" if name == "unclosed" else "")
    assert pages.main_text(LAYOUTS[name], {}) == expected


@pytest.mark.parametrize("source", [None, "", "<", "<p", "</", "<p title=\"x", "<div " * 3000, "&#x110000;&#0;",
                                    "<article>" * 2000 + "x", "a<b>b</b>c" * 20000])
def test_broken_pages_do_not_fail(source):
    pages.main_text(source, {})


def test_plain_text_and_sections():
    assert pages.main_text("just  text", {}) == "just text"
    assert pages.main_text("<article><section><p>one</section><section><p>two</section></article>", {}) == "one\ntwo"


def rows():
    made = [(i, f"https://A.example.com/{i}", f'<div class="story s{i}"><p>Story {i} ' + "long text " * 20
             + '</div><div class="box"><p>short box</div>') for i in range(6)]
    # Here the box is longer than the story; the host's other pages tell which one is the text.
    made.append((6, "http://a.example.com:80/x", '<div class="story s77"><p>Tiny</div><div class="box"><p>'
                 + "box " * 50 + "</div>"))
    made += [(7, None, "<article>x</article>"), (8, "not a url", None), (9, "https://b.org", ""),
             (None, "https://b.org", "<p>y"), (9, "https://b.org", "")]
    return made


@pytest.fixture
def table(spark):
    frame = spark.createDataFrame(rows(), "page_id long, url string, html string")
    return frame.selectExpr("*", "'x' AS text", "1 AS _host", "2 AS _votes").repartition(3)


def test_pages_of_a_host_agree(table):
    found = pages.extract(table).collect()
    assert found[0].__fields__ == ["page_id", "url", "text", "n_chars"]
    by = {r["page_id"]: r["text"] for r in found}
    assert by[6] == "Tiny"
    assert by[7] == "x" and by[8] == by[9] == "" and by[None] == "y"
    assert len(found) == len(rows())
    assert all(r["n_chars"] == len(r["text"]) for r in found)


def test_votes_and_winners(table):
    won = {r["host"]: r for r in pages.winners(pages.vote(table)).collect()}
    assert won["a.example.com"]["votes"] == 6
    assert "story" in won["a.example.com"]["path"]


def test_empty_table(table):
    assert pages.extract(table.filter("false")).count() == 0


def plain(rows):
    """Every page parsed twice: once to vote, once to be cut out; rows of (key, host, html)."""
    votes = defaultdict(Counter)
    for _, host, source in rows:
        chosen = pages.best(pages.parse(source), {})
        if chosen:
            votes[host][chosen[0]] += 1
    return sorted(repr((key, pages.main_text(source, votes[host]))) for key, host, source in rows)


def test_as_a_plain_vote_has_it(spark, table):
    frame = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    frame = frame.select("page_id", "url", "html").unionByName(table.select("page_id", "url", "html"))
    hosts = frame.select("page_id", pages._host("url").alias("host"), "html").collect()
    found = pages.extract(frame).select("page_id", "text").collect()
    assert sorted(repr(tuple(r)) for r in found) == plain([tuple(r) for r in hosts])


def test_html_and_paths_of_a_host_are_not_gathered(table):
    plan = pages.extract(table)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "source" not in plan
    votes = pages.vote(table.withColumn("url", F.lit("https://one.host/")))
    assert votes.count() == 1


def test_texts_are_not_stored_and_move_only_to_meet_other_choices(spark, table):
    pick = random.Random(3)
    long = [(100 + i, "https://a.example.com/l", '<div class="story"><p>'
             + "".join(pick.choices("abcdefghijklmnopqrstuvwxyz ", k=100_000)) + "</div>") for i in range(8)]
    frame = spark.createDataFrame(rows() + long, "page_id long, url string, html string").repartition(3)
    limit, folders = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    with owned(folders):
        found = pages.extract(frame)
    told = sorted(repr(tuple(r)) for r in found.collect())
    assert len(told) == len(rows()) + 8
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    stored = [p for f in folders for p in Path(f.removeprefix("file:")).rglob("*.parquet")]
    assert 0 < sum(p.stat().st_size for p in stored) < 80_000
    try:
        # Joined by a shuffle the rows are the same.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        moved = pages.extract(frame)
        assert sorted(repr(tuple(r)) for r in moved.collect()) == told
        assert "SortMergeJoin" in moved._jdf.queryExecution().executedPlan().toString()
        assert pages.overruled(pages.read(frame)).count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)

"""Pages whose markup misleads, templates of large hosts, and very large pages."""

import time

import pytest
from pyspark.sql import functions as F

from tickloom.llm import html_text

PROSE = "A long sentence of the article's own prose, long enough to count as such all by itself, as most sentences do. "
PAGES = {
    '<body><form id="aspnetForm"><div><h1>Title</h1><p>Text of a page in one form.</p></div><input><label>q</label></form></body>': "Title\nText of a page in one form.",
    f'<main><h1>Title</h1><p>{PROSE}</p><article class="card">teaser</article></main>': f"Title\n{PROSE.strip()}\nteaser",
    f'<div id="story">{PROSE}</div><article>Other story</article>': f"{PROSE.strip()}\nOther story",
    '<div class="post"><header><h1>Head</h1></header><p>text</p></div>': "Head\ntext",
    '<div class="widget">article</div><div>z</div>': "article\nz",
    '<article><p>text</p><ul class="commentlist"><li>c</li></ul><section id="comments-section">d</section><div class="comment-body">e</div></article>': "text",
    f'<header><h1>Site</h1></header><article><p>{PROSE}</p></article><div class="sidebar">links</div><form>Search</form>': PROSE.strip(),
    f'<article><header><h1>Own</h1></header><p>{PROSE}</p></article><footer><p>{PROSE}</p></footer>': f"Own\n{PROSE.strip()}",
    "<article>short</article><div>Menu</div><div>Log in</div>": "short",
}


@pytest.mark.parametrize("html", PAGES)
def test_the_article_is_kept(html):
    assert html_text.parse(html).text() == PAGES[html]


@pytest.mark.parametrize("n_pages,kept", [(60, False), (200, True)])
def test_templates_are_a_share_of_the_host(spark, n_pages, kept):
    """A sentence on five pages is a template of a host with sixty, but not of one with two hundred."""
    said = "<div>Said on five pages.</div>"
    rows = [(i, f"http://h/{i}", f"<div>Menu of the site</div><p>Own text {i}</p>{said if i < 5 else ''}") for i in range(n_pages)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == ("Own text 3\nSaid on five pages." if kept else "Own text 3") and got[20] == "Own text 20"


def test_no_html_is_shuffled(spark, monkeypatch):
    """Deletions too large to broadcast meet the texts, not the pages."""
    rows = [(i, f"http://h/{i % 3}", f"<div>Menu</div><p>Text {i}</p><script>{'x' * 500}</script>") for i in range(60)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "html" not in text
        assert {r.text for r in found.collect()} == {f"Text {i}" for i in range(60)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("make", [lambda n: "<article><p>x</p></article>" * n, lambda n: "<b>" * n + "<p>y" * n, lambda n: "<div>" * n + "deep"])
def test_large_pages_take_linear_time(make):
    html_text.parse(make(500)).text()
    spent = []
    for n in (4000, 20_000):
        t = time.process_time()
        html_text.parse(make(n)).text()
        spent.append(time.process_time() - t)
    assert spent[1] < 15 * max(spent[0], 0.05)


def test_extra_columns_and_text_ids(spark):
    df = spark.createDataFrame([("a", "http://h/1", "<p>t", 1), ("a", "http://h/1", "<p>t", 1)], "page_id string, url string, html string, KEY int")
    rows = html_text.extract(df.withColumn("kept", F.lit("x"))).collect()
    assert [(r.page_id, r.text) for r in rows] == [("a", "t")] * 2

"""Main text of pages: golden pages, host consensus, and the given table."""

import html
import re

import pytest
from llm_tables import SF
from pyspark.sql import functions as F

from strata.llm import html_extract as hx
from strata.llm.queries import op13_html_extraction

PARA = "A sentence of some words that goes on for a while, as running text does."


def own_text(page):
    read = hx.Page(page)
    return read.text(hx.choose(read.scores(), {}))


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("just text &amp; more &lt;x&gt; &eacute;&#8364;&#x41;", "just text & more <x> é€A"),
        (f"<article><p>{PARA}</article>", PARA),
        ("<article><p>One <b>tw</b>o<br>three&nbsp; four\n\t five<p>six</article>", "One two three four five six"),
        (f"<article><h1>T</h1><p>{PARA}<script>var a='</p>';</script><style>p{{}}</style></article>", f"T {PARA}"),
        (f"<nav>menu</nav><header>site</header><article><p>{PARA}</p><aside>side</aside></article><footer>f", PARA),
        (f"<article><header><h1>T</h1><p>by me</p></header><p>{PARA}</p><footer>tags</footer></article>", f"T {PARA}"),
        (f"<div class='entry'><div class='entry-header'><h2>T</h2><i>x</i></div><p>{PARA}</div>", f"T {PARA}"),
        (f"<div class='cookie-notice'>We use cookies</div><div class='post'><p>{PARA}</div>", PARA),
        (f"<div class=post><p>{PARA}<form>mail<input></form></div><div class=sidebar><p>{PARA}</div>", PARA),
        (f"<article><p>{PARA}</article><section id=comments><article class=comment><p>{PARA * 9}</article>", PARA),
        (f"<div class='layout has-sidebar'><p>{PARA}</div>", PARA),
        (f"<div class='ad'>buy<article><p>{PARA}</article>", PARA),
        (f"<article><p>{PARA}<ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", f"{PARA} a b c d"),
        (f"<article><p>{PARA}<p hidden>no<p style='display: none'>no</article>", PARA),
        (f"<head><title>T<body><article><p>{PARA}", ""),
        (f"<head><title>T</title><meta><article><p>{PARA}", PARA),
        (f"<article><!-- <p>no</p> --><p>{PARA}<!-- no", PARA),
        (f"<article title='a > b'><p>{PARA}<a href='x", PARA),
        (f"<article class='post tag-ads category-social'><p>{PARA}</article>", PARA),
        ("<p>5 < 6 and 7 > 3</p>", "5 < 6 and 7 > 3"),
    ],
)
def test_golden_pages(page, text):
    assert own_text(page) == text


def test_deep_nesting_and_long_pages_stay_linear():
    assert own_text("<div>" * 20_000 + "deep") == "deep"
    assert own_text("<b>" * 20_000 + "<p>x" * 20_000) == " ".join("x" * 20_000)
    assert len(own_text(f"<article>{'<p>' + PARA} " + f"<p>{PARA} " * 20_000)) > 1_400_000
    assert own_text('<a "' * 20_000 + "tail") == ""


def test_paths_are_generalised():
    first, second = (
        hx.Page(f"<div class='post-{i} col{i}'><p>{PARA}</div>").scores() for i in (1, 22)
    )
    assert first == second and "body/div.#.post-#" in first


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_host_consensus_overrules_a_page_of_long_talk(spark):
    usual = f"<div class=x1a><p>{PARA * 4}</div><div class=zzq><p>Short talk.</div>"
    odd = f"<div class=x1a><p>{PARA}</div><div class=zzq><p>{PARA * 6}</div>"
    rows = [(i, f"http://one.example/{i}", usual) for i in range(20)]
    rows += [(100, "http://ONE.example:80/odd", odd), (101, "http://other.example/odd", odd)]
    got = {r.page_id: r.text for r in hx.extract_pages(pages(spark, rows)).collect()}
    assert got[0] == (PARA * 4)
    assert got[100] == PARA
    assert got[101] != PARA


def test_two_layouts_on_one_host(spark):
    rows = [(i, "http://h.example/a", f"<div class=alpha><p>{PARA}</div><p>x") for i in range(30)]
    rows += [(50 + i, "http://h.example/b", f"<td class=beta><p>{PARA} b</td><p>x") for i in range(3)]
    got = {r.page_id: r.text for r in hx.extract_pages(pages(spark, rows)).collect()}
    assert got[3] == PARA and got[51] == f"{PARA} b"


def test_hosts(spark):
    urls = {
        "http://User:pw@A.Example.com:80/x?y#z": "a.example.com",
        "//b.example/x": "b.example",
        "https://c.example": "c.example",
        "no host": None,
        "": None,
        None: None,
    }
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.url: r.host for r in frame.withColumn("host", hx.host("url")).collect()}
    assert got == urls


def test_awkward_rows(spark):
    rows = [
        (1, None, f"<article><p>{PARA}</article>"),
        (1, "nonsense", f"<article><p>{PARA}</article>"),
        (None, "http://h.example/", None),
        (None, "http://h.example/", ""),
        (2, "http://h.example/", "<nav>only a menu</nav>"),
        (3, "http://h.example/", f"<article><p>{'<i>' * 999}{PARA}</article>"),
        (3, "http://h.example/", f"<article><p>{'<i>' * 999}{PARA}</article>"),
    ]
    frame = pages(spark, rows)
    for name in ("host", "path", "votes", "rating", "winners", "text", "rank"):
        frame = frame.withColumn(name, F.lit(1))
    got = hx.extract_pages(frame).collect()
    assert sorted((str(r.page_id), r.text) for r in got) == sorted(
        [("1", PARA), ("1", PARA), ("None", ""), ("None", ""), ("2", ""), ("3", PARA), ("3", PARA)]
    )
    assert hx.extract_pages(pages(spark, [])).count() == 0


def test_a_host_elects_few_paths_and_the_rest_goes_by_own_scores(spark):
    rows = [(i, "http://h.example/", f"<div class=k{'abcdefghij'[i]}z><p>{PARA} {i}</div>") for i in range(10)]
    votes = hx.container_votes(pages(spark, rows))
    assert votes.count() == 11  # ten paths and the whole page
    assert len(hx.host_winners(votes, 3).first().winners) == 3
    got = {r.page_id: r.text for r in hx.extract_pages(pages(spark, rows)).collect()}
    assert got == {i: f"{PARA} {i}" for i in range(10)}


def test_query_gives_the_articles_of_the_given_table(spark):
    """In the given pages the article is marked up as such: all its text, by plain patterns."""
    given = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {row.page_id: row for row in op13_html_extraction(spark, SF).collect()}
    assert len(got) == len(given)
    for page in given:
        article = re.search("<article>(.*)</article>", page.html, re.DOTALL)[1]
        text = " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split())
        assert (got[page.page_id].text, got[page.page_id].n_chars) == (text, len(text))

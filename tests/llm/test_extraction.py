import html
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tickloom.llm.extraction import extracted, main_text

WORDS = "The river rose again last night and the old bridge was closed to carts and people alike. " * 3


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple\n text", "plain & simple text"),
        ("<p>a<p>b", "a b"),
        ("<p>one <b>bo</b>ld<br>line", "one bold line"),
        ("<div>x < y &lt;z&gt;&nbsp;q &#233;&#x41; &amp</div>", "x < y <z> q éA &"),
        ("<!-- never closed <p>x", ""),
        ("<p>cut off<a href='x", "cut off"),
        ('<p title="a > b">text</p>', "text"),
        ("<script>if (a < b) { '<p>no</p>' }</script><p>yes</p><style>p{}</style>", "yes"),
        ("<script>never closed <p>no", ""),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a b c d"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"),
        ("<nav><a href=/>menu</a></nav>", ""),
        ("</div></p>text</article>", "text"),
        ("<p>foo<img src=x>bar <b>ba</b><script>x()</script>z<br>end", "foobar baz end"),
        ("<p>be<svg><path d=x /></svg>fore<button>no</button><hr>after", "before after"),
    ],
)
def test_small_pages(page, expected):
    assert main_text(page) == expected


def test_parts_around_the_article_go():
    page = f"""<html><head><title>T</title></head><body class="no-sidebar"><header><h1>Site</h1></header>
    <div class="cookie-notice">We use cookies. {WORDS}</div><div id="sideBar"><p>{WORDS}</p></div>
    <article><header><h1>Flood</h1></header><p>{WORDS}</p><aside>{WORDS}</aside><p>Short.</p>
    <form><label>Mail</label><input name=m></form><div class="ad">Buy!</div><h2>After</h2><p>{WORDS}</p>
    <section class="comments"><p>{WORDS}</p></section><footer>by me</footer></article>
    <div hidden>{WORDS}</div><div style="display: none">{WORDS}</div><footer>end</footer></body></html>"""
    kept = " ".join(WORDS.split())
    assert main_text(page) == f"Flood {kept} Short. After {kept}"


def test_an_article_without_a_name_is_found_by_density():
    links = "".join(f'<li><a href="/{i}">link number {i}</a></li>' for i in range(30))
    page = f"""<body><div><ul>{links}</ul></div><div><div><h2>One</h2><p>{WORDS}</p><p>{WORDS}</p></div>
    <div><h2>Two</h2><p>{WORDS}</p><p>{WORDS}</p></div></div><div><a href=/>imprint</a></div></body>"""
    kept = " ".join(WORDS.split())
    assert main_text(page) == f"One {kept} {kept} Two {kept} {kept}"


def test_a_wrong_name_does_not_decide():
    page = f"""<body><main><p>Read on below.</p></main><article><a href="/x">{WORDS}</a></article>
    <div><h1>Head</h1><p>{WORDS}<b>{WORDS}</b></p><p>Short.</p><p>{WORDS}</p></div></body>"""
    kept = " ".join(WORDS.split())
    found = main_text(page)
    assert f"Head {kept} {kept} Short. {kept}" in found and found.count(kept) == 3


def test_a_sidebar_of_prose_beside_a_named_article():
    page = f"<body><article><h1>Head</h1><p>{WORDS}</p><p>{WORDS}</p></article><div><p>{WORDS}</p></div></body>"
    kept = " ".join(WORDS.split())
    assert main_text(page) == f"Head {kept} {kept}"


def test_a_deep_page_and_one_with_many_tags():
    assert main_text("<div>" * 20_000 + "x") == "x"
    assert main_text("<p>a b</p>" * 50_000) == " ".join(["a b"] * 50_000)
    assert main_text("<" * 20_000 + " x") == "<" * 20_000 + " x"


def test_query(spark, sf_dir):
    from __spark_entry__ import queries

    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = queries()["op4_text_density"](spark, sf_dir).collect()
    assert len(found) == len(pages)
    for r in found:
        source = pages[r.page_id].html
        article = source[source.index("<article>") + 9 :].split("</article>")[0]
        plain = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", article))
        assert r.text == " ".join(html.unescape(plain).split())
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize("name", ["div", "section", "center"])
def test_names_of_articles_do_not_matter(sf_dir, name):
    """The same text comes from pages whose article is any other element."""
    for row in pq.read_table(f"{sf_dir.replace('0.001', '0.01')}/pages.parquet", columns=["html"]).to_pylist():
        page = row["html"]
        other = re.sub(r"<(/?)(?:article|main)(?=[\s>])", rf"<\1{name}", page)
        assert other != page and main_text(other) == main_text(page) != ""


def test_odd_rows(odd_docs, odd_rows, no_docs):
    found = odd_docs.select("text", extracted(F.col("text")).alias("t")).collect()
    assert len(found) == len(odd_rows)
    assert all(r.t == " ".join((r.text or "").split()) for r in found)
    assert no_docs.select(extracted(F.col("text"))).count() == 0

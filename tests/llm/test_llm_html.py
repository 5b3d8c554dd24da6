"""Articles that keep their text, odd markup, and templates deleted by count."""

import re
import time
from collections import Counter

import pytest

from namepulse.llm import html_text


@pytest.mark.parametrize(
    "inner",
    [
        "<div class='post widget-text'><p>body</p></div>",
        "<p class='related-work'>body</p>",
        "<table class='search-results'><tr><td>body</td></tr></table>",
        "<h2 id='social-history'>body</h2>",
        "<section id='related-work'>body</section>",
        "<math><mi>body</mi></math>",
        "<object data=x>body</object>",
        "<noscript>body</noscript>",
        "<p title=Bob's>body</p><p class='x'></p>",
        "<p title='a>b' data-x=\"'\">body</p>",
        "<blockquote class=comment>body</blockquote>",
    ],
)
def test_an_article_keeps_its_text(inner):
    assert html_text.extract(f"<nav>menu</nav><article>{inner}</article><footer>end</footer>") == "body"


@pytest.mark.parametrize(
    "inner",
    ["<div class=ad>x</div>", "<div class='ad-slot top'>x</div>", "<section class='related-posts'>x</section>", "<aside>x</aside>",
     "<div id=comments>x</div>", "<div class='comment-list'><p>x</p></div>", "<script>x</script>", "<form>x</form>", "<svg><text>x</text></svg>",
     "<div hidden>x</div>", "<div role=dialog>x</div>", "<!-- x -->", "<style>x</style>"],
)
def test_what_is_no_article_text_goes(inner):
    assert html_text.extract(f"<article><p>a</p>{inner}<p>b</p></article>") == "a\n\nb"


def test_unmarked_pages_keep_their_only_text():
    assert html_text.extract("<body><div class='entry-form'><p>body</p></div></body>") == "body"
    assert html_text.extract("<body><div class='sidebar'>x</div><p>body</p></body>") == "body"
    assert html_text.extract("<noscript>turn it on</noscript><p>body</p>") == "body"
    assert html_text.extract("<nav>menu</nav>") == ""


@pytest.mark.parametrize(
    "html, text",
    [
        ("a <!-- b", "a"),
        ("<p>a</p> tail <!-- b", "a\n\ntail"),
        ("<p>a</p><![CDATA[ b", "a"),
        ("a < b and c > d", "a < b and c > d"),
        ("<p>a <b", "a <b"),
        ("<a x=\"1>2\">y</a>", "y"),
        ("<a =\"=\"=\">y</a>z", "yz"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\n\nb\n\nc\n\nd"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
        ("<p>a<div>b</p>c</div>", "a\n\nbc"),  # there is no open paragraph to end
    ],
)
def test_odd_markup(html, text):
    assert html_text.extract(html) == text


@pytest.mark.parametrize(
    "html",
    [
        "<div>" * 50_000 + "</span>" * 50_000,
        "<p><b>" * 50_000,
        "<b>" * 50_000 + "<p>x" * 50_000,
        "<a " * 100_000,
        "<a x=\"" * 100_000,
        "<a ='" * 50_000 + ">",
        "<li><b>" * 50_000,
        "<td><i>" * 30_000 + "</td>" * 60_000,
        "<!--" * 100_000,
        "<p class='" * 50_000,
        "<script>" * 50_000,
    ],
)
def test_time_is_in_proportion(html):
    began = time.time()
    page, found = html_text.subtrees(html)
    html_text.extract(html, {1})
    assert time.time() - began < 20


def site(n):
    """Pages of a host with its own blocks, whose names tell nothing, in and around the article."""
    for i in range(n):
        yield (
            i,
            f"http://site.example/{i}",
            f"<html><body><div class=x1><span>Home</span> <span>About us</span></div><article><h1>Title {i}</h1>"
            f"<p>Story {i} begins.</p><div class=x2>Follow us for more</div><p>Story {i} ends.</p>"
            f"{'<div class=x3>Read on next week</div>' if i % 3 == 0 else ''}<p>The same last words.</p></article>"
            f"<div class=x4>Printed here</div></body></html>",
        )


def test_templates_are_deleted_by_count(spark):
    rows = list(site(30)) + [(100 + i, f"http://other.example/{i}", f"<article><div class=x2>Follow us for more</div><p>o{i}</p></article>") for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    counts = Counter(d for _, url, html in rows if "site" in url for d in set(re.findall(r"<div class=x\d>.*?</div>", html)))
    often = {d for d, n in counts.items() if n >= 5 and n >= 0.3 * 30}
    assert len(often) == 4
    (found,) = html_text.templates(pages).collect()
    hashes = set()
    for d in often:
        root = html_text.parsed(f"<article>{d}</article>" if "x2" in d or "x3" in d else d)
        html_text.hashed(root, hashes)
    assert found["host"] == "site.example" and hashes & set(found["templates"])
    for r in html_text.with_text(pages).collect():
        i = r["page_id"]
        if i < 100:
            assert r["main_text"] == f"Title {i}\n\nStory {i} begins.\n\nStory {i} ends.\n\nThe same last words."
        else:
            assert r["main_text"] == f"Follow us for more\n\no{i - 100}"

import html as stdlib
import re
import time

import duckdb
import pytest

from garimpo.llm import html_text as X

PROSE = "The cat is on the mat and it is a big fat cat of the house that was here."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("<p>hi", "hi"), ("<b>x<i>y</b>z</i>", "xyz"), ("<!-- a", ""),
        ("<script>a</p>", ""), ('<p title="x>y">t</p>', "t"), ("<p>R&eacute;sum&#233; &amp; &#x41;&nbsp;b\n\tc</p>", "Résumé & A b c"),
        ("<article><p>Les.</p><aside>no</aside><p>Oui.</p></article>", "Les.\nOui."),
        (f"<article><p>Yes.</p><div class='comments'><p>{PROSE}</p></div></article>", "Yes."),
        (f"<header><h1>Site</h1></header><main><header><h1>T</h1></header><p>{PROSE}</p></main>", PROSE),
        (f"<article><header><h1>T</h1></header><p>{PROSE}</p></article>", f"T\n{PROSE}"),
        (f"<p><a href=x>all of it is a link</a></p><p>{PROSE}</p>", PROSE),
        (f"<div id=cookie-notice>{PROSE}</div><form>{PROSE}</form><p>{PROSE} One.</p>", f"{PROSE} One."),
        ("<table><tr><td>a<td>b</table>", "a\nb"), ("a<br>b<hr>c", "a b\nc"), ("<div hidden>x</div><p>y", "y"),
        ("<style>p{}</style><p>1 &lt; 2</p><svg><text>no</text></svg>", "1 < 2"),
    ],
)
def test_rules(page, text):
    assert X.main_text(page) == text


def test_short_blocks_take_the_nearest_label():
    page = f"<nav>menu</nav><p>near nav</p><p>also</p><p>near text</p><p>{PROSE}</p><p>tail</p>"
    assert X.main_text(page).split("\n") == ["also", "near text", PROSE, "tail"]


def test_given_pages_equal_a_plain_reading(spark):
    """On pages of this layout, the article's paragraphs and heading are all there is."""
    folder = "/root/testdata/sf0.001"
    found = X.extracted(spark.read.parquet(f"{folder}/pages.parquet")).collect()
    assert len(found) == duckdb.sql(f"SELECT count(*) FROM '{folder}/pages.parquet'").fetchall()[0][0]
    for row in found:
        article = row["html"].split("<article>")[1].split("</article>")[0]
        parts = (re.sub("<[^>]*>", "", p) for p in re.split("</?(?:p|h1)>|<br>", article))
        parts = (" ".join(stdlib.unescape(p).split()) for p in parts)
        assert row["text"] == "\n".join(p for p in parts if p)


def test_reading_is_linear():
    pages = ["<b>" * 100_000, "<" * 100_000, '<a "' * 50_000, "<p><!--" * 50_000, "<p>x</p>" * 50_000, '<div class="' + "a=" * 100_000]
    started = time.time()
    for page in pages:
        X.main_text(page)
    assert time.time() - started < 10


def test_other_columns_and_empty_table(spark):
    df = spark.createDataFrame([("<p>a", 1, "old")], "html string, page_id long, text string")
    assert X.extracted(df).collect()[0].asDict() == {"html": "<p>a", "page_id": 1, "text": "a"}
    assert X.extracted(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "wrapper",
    [
        'div id=page class="content has-sidebar"', "div class=no-sidebar", "div class=with-nav", "div class=ad-free-content",
        'div class="post social-science"', "section class=discussion", "section class=related-work",
    ],
)
def test_hinted_wrappers_keep_the_text(wrapper):
    name = wrapper.split()[0]
    inner = f"<h1>T</h1><p>{PROSE}</p><p>Two <span class=social-science>of</span> <b>it</b>.</p>"
    text = f"T\n{PROSE}\nTwo of it."
    menu = "<div class=nav><a href=x>one</a></div><div class=sidebar><p>Some other things.</p></div>"
    assert X.main_text(f"{menu}<{wrapper}>{inner}</{name}>") == text
    assert X.main_text(f"<{wrapper}><article>{inner}</article></{name}>{menu}") == text


def test_hinted_parts_are_still_cut():
    page = f"<p>{PROSE} One.</p><div class=comment-body>{PROSE}</div><div class=related-links><p>A few.</p></div><p>{PROSE} Two.</p>"
    assert X.main_text(page) == f"{PROSE} One.\n{PROSE} Two."
    assert X.main_text(f"<p>{PROSE}</p><div class=related-work>{PROSE}</div>") == f"{PROSE}\n{PROSE}"
    long = f"{PROSE} It is <em class=has-tooltip>that {PROSE}</em>, and so on."
    assert X.main_text(f"<p>Now <i class=notice>{PROSE}</i> ends.</p>") == f"Now {PROSE} ends."
    assert X.main_text(f"<p>{long}</p>") == re.sub("<[^>]*>", "", long)

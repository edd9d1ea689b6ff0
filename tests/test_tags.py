"""Tags, links and character references as a browser reads them."""

import html
import random
import time
from html.entities import html5
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from garimpo.functions import entities, tags, urls
from garimpo.operators import discover


@pytest.fixture
def pages(spark):
    return lambda body, url="https://www.olx.com.br/a/b?q=1": spark.createDataFrame([(1, url, body)], "page_id long, url string, html string")


def found(pages, body):
    return [r.href for r in discover.hrefs(pages(body)).orderBy("pos").collect()]


@pytest.mark.parametrize(
    "body, want",
    [
        ('<a title="a>b" href="/1">x</a>', ["/1"]),
        ('<a title="href=/no" href=/1>x</a><a title=\'<a href="/no">\' href="/2">', ["/1", "/2"]),
        ('<a title="open href=/1>x</a><a href="/2">y</a>', []),  # the value goes on to the next quote
        ("<a href=/it's>x</a><a class='y' href='/2'>z</a>", ["/it's", "/2"]),
        ('<a href="">x</a><a>y</a><a name=z><abbr href="/no">', []),
        ("<A\nHREF = '/1'\n>x</A><a\thref=/2/>y", ["/1", "/2/"]),
        ('<a data-href="/no" xhref=/no href="/1" href="/2">', ["/1"]),
        ('<a href="/x?a=1&copy=2&amp;b=3&lt">', ["/x?a=1&copy=2&b=3<"]),
        ("<!-- <a href=/no> --><script>'<a href=/no>'</script><a href=/1", ["/1"]),
    ],
)
def test_hrefs(pages, body, want):
    assert found(pages, body) == want


def test_long_and_hostile_tags_are_read_in_linear_time(pages):
    started = time.time()
    for body in ("<a " * 50_000, '<a x="' * 50_000, "<a =" * 50_000, "<a " + "x='y' " * 100_000 + ">", "<a " + "=" * 200_000, "<a href=" + "y" * 300_000, "<a " + "y" * 300_000):
        found(pages, body)
        discover.ad_links(pages(body)).collect()
    assert time.time() - started < 60


def test_resolution_equals_the_standard_library(spark):
    bases = ["https://a.com/b/c/d;p?q", "https://a.com", "https://a.com/", "http://a.com/x/y/", "https://a.com/b/../c/./d?x=/../y"]
    refs = [
        "g", "./g", "g/", "/g", "?y", "g?y", "#s", "g#s", "g?y#s", "..", "../", "../g", "../..", "../../", "../../g", "../../../g", "../../../../g",
        "/./g", "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", "g;x=1/./y", "g?y/./x", "g?y/../x", "g#s/../x", ".", "./",
        "//b.com/y?z", "vi/1/2",
    ]
    rows = spark.createDataFrame([(b, r) for b in bases for r in refs], "base string, ref string")
    got = rows.select("base", "ref", urls.resolve(F.col("ref"), F.col("base")).alias("link")).collect()
    assert [r for r in got if r.link != urljoin(r.base, r.ref)] == []


def test_resolution_where_the_standard_library_differs(value):
    """Dot segments go after a host too, and empty segments stay."""
    assert value(lambda c: urls.resolve(c, F.lit("https://a.com/b")), "//x.com/y/../z?w#v") == "https://x.com/z?w#v"
    assert value(lambda c: urls.resolve(c, F.lit("https://a.com/b")), "vi//./2") == "https://a.com/vi//2"


def test_base_address(pages):
    body = '<head><base target=x><base href=" ../c/ "></head><a href="../1"><a href="2"><a href="//x.com/3"><a href="/4">'
    rows = discover.hrefs(pages('<base href="../c/"><a href="../1"><a href="2"><a href="//x.com/3"><a href="/4">')).orderBy("pos")
    got = [r.link for r in rows.select(urls.resolve(F.col("href"), F.col("base")).alias("link")).collect()]
    assert got == ["https://www.olx.com.br/1", "https://www.olx.com.br/c/2", "https://x.com/3", "https://www.olx.com.br/4"]
    assert discover.hrefs(pages(body)).first().base == "https://www.olx.com.br/a/b?q=1"  # only the first counts, and it has no address
    assert discover.hrefs(pages("<a href=x>")).first().base == "https://www.olx.com.br/a/b?q=1"


@pytest.mark.parametrize(
    "body, want",
    [
        ('window.__INITIAL_STATE__ = {"t":"a };b","u":"https://www.olx.com.br/1"};', ["1"]),
        ('window.__INITIAL_STATE__ = {"u":"https://www.olx.com.br/1"}</script>', ["1"]),
        ('window.__SSR_STATE__={"u":"https://www.olx.com.br/1"};window.__PRELOADED_STATE__ = {"v":[{"w":"https://www.olx.com.br/2?x"}]}\n', ["1", "2"]),
        ('window.__SSR_STATE__={"u":"https://www.olx.com.br/1"', []),
        ('window.__SSR_STATE__={"u":"\\"{[ https://www.olx.com.br/0","x":{"y":"https://www.olx.com.br/1"}} trailing } };', ["1"]),
        ('window.__SSR_STATE__ = []; window.__SSR_STATE__ = {broken}; {"u":"https://www.olx.com.br/1"}', []),
    ],
)
def test_state_links(pages, body, want):
    assert sorted(r.link for r in discover.state_links(pages(body)).collect()) == [f"https://www.olx.com.br/{n}" for n in want]


def test_references_equal_the_standard_library(spark):
    rng = random.Random(1)
    names = sorted(html5)
    texts = ["&apos;&dollar;&frac12 &#150;", "&notit; &notin; &not &amp &ampx &copy2;", "&#36 &#x24z &#128; &#x9f;", "&;&#;&#x;&&amp;amp;"]
    texts += ["".join(rng.choice(["&", "", "x"]) + rng.choice(names)[: rng.randint(1, 12)] + rng.choice(["", ";", " ", "=", "1"]) for _ in range(6)) for _ in range(400)]
    texts += [f"&{n}" for n in names]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", entities.decode(F.col("t")).alias("v")).collect()
    assert [r for r in rows if r.v != html.unescape(r.t)] == []


def test_followed(spark):
    row = spark.createDataFrame([('x<a b=">">1</a>2<a>3',)], "t string").select(tags.followed(F.col("t"), "a").alias("f")).first()
    assert [tuple(x) for x in row.f] == [('<a b=">">', "1</a>2"), ("<a>", "3")]

import base64

import pytest
from pyspark.sql import functions as F

from garimpo.functions import jsons, keys, urls

TARGET = "https://casas.example.org/lista/2Fz?m=n%20o"
CODED = base64.urlsafe_b64encode(TARGET.encode()).decode().rstrip("=")
ENGINE = "https://www.bing.com"


@pytest.mark.parametrize(
    "href, want",
    [
        (f"{ENGINE}/ck/a?t=7&u=a1https3A%2F%2Fcasas.example.org%2Flista%2F&z=2", "https://casas.example.org/lista/"),
        (f"{ENGINE}/r?ref=https%3A%2F%2Flotes.example.net%2F9%2F", "https://lotes.example.net/9/"),
        ("https://casas.example.org/lista/9", "https://casas.example.org/lista/9"),
        ("https://buscador.example.com/?q=sitio", "https://buscador.example.com/?q=sitio"),
        (f"{ENGINE}/search?q=sitio%20em%20minas&p=3", None),
        (f"{ENGINE}/ck/a?u=a1{CODED}&z=2", TARGET),
        (f"{ENGINE}/ck/a?u=a1mailto&z=2", None),
        (f"{ENGINE}/ck/a?u=a1https%3A%2F%2Fy.net%2F2Fdef", "https://y.net/2Fdef"),
        (f"{ENGINE}/ck/a?u=%", None),
    ],
)
def test_unwrap_redirect(value, href, want):
    assert value(urls.unwrap_redirect, href) == want


def test_result_link(value):
    assert value(urls.unwrap_result_link, "/url?q=https://a.com/x&sa=U") == "https://a.com/x"
    assert value(urls.unwrap_result_link, "/url?q=https://webcache.x/y") is None
    assert value(urls.unwrap_result_link, "/search?q=a") is None


@pytest.mark.parametrize(
    "href, want",
    [
        ("https://b.com/x", "https://b.com/x"),
        ("//cdn.com/x", "https://cdn.com/x"),
        ("/x?y=1", "https://a.com/x?y=1"),
        ("x", "https://a.com/p/x"),
        ("#top", "https://a.com/p/q?r=1#top"),
        ("?s=2", "https://a.com/p/q?s=2"),
        ("", "https://a.com/p/q?r=1"),
        (None, None),
    ],
)
def test_resolve(value, href, want):
    assert value(lambda c: urls.resolve(c, F.lit("https://a.com/p/q?r=1")), href) == want


def test_resolve_on_a_bare_host(value):
    assert value(lambda c: urls.resolve(c, F.lit("https://a.com")), "x") == "https://a.com/x"


def test_tags_and_ids(value):
    assert value(urls.site_label, "https://www.zapimoveis.com.br/a") == "ZAPIMOVEIS"
    assert value(urls.site_label, "https://example.com") is None
    assert value(urls.queue_domain, "https://example.com") == "outro"
    assert value(urls.domain_of, "https://x/olx.com.br/vivareal.com.br") == "vivareal.com.br"
    assert value(urls.native_id, "https://www.olx.com.br/vi/123?x=1") == "123"
    assert value(urls.native_url, "123") == "https://www.olx.com.br/vi/123"
    assert value(urls.strip_query, "https://a.com/b?c?d") == "https://a.com/b"
    assert value(lambda c: urls.city_search_url("h.com", c), "Belo Horizonte") == (
        "https://h.com/venda/apartamentos/belo-horizonte-pr/"
    )


def test_quote_matches_percent_encoding(value):
    from urllib.parse import quote

    for given in ["site:olx.com.br são paulo", "a/b~c*d+e&f=g", "100% ok_-."]:
        assert value(urls.quote, given) == quote(given)


def test_page_url(value):
    assert value(lambda c: urls.page_url(c, F.lit(2)), "https://a.com/x") == "https://a.com/x?page=2"
    assert value(lambda c: urls.page_url(c, F.lit(2)), "https://a.com/x?a=1") == "https://a.com/x?a=1&page=2"


@pytest.mark.parametrize(
    "body, header, want",
    [
        ('{"next": "", "endCursor": "abc"}', None, "abc"),
        ('{"next": 7, "cursor": "x"}', None, "7"),
        ('{"next": 0, "after": false}', '<https://a.com/2>; rel="next"', "https://a.com/2"),
        ("not json", None, None),
    ],
)
def test_page_cursor(spark, body, header, want):
    df = spark.createDataFrame([(body, header)], "b string, h string")
    assert df.select(jsons.page_cursor(F.col("b"), F.col("h")).alias("v")).first()["v"] == want


def test_keys_write_missing_parts_as_none(spark):
    from hashlib import md5

    df = spark.createDataFrame([("T", None, "u")], "t string, p string, l string")
    t, p, link = F.col("t"), F.col("p"), F.col("l")
    row = df.select(
        keys.listing_key(t, p, link).alias("a"),
        keys.text_key(t, p, link).alias("b"),
        keys.card_key(t, p, p, link).alias("c"),
        keys.offer_key(t, p).alias("d"),
        keys.api_key(p).alias("e"),
        keys.link_key(link).alias("f"),
    ).first()
    assert list(row) == [md5(x.encode()).hexdigest() for x in ["TNoneu", "Tu", "TNoneu", "TNone", "None", "u"]]

import html

import pytest
from pyspark.sql import functions as F

from garimpo.functions import entities, text
from garimpo.operators import discover, extract


@pytest.mark.parametrize(
    "given",
    ["", "a", "&", "&&amp;&", "R&#36;&#160;350.000", "S&atilde;o &Ccedil; m&sup2;", "&#x1F3E0;&#X41;", "&copy;&middot;", "&nope; &;"],
)
def test_references_are_decoded_once(value, given):
    assert value(entities.decode, given) == html.unescape(given)
    assert value(entities.decode, "&amp;lt;") == "&lt;" and value(entities.decode, None) is None
    assert value(entities.decode, "&#0;&#xD800;&#9999999;") == "&#0;&#xD800;&#9999999;"


def test_visible_text_and_tags(value):
    assert value(text.visible_text, "<p>R&#36;&#160;350.000 em S&atilde;o</p>") == "R$ 350.000 em São"
    assert value(text.document_title, '<TITLE lang="pt">\n Casa &amp;\n sol </title>') == "Casa & sol"
    for tag in ("<meta content=\"Casa d'agua\" name=description>", "<meta name='description' data-content=x content='Casa d&#39;agua'/>"):
        assert value(text.document_description, tag) == "Casa d'agua"
    assert value(text.document_description, '<meta name="descriptions" content="x">') is None


@pytest.fixture
def pages(spark):
    return lambda body: spark.createDataFrame([(1, "https://www.olx.com.br/a", body)], "page_id long, url string, html string")


def test_hrefs_as_the_page_means_them(pages):
    body = (
        "<!-- <a href='/no'> --><script>'<a href=/no2>'</script><a data-href=x href=/bare>1</a><A HREF='/a?b=1&amp;c=2'>2</a>"
        '<a class=x href="/it\'s">3</a>'
    )
    assert [r.href for r in discover.hrefs(pages(body)).orderBy("pos").collect()] == ["/bare", "/a?b=1&c=2", "/it's"]


def test_state_values_are_unescaped_and_keys_are_no_links(pages):
    body = r'window.__INITIAL_STATE__ = {"https://www.olx.com.br/key":{"u":"https:\/\/www.olx.com.br\/vi\/1?x=2","v":"https://pr.olx.com.br/2"}};'
    assert sorted(r.link for r in discover.state_links(pages(body)).collect()) == ["https://pr.olx.com.br/2", "https://www.olx.com.br/vi/1"]


@pytest.mark.parametrize("kind", ['"application/ld+json"', "'application/ld+json'", "application/ld+json"])
def test_json_ld_in_any_quoting(pages, kind):
    body = f'<script async type={kind}>{{"@type":"Product","name":"Casa","offers":{{"price":"R$ 1"}}}}</script>' + " " * 100
    assert extract.merged_ads(pages(body)).first().titulo == "Casa"
    assert extract.requests_listings(pages(body)).first().preco == "R$ 1"


def test_numbers_come_from_the_page(pages):
    body = "<title>Terreno</title><p>R$350.000 12000 m²</p>" + " " * 100
    row = extract.typed(extract.regex_listings(pages(body))).first()
    assert (row.metragem, row.metragem_num, row.preco_num) == ("2000 m²", 12000, 350000)


def test_presence_reaches_the_scan(spark, fresh_dir):
    spark.createDataFrame([("a",), ("",), (None,)], "preco string").write.parquet(f"{fresh_dir}/t")
    kept = spark.read.parquet(f"{fresh_dir}/t").filter(text.present(F.col("preco")))
    assert [r.preco for r in kept.collect()] == ["a"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(preco), Not(EqualTo(preco,))]" in plan

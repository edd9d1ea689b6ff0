import random
import time

import pytest

from garimpo.functions.markup import PageReader, read_cards, read_place
from garimpo.operators import cards


@pytest.fixture
def pages(spark):
    def build(html):
        return spark.createDataFrame([(1, "https://a.com/busca/x", html)], "page_id long, url string, html string")

    return build


def test_reader_closes_open_elements_and_skips_scripts():
    page = PageReader("<div><p>a<br>b<script>no</script></div><p>c &amp; d")
    assert page.text(page.elements[0]) == "a b"
    assert page.lines(page.elements[0]) == "a\nb"
    assert page.text(page.elements[-1]) == "c & d"


class StandardReader(PageReader):
    """All of a page by the standard reader."""

    def _read_plain(self, html):
        return 0


def seen(page):
    return page.pieces, [(e.tag, e.attrs, e.index, e.last_index, e.first_piece, e.last_piece) for e in page.elements]


def test_plain_markup_is_read_as_by_the_standard_reader():
    rng = random.Random(3)
    tags = [
        "<div>", "</div>", '<a class="x y" href="/i/1">', "</a>", "<br>", "<p>", "</p>", "<SPAN Class=\"A\"\n id=\"\">", "</Span>", "<h2\t>",
        "<a href='q&amp;r' b=1>", '<a href="x?a=1&copy=2&amp;b">', "<img src=x />", "<br/>", "<p hidden>", '<p a="1"b="2">', "</ p>", "</p >", '<é x="1">',
        "<x-y z>", "<!-- c -->", "<!-- <b> -- c -->", "<!DOCTYPE html>", "<!doctype x>", "<?php ?>", "<![CDATA[x]]>", "<", "< b", "</", "</>", "<!", "<div", '<a href="', ">",
        "<script>", "</script>", '<script type="a">if (a < b) "<b>" </script>', "<script>1 </b> 2</script>", "<style>p > a {}</style>", "<script/>", "<STYLE>x</Style>", "<script>a</style>", "\x00", "<p\x00>", "<p\xa0a=\"1\">",
    ]
    texts = ["t ", "&amp;", "&copy", "a & b", " ", "\n", "bairro", "é", "&#36;", "x;"]
    for k in range(6000):
        some = tags[:10] if k % 3 == 0 else tags
        html = "".join(rng.choice(some if rng.random() < 0.6 else texts) for _ in range(rng.randint(0, 14)))
        assert seen(PageReader(html)) == seen(StandardReader(html)), html


def test_plain_markup_is_read_in_less_time():
    html = "<!DOCTYPE html><body>" + '<div class="card"><h3>Casa boa</h3><p>R$ 5</p><a href="/vi/1">ver</a></div>' * 4000

    def seconds(reader):
        took = []
        for _ in range(3):
            started = time.process_time()
            reader(html)
            took.append(time.process_time() - started)
        return min(took)

    assert seconds(PageReader) < 0.75 * seconds(StandardReader)


def test_only_wanted_texts_are_made():
    html = "<div class='card'><p>a</p>b</div>"
    both = read_cards(html, cards.PORTAL.selectors, {}, None)[0]
    assert (both["text"], both["lines"]) == ("a b", "a\nb")
    none = read_cards(html, cards.PORTAL.selectors, {}, None, ())[0]
    assert (none["text"], none["lines"]) == (None, None)


def test_many_open_elements_are_read_in_linear_time():
    started = time.time()
    html = "<p title='bairro'><span>x" * 30000 + "</i></b>" * 1000
    assert read_place(html) == {"label": None, "crumb": None}
    assert len(PageReader("<div class='card'>" * 20000).elements) == 20000
    assert time.time() - started < 20


def test_places():
    trail = "<div class='breadcrumb'><a>A</a><b><a> B <i>b</i></a></b></div><a>C</a>"
    assert read_place(trail + "<section>bairro<span>o Bairro</span></section>") == {"label": "o Bairro", "crumb": "Bb"}
    assert read_place("<a rel='breadcrumb'>X</a>" + trail)["crumb"] == "X"


def test_nested_cards_and_first_selector_that_hits():
    html = "<div class='card'><div class='card-body'>x</div></div><li class='search-result'>y</li>"
    found = read_cards(html, [tuple(s) for s in cards.PORTAL.selectors], {}, None)
    assert [c["text"] for c in found] == ["y"] and found[0]["selector"] == 4


def test_portal_cards(pages):
    card = "<div class='property-card big'><h3>Casa {0}</h3><span class='x-location'>Centro</span> r$ {0}.000 80 M2 {1}</div>"
    html = "".join(card.format(i, "<a href='/vi/%d'>v</a>" % i if i else "") for i in range(12))
    html += "<div class='property-card'><h3>sem preco</h3></div>"
    rows = cards.portal_cards(pages(html)).orderBy("pos").collect()
    assert len(rows) == 12
    assert (rows[1].titulo, rows[1].preco, rows[1].metragem, rows[1].bairro) == ("Casa 1", "R$ 1.000", "80 m²", "Centro")
    assert rows[1].link == "https://a.com/vi/1" and rows[0].link is None
    assert cards.portal_cards(pages(html), cards.PORTAL._replace(limit=10)).count() == 10


def test_browser_cards(pages):
    html = "<div class='listing'><h2>Apto</h2><p>2 quartos 1 banheiro 50 m2</p></div><div class='listing'><b>Casa boa</b><p>R$ 5</p></div>"
    a = cards.browser_cards_a(pages(html)).collect()
    assert [(r.titulo, r.preco) for r in a] == [("Casa boa", "R$ 5")]
    b = cards.browser_cards_b(pages(html.replace("listing", "card"))).orderBy("pos").collect()
    assert [(r.titulo, r.preco, r.quartos) for r in b] == [
        ("2 quartos 1 banheiro 50 m2", "Sob consulta", "2 Q"), ("Casa boa", "R$ 5", None),
    ]


def test_offer_and_bank_cards(pages):
    html = "<article><a class='css-1jv9qum' href='x/1'>T</a><span data-qa='price'> R$ 1 </span> 9 m²</article><article>-</article>"
    row = cards.offer_cards(pages(html)).collect()
    assert [(r.titulo, r.preco, r.metragem, r.link) for r in row] == [("T", "R$ 1", "9 m²", "https://a.com/busca/x/1")]
    anchor = "<a data-testid='card-property' href='/i/1'><div class='my-title'>T</div><span class='price'>R$ 2</span></a>"
    row = cards.offer_cards(pages(anchor), cards.ANCHOR).first()
    assert (row.titulo, row.preco, row.link) == ("T", "R$ 2", "https://a.com/i/1")
    bank = "".join(
        f"<div class='card-imovel'><h4 class='titulo-imovel'>T</h4><i class='end-imovel'>E</i>{city}"
        "<b class='valor-imovel'>V</b><a href='d.asp'>x</a></div>"
        for city in ["<u class='cidade-imovel'>C</u>", ""]
    )
    assert [r.link for r in cards.bank_cards(pages(bank)).collect()] == [
        "https://venda-imoveis.caixa.gov.br/sistema/d.asp"
    ]


def test_selector_counts_skip_scripts_and_comments(pages):
    html = (
        "<article class=\"card big\"></article><!-- <article> --><script>'<article>'</script>"
        "<li data-listing=\"1\"><div data-id=\"2\" class=\"x card\">"
    )
    rows = cards.selector_counts(pages(html)).collect()
    assert {(r.selector, r.n) for r in rows} == {
        ("article", 1), ("li[data-listing]", 1), ("div[data-id]", 1), (".card", 2),
    }

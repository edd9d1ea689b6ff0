import pytest

from garimpo.operators import extract

FILL = "<p>" + "texto de enchimento " * 8 + "</p>"


def script(body):
    return f'<SCRIPT  type="application/ld+json" id="x">{body}</SCRIPT>'


@pytest.fixture
def pages(spark):
    def build(*htmls, url="https://www.olx.com.br/vi/1"):
        rows = [(i, url, h) for i, h in enumerate(htmls)]
        return spark.createDataFrame(rows, "page_id long, url string, html string")

    return build


def test_first_usable_object_wins(pages):
    html = (
        script("{broken")
        + script("{'single': 'quotes'}")
        + script('{"@type": "WebSite", "description": "d"}')
        + script('[1, "x", {"headline": "Casa", "offers": {"price": 350000.5}, "telephone": "t"}]')
        + script('{"name": "Outra"}')
    )
    row = extract.listings(pages(html + FILL)).first()
    assert (row.titulo, row.preco, row.contato, row.fonte) == ("Casa", "R$ 350000.5", "t", "OLX")


@pytest.mark.parametrize(
    "offers, want",
    [
        ('{"price": 350000}', "R$ 350000"),
        ('{"price": "R$ 5"}', "R$ 5"),
        ('{"price": "5"}', "5"),
        ('{"price": 0, "priceSpecification": {"price": 7}}', "R$ 7"),
        ('{"price": "", "priceSpecification": {"price": "8"}}', "8"),
        ('[{"price": 9}, {"price": 10}]', "R$ 9"),
        ('{"priceSpecification": [{"price": 7}]}', None),
        ('"gratis"', None),
        ("[]", None),
        ("null", None),
    ],
)
def test_prices(pages, offers, want):
    html = script('{"name": "Casa", "address": "Rua X", "contactPoint": [], "offers": %s}' % offers)
    row = extract.listings(pages(html + FILL)).first()
    assert (row.titulo, row.preco, row.endereco, row.contato) == ("Casa", want, None, None)


@pytest.mark.parametrize(
    "body, want",
    [
        ('{"name": "A"};', None),
        ('{"name": "A"}{"name": "B"}', None),
        ('{"name": "A"},{"name": "B"}', None),
        ('[{"name": "A"}];', None),
        (' [ {"name": "A"} ] ', "A"),
        ('{"name": "A", "name": "B"}', "B"),
        ('{"@graph": [{"name": "A"}]}', None),
        ('"name"', None),
        ("[" * 5000, None),
        ('{"a":' * 3000 + "1" + "}" * 3000, None),
        ("", None),
    ],
)
def test_only_whole_json_values_count(pages, body, want):
    row = extract.listings(pages("<title>T</title>" + script(body) + FILL)).first()
    assert row.titulo == (want or "T")


def test_address_and_contact(pages):
    html = script(
        '{"name": "", "headline": "H", "contactPoint": {"telephone": "99"}, "address": {"streetAddress": "Rua {1}",'
        ' "addressLocality": "Curitiba", "addressRegion": "PR", "postalCode": "80000-000"}}'
    )
    row = extract.listings(pages(html + FILL)).first()
    assert (row.titulo, row.endereco, row.cidade, row.estado, row.cep, row.contato) == (
        "H", "Rua {1}", "Curitiba", "PR", "80000-000", "99",
    )


def test_untitled_object_takes_the_start_of_the_page(pages):
    html = script('{"offers": {"price": 5}}') + "\n \n" + FILL
    row = extract.listings(pages(html)).first()
    assert row.titulo == " ".join(html.split())[:150]


def test_text_fallback_uses_embedded_address_first(pages):
    html = (
        '<title>Apto</title><script>var s = {"addressLocality" : "Santos", "postalCode":"11000-000"}</script>'
        "<p>R$ 350.000, 2 quartos, 1 banheiro, 50 m²</p><p>Rua A 1, Curitiba - PR</p>" + FILL
    )
    row = extract.listings(pages(html)).first()
    assert (row.titulo, row.preco, row.metragem, row.quartos, row.banheiros) == (
        "Apto", "R$ 350.000,", "50 m²", "2 Q", "1 B",
    )
    assert (row.endereco, row.cidade, row.estado, row.cep) == ("Rua A 1", "Santos", "PR", "11000-000")


def test_short_empty_and_missing_pages_give_nothing(pages):
    assert extract.listings(pages("<title>x</title>", "", None, FILL)).count() == 0


def test_page_states(pages):
    rows = extract.classify_pages(
        pages(
            "<title>Just a moment...</title>" + FILL, "Não encontramos imóveis" + FILL, "x", None, FILL
        )
    )
    assert [r.state for r in rows.orderBy("page_id").collect()] == [
        "challenge", "empty", "short", "short", "ok",
    ]


def test_typed_columns(pages):
    rows = extract.listings(pages("<title>A</title> R$ 1.234,50 12000 m² 3 quartos 2 b. " + FILL))
    from pyspark.sql import functions as F

    row = extract.typed(rows.withColumn("data_coleta", F.lit("2025-01-02T03:04:05"))).first()
    assert (float(row.preco_num), row.quartos_num, row.banheiros_num) == (1234.5, 3, 2)
    assert row.metragem == "2000 m²" and row.coletado_em.year == 2025


def test_unclosed_scripts_are_searched_once(pages):
    import time

    from garimpo.operators.cards import selector_counts

    opened = '<script type="application/ld+json">{"name": "A"}'
    started = time.time()
    rows = pages("<title>T</title>" + opened * 30000, script('{"name": "B"}') + opened + FILL)
    assert [r.titulo for r in extract.listings(rows).orderBy("page_id").collect()] == ["T", "B"]
    assert [r.titulo for r in extract.merged_ads(rows).orderBy("page_id").collect()] == ["T", "B"]
    assert selector_counts(rows).count() == 0
    assert time.time() - started < 60


def test_requests_variant(pages):
    html = (
        script('{"@type": "BreadcrumbList", "name": "x"}')
        + script('[{"name": "lista"}]')
        + script('{"name": "Casa", "offers": [{"price": 5}], "telephone": "1", "contactPoint": {"telephone": "2"}}')
    )
    row = extract.requests_listings(pages(html)).first()
    assert (row.titulo, row.preco, row.contato) == ("Casa", "R$ 5", "2")
    plain = extract.requests_listings(pages("<h1>Casa</h1> R$   7 CEP 111111-222 (11) 91234-5678", "<p>nada</p>"))
    assert [tuple(r)[1:3] + (r.cep, r.contato) for r in plain.collect()] == [
        ("Casa", "R$ 7", "11111-222", "(11) 91234-5678")
    ]


def test_merge_takes_first_value_per_field(pages):
    html = (
        script('{"@type": "WebPage", "name": "Site", "description": "d1", "offers": {"price": 1}}')
        + script('{"@type": "Product", "name": "Casa", "offers": {"price": 2}, "address": {"addressRegion": "PR"}}')
        + script('{"@type": "Offer", "offers": {"price": 3}, "address": {"streetAddress": "Rua 1"}}')
        + '<ul class="x breadcrumb"><li><a>Brasil</a></li><li><a>Curitiba</a></li></ul>'
        + "<p>CEP 80000-000 Tel (41) 91234-5678</p><p>Bairro <b>Centro</b></p>"
    )
    row = extract.merged_ads(pages(html)).first()
    assert (row.titulo, row.descricao, row.preco, row.estado, row.endereco) == (
        "Site", "d1", "R$ 2", "PR", "Rua 1",
    )
    assert (row.cidade, row.cep, row.contato) == ("Curitiba", "80000-000", "(41) 91234-5678")


def test_merge_label_and_title_fallback(pages):
    html = "<title> T </title><body><p>um</p><p>No Bairro <b>Centro</b></p><p>R$ 5</p><a rel='breadcrumb'>Lapa</a>"
    row = extract.merged_ads(pages(html)).first()
    assert (row.titulo, row.preco, row.endereco, row.cidade) == ("T", "R$ 5", "No Bairro Centro", "Lapa")


def test_text_listings(spark):
    rows = spark.createDataFrame(
        [(1, "u", "\n Casa boa \n R$ 10, 50 m2 e 2 quartos"), (2, None, " \n ")], "k int, url string, text string"
    )
    row = extract.text_listings(rows).collect()
    assert [(r.titulo, r.preco, r.metragem, r.quartos) for r in row] == [("Casa boa", "R$ 10,", "50 m²", "2 Q")]

from decimal import Decimal

import pytest

from garimpo import constants as C
from garimpo.functions import money, text


@pytest.mark.parametrize(
    "given, want",
    [
        ("por R$ 350.000 hoje", "R$ 350.000"),
        ("R$ 350.000,00", "R$ 350.000,00"),
        ("R$ \n\t 5", "R$ 5"),
        ("R$350, a vista", "R$350,"),
        ("US$ 350", None),
        (None, None),
    ],
)
def test_price(value, given, want):
    assert value(text.price_find, given) == want


def test_price_variants(value):
    assert value(text.price_upper, "por r$ 10.000 hoje") == "R$ 10.000"
    assert value(text.price_or_request, "R$   99") == "R$ 99"
    assert value(text.price_or_request, "ligue") == C.PRICE_ON_REQUEST


@pytest.mark.parametrize(
    "build, given, want",
    [
        (text.area_find, "com 50 m² e 70 m²", "50 m²"),
        (text.area_find, "50M2", "50 m²"),
        (text.area_find, "12000 m²", "2000 m²"),
        (text.area_find, "5 m²", None),
        (text.rooms_find, "2 Quartos", "2 Q"),
        (text.rooms_find, "3q", "3 Q"),
        (text.rooms_find, "3 quadras", None),
        (text.baths_find, "2 b. x", "2 B"),
        (text.baths_find, "1 banheiro", "1 B"),
        (text.baths_find, "2 banheirosx", None),
        (text.cep_find, "CEP 01311-100.", "01311-100"),
        (text.cep_find, "x901311-1000", None),
        (text.phone_find, "Tel (11) 98765-4321", "(11) 98765-4321"),
        (text.phone_find, '<a href="tel:+55 11 3333">x</a>', "+55 11 3333"),
        (text.phone_find, "<b data-phone='33-44'>x</b>", "33-44"),
        (text.html_title, "<TITLE> Casa </TITLE><h1>x</h1>", "Casa"),
        (text.html_title, "<title></title><h1 class='a'>Casa <b>boa</b>\n</h1>", "Casa boa"),
        (text.meta_description, '<meta  name="description" content="abc">', "abc"),
        (text.meta_description, '<meta property="og:description" content="og">', "og"),
        (text.collapse_ws, " a \n b ", " a b "),
        (text.first_line, "\n  \n  linha um \nlinha dois", "linha um"),
        (text.first_line, "\n \n", None),
        (
            text.visible_text,
            "<p>a<style>p{}</style><!-- c --></p><script>var t='</p>';</script>b&amp;c&nbsp;d",
            "a b&c d",
        ),
        (text.none_if_empty, "", None),
        (text.strip, "  a b\t", "a b"),
        (text.fold, "São PAULO", "sao paulo"),
    ],
)
def test_finders(value, build, given, want):
    assert value(build, given) == want


def test_first_line_is_cut_at_150(value):
    assert len(value(text.first_line, "x" * 200)) == 150


def test_address_line(value):
    def build(c):
        return text.address_line(text.address_match(c))

    got = value(build, "<p>Rua das Flores 10, Curitiba - PR</p>")
    assert tuple(got) == ("Rua das Flores 10", "Curitiba", "PR")
    assert tuple(value(build, "sem endereco")) == (None, None, None)


def test_address_line_is_linear_on_long_runs(value):
    def build(c):
        return text.address_line(text.address_match(c))

    got = value(build, "palavra comum, " * 20000 + "fim, Sao Paulo - SP")
    assert got["cidade"] == "Sao Paulo" and got["estado"] == "SP"


@pytest.mark.parametrize(
    "given",
    [
        "x" * 300000,
        "9" * 300000,
        " " * 300000,
        "a, " + " " * 100000 + "b",
        "<script" * 20000,
        "palavra, " * 50000,
        "a-b, c - d, " * 30000,
        "R$" + " " * 100000,
    ],
)
def test_long_texts_are_searched_in_linear_time(value, given):
    import time

    from pyspark.sql import functions as F

    def build(c):
        finders = [text.price_find, text.area_find, text.rooms_find, text.baths_find, text.cep_find]
        finders += [text.phone_find, text.address_match, text.html_title, text.first_line]
        return F.struct(*[f(c).alias(f"f{i}") for i, f in enumerate(finders)])

    started = time.time()
    value(build, given)
    assert time.time() - started < 30


@pytest.mark.parametrize(
    "given, want",
    [
        ("Rua A,  - PR", ("Rua A", "", "PR")),
        ("x-1, Belo Horizonte-MG", ("x-1", "Belo Horizonte", "MG")),
        ("a, b, c - dd, Rio - RJ", ("a, b, c - dd", "Rio", "RJ")),
        (", Rio - RJ", (None, None, None)),
    ],
)
def test_address_edges(value, given, want):
    assert tuple(value(lambda c: text.address_line(text.address_match(c)), given)) == want


@pytest.mark.parametrize(
    "given, br, naive",
    [
        ("R$ 350.000", Decimal("350000.00"), 350.0),
        ("R$ 1.250.000,50", Decimal("1250000.50"), 1.25),
        ("R$ 350.000,", Decimal("350000.00"), 350.0),
        ("Sob consulta", None, 0.0),
        ("", None, 0.0),
        (None, None, None),
    ],
)
def test_money(value, given, br, naive):
    assert value(money.money_br, given) == br
    assert value(money.money_naive, given) == naive


def test_numbers_of_typed_columns(value):
    assert value(money.area_number, "12000 m²") == 12000
    assert value(money.area_number, None) is None
    assert value(money.count_number, "2 Q") == 2
    assert value(text.iso_time, "invalid") is None
    assert str(value(text.iso_time, "2025-11-16T22:17:32.5")) == "2025-11-16 22:17:32.500000"

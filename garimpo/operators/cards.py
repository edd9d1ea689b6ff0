"""Result-page cards to listings, one job with a site description as parameter."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.functions import keys, text, urls
from garimpo.functions.markup import CARD_TEXTS, cards_of
from garimpo.functions.steps import computed


class CardSite(NamedTuple):
    """Where the cards of a site are and what is read from them; ``limit`` caps the cards of a page.

    ``texts`` names the texts of a whole card that are read: ``text``, ``lines``; others are null.
    """

    selectors: list
    fields: dict
    source: str | None = None
    limit: int | None = None
    texts: tuple = CARD_TEXTS


PORTAL = CardSite(
    C.CARDS_PORTAL, {"title": C.PORTAL_TITLE, "place": C.PORTAL_PLACE}, "imovelweb", texts=("text",)
)
BROWSER_A = CardSite(C.CARDS_BROWSER_A, {}, "ImóvelWeb", texts=("lines",))
BROWSER_B = CardSite(C.CARDS_BROWSER_B, {}, "VivaReal", texts=("lines",))
ARTICLE = CardSite(
    C.CARDS_ARTICLE,
    {"title": C.ARTICLE_TITLE, "price": C.ARTICLE_PRICE},
    "ImóvelVirtual",
    texts=("text",),
)
ANCHOR = CardSite(
    C.CARDS_ANCHOR,
    {"title": C.ANCHOR_TITLE, "price": C.ANCHOR_PRICE},
    "VivaReal",
    texts=("text",),
)
BANK = CardSite(
    C.CARDS_BANK,
    {
        "title": C.BANK_TITLE,
        "address": C.BANK_ADDRESS,
        "place": C.BANK_CITY,
        "price": C.BANK_PRICE,
    },
    C.BANK_SOURCE,
    texts=(),
)


def raw_cards(pages: DataFrame, site: CardSite) -> DataFrame:
    """One row per card with its position; the page text ends here."""
    found = cards_of(F.col("html"), site.selectors, site.fields, site.limit, site.texts)
    return (
        pages.select("page_id", "url", F.posexplode(found).alias("pos", "card"))
        .select("page_id", "url", "pos", "card.*")
        .withColumn("href", F.nullif("href", F.lit("")))
    )


def _cut(value: Column, chars: int | None) -> Column:
    return value if chars is None else text.prefix(value, chars)


def portal_cards(pages: DataFrame, site: CardSite = PORTAL, text_chars: int | None = C.CARD_TEXT_CHARS) -> DataFrame:
    """Cards with a title and a price; the key uses the page when there is no link.

    The description is the card's text up to ``text_chars`` (None: all of it).
    """
    body = F.col("text")
    found = computed(
        raw_cards(pages, site),
        ["page_id", "url", "pos"],
        {
            "titulo": text.none_if_empty(F.col("title")),
            "preco": text.price_upper(body),
            "metragem": text.area_find(body, C.AREA_LOOSE),
            "bairro": F.col("place"),
            "descricao": _cut(body, text_chars),
            "link": urls.resolve(F.col("href"), F.col("url")),
        },
    )
    return (
        found.filter("titulo is not null and preco is not null")
        .withColumn(
            "id", keys.card_key(F.col("titulo"), F.col("preco"), F.col("link"), F.col("url"))
        )
        .withColumn("fonte", F.lit(site.source))
        .drop("url")
    )


def _named(found: DataFrame, site: CardSite, title_chars: int | None, *columns: str) -> DataFrame:
    return found.withColumn("id", keys.offer_key(F.col("titulo"), F.col("preco"))).select(
        "page_id", "pos", "id",
        *[
            (_cut(F.col(c), title_chars) if c == "titulo" else F.col(c)).alias(c)
            for c in columns
        ],
        F.lit(site.source).alias("fonte"),
    )


def _line(n: int) -> Column:
    return text.none_if_empty(F.get(F.split("lines", "\n"), F.lit(n)))


def browser_cards_a(
    pages: DataFrame, site: CardSite = BROWSER_A, title_chars: int | None = C.CARD_TITLE_CHARS
) -> DataFrame:
    """Cards read from their visible lines: first line is the title, up to ``title_chars``."""
    lines = F.col("lines")
    found = computed(
        raw_cards(pages, site).filter(F.length("lines") >= C.MIN_CARD_CHARS),
        ["page_id", "pos"],
        {
            "titulo": _line(0),
            "preco": text.price_or_request(lines),
            "metragem": text.area_find(lines, C.AREA_LOOSE),
            "quartos": text.rooms_find(lines, C.ROOMS_LOOSE),
            "banheiros": text.baths_find(lines, C.BATHS_LOOSE),
            "link": urls.resolve(F.col("href"), F.col("url")),
        },
    )
    return _named(
        found.filter(F.length("titulo") >= C.MIN_TITLE_CHARS),
        site, title_chars, "titulo", "preco", "metragem", "quartos", "banheiros", "link",
    )


def browser_cards_b(
    pages: DataFrame, site: CardSite = BROWSER_B, title_chars: int | None = C.CARD_TITLE_CHARS
) -> DataFrame:
    """As ``browser_cards_a``; a short first line gives way to the second."""
    lines = F.col("lines")
    title = F.when(F.length(_line(0)) >= C.MIN_TITLE_CHARS, _line(0)).otherwise(
        F.coalesce(_line(1), F.lit(C.UNTITLED_CARD))
    )
    found = computed(
        raw_cards(pages, site).filter(F.length("lines") >= C.MIN_TITLE_CHARS),
        ["page_id", "pos"],
        {
            "titulo": title,
            "preco": text.price_or_request(lines),
            "metragem": text.area_find(lines, C.AREA_LOOSE),
            "quartos": text.rooms_find(lines, C.ROOMS_LOOSE),
            "link": urls.resolve(F.col("href"), F.col("url")),
        },
    )
    return _named(
        found.filter(F.length("titulo") > 3), site, title_chars, "titulo", "preco", "metragem", "quartos", "link"
    )


def offer_cards(pages: DataFrame, site: CardSite = ARTICLE) -> DataFrame:
    """Cards with marked title and price elements; both must be there."""
    href = F.col("own_href") if site.selectors == C.CARDS_ANCHOR else F.col("href")
    found = computed(
        raw_cards(pages, site),
        ["page_id", "pos"],
        {
            "titulo": text.none_if_empty(F.col("title")),
            "preco": text.none_if_empty(F.col("price")),
            "metragem": text.area_find(F.col("text"), r"(?iuU)(?<!\d)(\d++)\s*m²"),
            "link": urls.resolve(href, F.col("url")),
        },
    )
    kept = found.filter("titulo is not null and preco is not null")
    return kept.withColumn("id", keys.offer_key(F.col("titulo"), F.col("preco"))).withColumn(
        "fonte", F.lit(site.source)
    )


def bank_cards(pages: DataFrame, site: CardSite = BANK) -> DataFrame:
    """Bank auction cards; a card missing any part is dropped."""
    parts = raw_cards(pages, site).select(
        "page_id", "pos",
        F.col("title").alias("titulo"),
        F.col("address").alias("endereco"),
        F.col("place").alias("cidade"),
        F.col("price").alias("valor"),
        F.concat(F.lit(C.BANK_BASE_URL), "href").alias("link"),
        F.lit(site.source).alias("fonte"),
    )
    return parts.dropna(subset=["titulo", "endereco", "cidade", "valor", "link"])


def selector_counts(pages: DataFrame) -> DataFrame:
    """Elements per probed selector and page, selectors without a hit left out.

    Counting open tags needs no element tree, so this stays in the JVM.
    """
    body = F.regexp_replace("html", r"(?ius)<script\b.*?(?:</script\s*>|\z)|<!--.*?(?:-->|\z)", "")
    counted = pages.select("page_id", body.alias("body")).select(
        "page_id",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("selector"),
                        F.regexp_count("body", F.lit(pattern)).alias("n"),
                    )
                    for name, pattern in C.PROBED_SELECTORS
                ]
            )
        ).alias("hit"),
    )
    return counted.select("page_id", "hit.selector", F.col("hit.n").cast("bigint").alias("n")).filter(
        "n > 0"
    )

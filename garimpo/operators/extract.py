"""Pages to listings.

The page text stays in the scan stage: every operator here is a narrow
projection, drops ``html`` as soon as the fields are out, and needs no shuffle.
Intermediate columns are materialised once per row, so several field finders
share one JSON-LD parse and one address scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.functions import jsons, keys, money, text, urls
from garimpo.functions.markup import page_places
from garimpo.functions.steps import computed

KEY_FIELDS = ["titulo", "preco", "metragem"]
FIELDS = [
    "titulo", "preco", "metragem", "quartos", "banheiros", "descricao",
    "endereco", "cidade", "estado", "cep", "contato",
]


def usable_pages(pages: DataFrame, min_chars: int = C.MIN_PAGE_CHARS) -> DataFrame:
    """Pages with at least ``min_chars`` characters."""
    return pages.filter(F.length("html") >= min_chars)


def page_state(html: Column) -> Column:
    """``challenge``, ``empty``, ``short`` or ``ok``: which pages are no listing."""

    def has(markers: list[str]) -> Column:
        hit = F.lit(False)
        for marker in markers:
            hit = hit | F.contains(html, F.lit(marker))
        return hit

    return (
        F.when(F.coalesce(F.length(html), F.lit(0)) < C.MIN_PAGE_CHARS, "short")
        .when(has(C.CHALLENGE_MARKERS), "challenge")
        .when(has(C.EMPTY_RESULT_MARKERS), "empty")
        .otherwise("ok")
    )


def classify_pages(pages: DataFrame) -> DataFrame:
    """Page keys with their state; the quarantine is every state but ``ok``."""
    return pages.select("page_id", "url", page_state(F.col("html")).alias("state"))


def any_field(*columns: str) -> Column:
    """At least one column holds text; plain conditions, which reach a Parquet scan."""
    keep = F.lit(False)
    for c in columns:
        keep = keep | text.present(F.col(c))
    return F.coalesce(keep, F.lit(False))


def all_fields(*columns: str) -> Column:
    keep = F.lit(True)
    for c in columns:
        keep = keep & F.col(c).isNotNull()
    return keep


def jsonld_rows(pages: DataFrame) -> DataFrame:
    """One row per JSON-LD object of a page: its position and listing fields."""
    objects = jsons.jsonld_listings(jsons.jsonld_objects(F.col("html")))
    return pages.select("page_id", F.posexplode(objects).alias("pos", "o")).select(
        "page_id", "pos", "o.*"
    )


def _first_jsonld(html: Column) -> Column:
    """First JSON-LD object of the page with a title, a price or a street."""
    parsed = jsons.jsonld_listings(jsons.jsonld_objects(html))
    hits = F.filter(
        parsed, lambda o: F.coalesce(o["titulo"], o["preco"], o["endereco"]).isNotNull()
    )
    return F.get(hits, F.lit(0))


def _page_start(html: Column, chars: int | None) -> Column:
    start = text.collapse_ws(html)
    return start if chars is None else text.prefix(start, chars)


def _rest(pages: DataFrame) -> list[str]:
    return [c for c in pages.columns if c not in ("html", "url")]


def _key_fields(html: Column, when: Column) -> dict[str, Column]:
    """The fields a page is kept for, searched only where ``when`` holds."""
    found = {
        "titulo": text.html_title(html),
        "preco": text.price_find(html),
        "metragem": text.area_find(html),
    }
    return {name: F.when(when, value) for name, value in found.items()}


def _other_fields(html: Column, when: Column) -> list[Column]:
    """The remaining fields; a query that does not use one does not search for it."""
    found = {
        "quartos": text.rooms_find(html),
        "banheiros": text.baths_find(html),
        "descricao": text.meta_description(html),
        "address": text.address_match(html),
        "cidade_json": jsons.embedded_city(html),
        "estado_json": jsons.embedded_region(html),
        "cep": F.coalesce(jsons.embedded_postal(html), text.cep_find(html)),
        "contato": text.phone_find(html),
    }
    return [F.when(when, value).alias(name) for name, value in found.items()]


def _with_address(found: DataFrame) -> DataFrame:
    line = text.address_line(F.col("address"))
    return found.withColumn("line", line).withColumns(
        {
            "endereco": F.col("line.endereco"),
            "cidade": F.coalesce("cidade_json", "line.cidade"),
            "estado": F.coalesce("estado_json", "line.estado"),
        }
    )


def _parsed(pages: DataFrame, ld: Column) -> DataFrame:
    """Pages with their JSON-LD listing, if any, as ``ld``."""
    return computed(pages, pages.columns, {"ld": ld})


def jsonld_listings(pages: DataFrame, title_chars: int | None = C.TITLE_CHARS) -> DataFrame:
    """Listings from JSON-LD only; a page without a usable object gives no row.

    An object without a title gets the page's start, up to ``title_chars`` (None: all of it).
    """
    rest = _rest(pages)
    parsed = _parsed(usable_pages(pages), _first_jsonld(F.col("html")))
    return parsed.filter("ld is not null").select(
        *rest,
        F.coalesce("ld.titulo", _page_start(F.col("html"), title_chars)).alias("titulo"),
        "ld.preco",
        *[F.lit(None).cast("string").alias(c) for c in ("metragem", "quartos", "banheiros")],
        "ld.descricao", "ld.endereco", "ld.cidade", "ld.estado", "ld.cep", "ld.contato",
        F.col("url").alias("link"),
    )


def regex_listings(pages: DataFrame) -> DataFrame:
    """Listings from page text only: kept with a title, a price or an area.

    ``metragem`` has at most four digits, as the listing format; ``area_m2`` is
    the whole number on the page.
    """
    rest = _rest(pages)
    html, always = F.col("html"), F.lit(True)
    keyed = computed(usable_pages(pages), [*rest, "url", "html"], _key_fields(html, always))
    kept = keyed.filter(any_field(*KEY_FIELDS))
    area = money.area_number(html).alias("area_m2")
    found = kept.select(*rest, "url", *KEY_FIELDS, area, *_other_fields(html, always))
    return _with_address(found).select(*rest, *FIELDS, F.col("url").alias("link"), "area_m2")


def listings(
    pages: DataFrame, title_chars: int | None = C.TITLE_CHARS, raw_chars: int | None = C.RAW_TEXT_CHARS
) -> DataFrame:
    """The main extractor: JSON-LD, else page text, plus source, key and raw text.

    Titles taken from the page's start and the raw text are cut to the given
    lengths; None leaves them whole.
    """
    rest = _rest(pages)
    html = F.col("html")
    parsed = _parsed(usable_pages(pages), _first_jsonld(html))
    from_ld = F.col("ld").isNotNull()
    start = F.when(from_ld & F.col("ld.titulo").isNull(), _page_start(html, title_chars))
    keyed = computed(
        parsed, [*rest, "url", "html", "ld"], {"start": start, **_key_fields(html, ~from_ld)}
    )
    found = keyed.filter(from_ld | any_field(*KEY_FIELDS)).select(
        *rest, "url", "ld", "start", *KEY_FIELDS,
        (html if raw_chars is None else text.prefix(html, raw_chars)).alias("raw_text"),
        *_other_fields(html, ~from_ld),
    )
    rows = _with_address(found)

    def pick(name: str) -> Column:
        if name == "titulo":
            return F.when(from_ld, F.coalesce("ld.titulo", "start")).otherwise(F.col("titulo"))
        if name in ("metragem", "quartos", "banheiros"):
            return F.col(name)
        return F.when(from_ld, F.col(f"ld.{name}")).otherwise(F.col(name))

    kept = rows.select(
        *rest, *[pick(c).alias(c) for c in FIELDS], F.col("url").alias("link"), "raw_text"
    )
    return kept.withColumns(
        {
            "fonte": urls.site_label(F.col("link")),
            "id": keys.listing_key(F.col("titulo"), F.col("preco"), F.col("link")),
        }
    )


def typed(listing_rows: DataFrame) -> DataFrame:
    """Add numeric columns, and the time if there is one, next to the texts they come from.

    The area is the page's own number where the extractor kept it (``area_m2``).
    """
    area = money.area_number(F.col("metragem"))
    if "area_m2" in listing_rows.columns:
        area = F.coalesce("area_m2", area)
    times = {"coletado_em": text.iso_time(F.col("data_coleta"))} if "data_coleta" in listing_rows.columns else {}
    return listing_rows.withColumns(
        {
            "preco_num": money.money_br(F.col("preco")),
            "metragem_num": area,
            "quartos_num": money.count_number(F.col("quartos")),
            "banheiros_num": money.count_number(F.col("banheiros")),
            **times,
        }
    )


def embedded_addresses(pages: DataFrame) -> DataFrame:
    """City, state and postal code from address keys anywhere in the page."""
    html = F.col("html")
    return pages.select(
        "page_id",
        jsons.embedded_city(html).alias("cidade"),
        jsons.embedded_region(html).alias("estado"),
        jsons.embedded_postal(html).alias("cep"),
    )


def requests_listings(pages: DataFrame) -> DataFrame:
    """Variant for plainly fetched pages: breadcrumb objects skipped, ``h1`` titles."""
    html = F.col("html")
    rest = _rest(pages)
    parsed = jsons.jsonld_listings(jsons.jsonld_plain_objects(html, C.SKIPPED_TYPES))
    hits = F.filter(
        parsed,
        lambda o: F.coalesce(o["titulo"], o["preco_oferta"], o["endereco"]).isNotNull(),
    )
    rows = _parsed(pages.filter("html <> ''"), F.get(hits, F.lit(0)))
    no_ld = F.col("ld").isNull()
    number = text.find(html, r"(?U)R\$\s*([\d.,]+)", 1)
    meta = text.find(html, r'(?U)<meta\s+name="description"\s+content="([^"]+)"', 1)
    found = computed(
        rows,
        [*rest, "url", "ld"],
        {
            "titulo": F.when(no_ld, text.find(html, C.HTML_H1_PLAIN, 1)),
            "preco": F.when(no_ld, F.concat(F.lit("R$ "), number)),
            "descricao": F.when(no_ld, meta),
            "cep": F.when(no_ld, text.cep_find(html, C.POSTAL_CODE_UNBOUNDED)),
            "contato": F.when(no_ld, text.collapse_ws(text.find(html, C.PHONE_PARENS))),
        },
    )
    return found.filter(~no_ld | any_field("titulo", "preco")).select(
        *rest,
        F.coalesce("ld.titulo", "titulo").alias("titulo"),
        F.coalesce("ld.preco_oferta", "preco").alias("preco"),
        F.coalesce("ld.descricao", "descricao").alias("descricao"),
        "ld.endereco", "ld.cidade", "ld.estado",
        F.coalesce("ld.cep", "cep").alias("cep"),
        F.coalesce("ld.contato_ponto", "contato").alias("contato"),
        F.col("url").alias("link"),
    )


def text_listings(texts: DataFrame) -> DataFrame:
    """Listings from plain text: price, area, rooms, first line as title, and key."""
    body = F.col("text")
    found = computed(
        texts,
        [c for c in texts.columns if c not in ("text", "url")],
        {
            "titulo": text.first_line(body),
            "preco": text.price_find(body),
            "metragem": text.area_find(body),
            "quartos": text.rooms_find(body),
            "link": F.col("url"),
        },
    )
    return found.filter(any_field("preco", "metragem", "titulo")).withColumn(
        "id", keys.text_key(F.col("titulo"), F.col("preco"), F.col("link"))
    )


def merged_ads(pages: DataFrame) -> DataFrame:
    """All JSON-LD objects of a page merged field by field, then page fallbacks.

    Price and address come from offer-like types only, title and description
    from any object; each field takes its first non-empty value in page order.
    The address label and the breadcrumb need the element tree, so only pages
    that still lack them and can hold either are sent to Python: the class and the
    relation of a breadcrumb are written in small letters, or by references.
    """
    html = F.col("html")
    rest = _rest(pages)
    merged = pages.withColumn("objects", jsons.jsonld_listings(jsons.jsonld_plain_objects(html)))

    def first_of(name: str, offers_only: bool) -> Column:
        def keep(o: Column) -> Column:
            ok = o[name].isNotNull()
            return ok & o["tipo"].isin(C.MERGED_TYPES) if offers_only else ok

        return F.get(F.filter("objects", keep), F.lit(0))[name]

    step = merged.select(
        *rest,
        "url",
        "html",
        F.coalesce(first_of("nome", False), text.document_title(html)).alias("titulo"),
        first_of("preco_oferta", True).alias("ld_preco"),
        F.coalesce(first_of("descricao", False), text.document_description(html)).alias("descricao"),
        first_of("endereco", True).alias("ld_endereco"),
        first_of("cidade", True).alias("ld_cidade"),
        first_of("estado", True).alias("estado"),
        first_of("cep", True).alias("ld_cep"),
    )
    body = text.visible_text(html)
    incomplete = (
        F.col("ld_endereco").isNull() | F.col("ld_cidade").isNull() | F.col("estado").isNull()
    ) & (
        html.contains("breadcrumb")
        | html.rlike("[bB](?iu:airro)")
        | (html.contains("&") & html.rlike("[bB](?iu:readcrumb)"))
    )
    # Text without its markup is made once, for pages that lack a price or postal code or show a phone number.
    wanted = F.col("ld_preco").isNull() | F.col("ld_cep").isNull() | html.rlike(r"(?U)\d{4,5}-\d{4}")
    kept = [c for c in step.columns if c != "html"]
    read = computed(step, kept, {"body": F.when(wanted, body), "sent": F.when(incomplete, html)})
    placed = read.withColumn("place", page_places(F.col("sent")))
    return placed.select(
        *rest,
        "titulo",
        F.coalesce("ld_preco", text.price_find(F.col("body"))).alias("preco"),
        "descricao",
        F.coalesce("ld_endereco", "place.label").alias("endereco"),
        F.coalesce("ld_cidade", "place.crumb").alias("cidade"),
        "estado",
        F.coalesce("ld_cep", text.cep_find(F.col("body"))).alias("cep"),
        text.collapse_ws(text.find(F.col("body"), C.PHONE_SHORT)).alias("contato"),
        F.col("url").alias("link"),
    )

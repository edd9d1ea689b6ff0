"""Queries on pages, texts and payloads: field finders, extractors, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.functions import jsons, keys, money, text, urls
from garimpo.operators import captures as cap
from garimpo.operators import cards, discover, extract
from garimpo.plans.corpus import derive
from garimpo.plans.registry import (
    CAPTURE_ADS,
    CAPTURE_NAMES,
    EX_FIELDS,
    EX_KEY,
    EXTRACTED,
    FOUND_AD_URLS,
    PLACED,
    WHOLE_ADS,
    big,
    col_list,
    register,
)
from garimpo.session import scratch_path
from garimpo.sources import readers
from garimpo.sources.listing_table import ListingTable
from garimpo.streaming import jobs

# ------------------------------------------------------------ scalar functions


def page_field(key: str, build, name: str, sql: str) -> None:
    """A finder over the rendered ad pages."""

    @register(key, ["ad_pages"], f"SELECT page_id, {sql} AS {name} FROM ad_pages")
    def query(spark: SparkSession, sf: str) -> DataFrame:
        pages = derive(spark, sf, "ad_pages")
        return pages.select("page_id", build(F.col("html")).alias(name))


def ad_field(key: str, build, name: str, sql: str) -> None:
    """A function of ad columns."""

    @register(key, ["ads"], f"SELECT list_id, {sql} AS {name} FROM ads")
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return derive(spark, sf, "ads").select("list_id", build().alias(name))


def found(pattern: str, group: int = 0) -> str:
    return f"nullif(regexp_extract(html, '{pattern}', {group}), '')"


page_field("fn_price_find", text.price_find, "preco", found(r"R\$\s*[\d.,]+"))
page_field("fn_area_find", text.area_find, "metragem", found(r"(?i)(\d{2,4})\s*m[²2]", 1) + " || ' m²'")
page_field(
    "fn_rooms_find", text.rooms_find, "quartos", found(r"(?i)(\d+)\s*(?:quartos|quarto|qt|q)\b", 1) + " || ' Q'"
)
page_field(
    "fn_baths_find", text.baths_find, "banheiros", found(r"(?i)(\d+)\s*(?:banheiros?\b|b\.)", 1) + " || ' B'"
)
page_field("fn_cep_find", text.cep_find, "cep", found(r"\b\d{5}-\d{3}\b"))
page_field(
    "fn_html_title", text.html_title, "titulo",
    "coalesce(" + found("(?i)<title>(.*?)</title>", 1)
    + ", nullif(trim(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', '', 'g')), ''))",
)
page_field(
    "fn_meta_description", text.meta_description, "descricao",
    found("""(?i)<meta\\s+name=["'']description["'']\\s+content=["'']([^"'']+)["'']""", 1),
)


page_field(
    "fn_phone_find", text.phone_find, "contato",
    "coalesce(" + found(r"\(?\d{2,3}\)?\s*\d{4,5}-\d{4}") + ", " + found(r"""(?i)href=["'']tel:(\+?[0-9\-\(\)\s]+)["'']""", 1)
    + ", " + found(r"""(?i)data-phone=["'']([^"'']+)["'']""", 1) + ")",
)


@register(
    "fn_address_line", ["ad_pages"],
    r"""SELECT page_id, nullif(trim(regexp_extract(html, p, 1)), '') AS endereco,
        nullif(trim(regexp_extract(html, p, 2)), '') AS cidade, nullif(regexp_extract(html, p, 3), '') AS estado
        FROM ad_pages, (SELECT '([A-Za-z0-9\s.,\-]+\b),\s*([A-Za-z\s]+)\s*-\s*([A-Z]{2})' AS p)""",
)
def fn_address_line(spark: SparkSession, sf: str) -> DataFrame:
    pages = derive(spark, sf, "ad_pages")
    matched = pages.select("page_id", text.address_match(F.col("html")).alias("m"))
    return matched.select("page_id", text.address_line(F.col("m")).alias("a")).select("page_id", "a.*")


@register("fn_collapse_ws", None, r"SELECT doc_id, regexp_replace(text, '\s+', ' ', 'g') AS text FROM documents")
def fn_collapse_ws(spark: SparkSession, sf: str) -> DataFrame:
    documents = readers.table(spark, sf, "documents")
    return documents.select("doc_id", text.collapse_ws(F.col("text")).alias("text"))


@register(
    "fn_first_line", None,
    """SELECT doc_id, substr(trim(list_filter(string_split(text, chr(10)), lambda l: trim(l) <> '')[1]), 1, 150) AS titulo
       FROM documents""",
)
def fn_first_line(spark: SparkSession, sf: str) -> DataFrame:
    documents = readers.table(spark, sf, "documents")
    return documents.select("doc_id", text.first_line(F.col("text")).alias("titulo"))


VISIBLE = (
    r"regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g')"
)
for entity, char in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]:
    VISIBLE = f"replace({VISIBLE}, '{entity}', '{char}')"


@register("fn_visible_text", None, rf"SELECT page_id, trim(regexp_replace({VISIBLE}, '\s+', ' ', 'g')) AS text FROM pages")
def fn_visible_text(spark: SparkSession, sf: str) -> DataFrame:
    return readers.pages(spark, sf).select("page_id", text.visible_text(F.col("html")).alias("text"))


ad_field(
    "fn_default", lambda: text.default(F.col("preco"), C.PRICE_ON_REQUEST), "preco",
    "coalesce(nullif(preco, ''), 'Sob consulta')",
)
ad_field("fn_money_br", lambda: money.money_br(F.col("preco")).cast("double"), "valor", "CAST(valor AS DOUBLE)")
ad_field(
    "fn_money_naive", lambda: money.money_naive(F.col("preco")), "valor",
    r"""CASE WHEN preco IS NOT NULL THEN coalesce(try_cast(nullif(regexp_extract(replace(preco, 'R$ ', ''),
    '^\s*([+-]?\d+(?:\.\d+)?)', 1), '') AS DOUBLE), 0.0) END""",
)
ad_field(
    "fn_price_format",
    lambda: money.price_label(F.coalesce(F.col("valor").cast("string"), "preco"), F.col("valor").isNull()),
    "preco", "coalesce('R$ ' || valor, preco)",
)
ad_field("fn_url_native_id", lambda: urls.native_id(F.col("link")), "ad_id",
         "CASE WHEN link IS NOT NULL THEN CAST(list_id AS VARCHAR) END")
ad_field("fn_slug_url", lambda: urls.city_search_url("www.vivareal.com.br", F.col("cidade")), "url",
         "'https://www.vivareal.com.br/venda/apartamentos/' || replace(lower(cidade), ' ', '-') || '-pr/'")
ad_field(
    "fn_time_parse", lambda: text.iso_time(F.col("data_coleta")), "coletado_em",
    "try_cast(data_coleta AS TIMESTAMP)",
)


@register(
    "fn_md5_key", ["ads"],
    """SELECT list_id, id AS listing_key, md5(coalesce(titulo, '') || coalesce(preco, '') || coalesce(link, '')) AS text_key,
       md5(coalesce(titulo, 'None') || coalesce(preco, 'None') || coalesce(link, 'pagina')) AS card_key,
       md5(coalesce(titulo, 'None') || coalesce(preco, 'None')) AS offer_key,
       md5(CAST(list_id AS VARCHAR)) AS api_key, md5(link) AS link_key FROM ads""",
)
def fn_md5_key(spark: SparkSession, sf: str) -> DataFrame:
    titulo, preco, link = F.col("titulo"), F.col("preco"), F.col("link")
    return derive(spark, sf, "ads").select(
        "list_id",
        keys.listing_key(titulo, preco, link).alias("listing_key"),
        keys.text_key(titulo, preco, link).alias("text_key"),
        keys.card_key(titulo, preco, link, F.lit("pagina")).alias("card_key"),
        keys.offer_key(titulo, preco).alias("offer_key"),
        keys.api_key(F.col("list_id")).alias("api_key"),
        keys.link_key(link).alias("link_key"),
    )


@register("fn_strip_query", None, "SELECT page_id, split_part(url, '?', 1) AS url FROM pages")
def fn_strip_query(spark: SparkSession, sf: str) -> DataFrame:
    return readers.table(spark, sf, "pages").select("page_id", urls.strip_query(F.col("url")).alias("url"))


@register(
    "fn_url_absolute", None,
    r"""SELECT page_id, pos, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.\-]*:') THEN href
          WHEN href LIKE '//%' THEN regexp_extract(url, '^([a-z]+):', 1) || ':' || href
          WHEN href LIKE '/%' THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || href
          WHEN href LIKE '#%' THEN regexp_replace(url, '#.*$', '') || href
          WHEN href LIKE '?%' THEN regexp_replace(url, '[?#].*$', '') || href
          ELSE regexp_extract(regexp_replace(url, '[?#].*$', ''), '^(.*/)', 1) || href END AS link
        FROM (SELECT page_id, url, unnest(range(len(h))) AS pos, replace(unnest(h), '&amp;', '&') AS href FROM (SELECT page_id, url,
          regexp_extract_all(html, '(?i)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']+)["'']', 1) AS h FROM pages))""",
)
def fn_url_absolute(spark: SparkSession, sf: str) -> DataFrame:
    hrefs = discover.hrefs(readers.pages(spark, sf))
    return hrefs.select("page_id", *big("pos"), urls.resolve(F.col("href"), F.col("base")).alias("link"))


@register(
    "fn_url_unwrap_redirect", ["redirects"],
    "SELECT list_id, CASE WHEN list_id % 5 <> 4 THEN target END AS link FROM redirects",
)
def fn_url_unwrap_redirect(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spark, sf, "redirects").select("list_id", urls.unwrap_redirect(F.col("href")).alias("link"))


@register(
    "fn_url_unwrap_google", ["redirects"],
    "SELECT list_id, CASE WHEN list_id % 3 <> 0 THEN target END AS link FROM redirects",
)
def fn_url_unwrap_google(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spark, sf, "redirects").select("list_id", urls.unwrap_result_link(F.col("result_href")).alias("link"))


@register(
    "fn_search_query_encode", ["keywords"],
    "SELECT kw_id, 'https://www.bing.com/search?q=' || url_encode(keyword) AS url FROM keywords",
)
def fn_search_query_encode(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spark, sf, "keywords").select("kw_id", urls.search_url(F.col("keyword")).alias("url"))


@register(
    "fn_page_url", None,
    """SELECT url AS start_url, CAST(n AS BIGINT) AS page,
       url || CASE WHEN contains(url, '?') THEN '&page=' ELSE '?page=' END || n AS page_url
       FROM pages, (SELECT unnest(range(1, 4)) AS n)""",
)
def fn_page_url(spark: SparkSession, sf: str) -> DataFrame:
    starts = readers.table(spark, sf, "pages").select(F.col("url").alias("start_url"))
    return discover.page_urls(starts, 3).select("start_url", *big("page"), "page_url")


@register(
    "fn_case", ["keywords"],
    f"""SELECT keyword, array_to_string(list_transform(string_split(cidade, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS cidade,
        lower(estado) AS estado, upper(tipo) AS tipo FROM {PLACED}""",
)
def fn_case(spark: SparkSession, sf: str) -> DataFrame:
    placed = discover.keyword_places(derive(spark, sf, "keywords").select("keyword"))
    return placed.select(
        "keyword", text.title_case(F.col("cidade")).alias("cidade"),
        F.lower("estado").alias("estado"), F.upper("tipo").alias("tipo"),
    )


@register("fn_time_stamp", None, "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS data_coleta FROM events")
def fn_time_stamp(spark: SparkSession, sf: str) -> DataFrame:
    events = readers.table(spark, sf, "events")
    return events.select("event_id", text.prefix(F.col("ts").cast("string"), 19).alias("data_coleta"))


@register(
    "fn_json_get", None,
    """SELECT event_id, nullif(json_extract_string(props, '$.k'), '') AS k,
       coalesce(json_extract_string(props, '$.missing.name'), 'N/A') AS name FROM events""",
)
def fn_json_get(spark: SparkSession, sf: str) -> DataFrame:
    props = F.col("props")
    name = text.default(jsons.field(props, "missing.name"), C.NOT_AVAILABLE)
    return readers.table(spark, sf, "events").select("event_id", jsons.field(props, "k").alias("k"), name.alias("name"))


@register(
    "fn_json_cursor", None,
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN nullif(json_extract_string(props, '$.k'), '0')
         WHEN 1 THEN 'https://api.example.com/ads?page=' || event_id END AS token FROM events""",
)
def fn_json_cursor(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("event_id").cast("string")
    answers = readers.table(spark, sf, "events").select(
        "event_id",
        F.when(
            F.col("event_id") % 3 == 0, F.replace("props", F.lit('"k"'), F.lit('"next": "", "endCursor"'))
        ).otherwise("{}").alias("body"),
        F.when(
            F.col("event_id") % 3 == 1,
            F.concat(F.lit("<https://api.example.com/ads?page="), number, F.lit('>; rel="next"')),
        ).alias("link_header"),
    )
    return answers.select("event_id", jsons.page_cursor(F.col("body"), F.col("link_header")).alias("token"))


# ------------------------------------------------------------------- extractors


@register(
    "ex_jsonld_blocks", ["ads"],
    """SELECT list_id AS page_id, CAST(n AS BIGINT) AS pos,
         CASE WHEN list_id % 4 = 0 THEN 'Apartment' WHEN n = 0 THEN 'BreadcrumbList' ELSE 'Product' END AS tipo,
         CASE WHEN list_id % 4 = 0 OR n = 1 THEN titulo END AS titulo
       FROM ads, (SELECT unnest(range(2)) AS n)
       WHERE list_id % 4 = 1 OR (list_id % 4 = 0 AND n = 0)""",
)
def ex_jsonld_blocks(spark: SparkSession, sf: str) -> DataFrame:
    rows = extract.jsonld_rows(derive(spark, sf, "ad_pages"))
    return rows.select("page_id", *big("pos"), "tipo", "titulo")


@register(
    "ex_jsonld_listing", ["ads", "ad_pages"],
    f"SELECT page_id, {col_list(EX_FIELDS)} FROM {EXTRACTED} WHERE layout < 2",
)
def ex_jsonld_listing(spark: SparkSession, sf: str) -> DataFrame:
    return extract.jsonld_listings(derive(spark, sf, "ad_pages"))


@register(
    "ex_regex_listing", ["ads", "ad_pages"],
    r"""SELECT page_id, titulo, preco, metragem, quartos, banheiros, descricao, endereco, coalesce(cidade_json, cidade) AS cidade,
      coalesce(estado_json, estado) AS estado, cep, contato, link, metragem_num, quartos_num, banheiros_num,
      CAST(try_cast(replace(replace(rtrim(regexp_replace(preco, 'R\$\s*', ''), '.,'), '.', ''), ',', '.') AS DECIMAL(18, 2)) AS DOUBLE) AS preco_num
      FROM (
      SELECT page_id, url AS link, coalesce(nullif(regexp_extract(html, '(?i)<title>(.*?)</title>', 1), ''),
        nullif(trim(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', '', 'g')), '')) AS titulo,
        nullif(regexp_extract(html, 'R\$\s*[\d.,]+'), '') AS preco,
        nullif(regexp_extract(html, '(?i)(\d{2,4})\s*m[²2]', 1), '') || ' m²' AS metragem,
        nullif(regexp_extract(html, '(?i)(\d+)\s*(?:quartos|quarto|qt|q)\b', 1), '') || ' Q' AS quartos,
        nullif(regexp_extract(html, '(?i)(\d+)\s*(?:banheiros?\b|b\.)', 1), '') || ' B' AS banheiros,
        coalesce(nullif(regexp_extract(html, '\(?\d{2,3}\)?\s*\d{4,5}-\d{4}'), ''),
          nullif(regexp_extract(html, '(?i)href=["'']tel:(\+?[0-9\-\(\)\s]+)["'']', 1), ''),
          nullif(regexp_extract(html, '(?i)data-phone=["'']([^"'']+)["'']', 1), '')) AS contato,
        nullif(regexp_extract(html, '(?i)<meta\s+name=["'']description["'']\s+content=["'']([^"'']+)["'']', 1), '') AS descricao,
        nullif(trim(regexp_extract(html, p, 1)), '') AS endereco, nullif(trim(regexp_extract(html, p, 2)), '') AS cidade,
        nullif(regexp_extract(html, p, 3), '') AS estado,
        nullif(regexp_extract(html, '"addressLocality"\s*:\s*"([^"]{2,100})"', 1), '') AS cidade_json,
        nullif(regexp_extract(html, '"addressRegion"\s*:\s*"([A-Z]{2})"', 1), '') AS estado_json,
        coalesce(nullif(regexp_extract(html, '"postalCode"\s*:\s*"(\d{5}-\d{3})"', 1), ''),
          nullif(regexp_extract(html, '\b\d{5}-\d{3}\b'), '')) AS cep,
        CAST(nullif(regexp_extract(html, '(?i)(\d{2,6})\s*m[²2]', 1), '') AS BIGINT) AS metragem_num,
        CAST(nullif(regexp_extract(html, '(?i)(\d+)\s*(?:quartos|quarto|qt|q)\b', 1), '') AS BIGINT) AS quartos_num,
        CAST(nullif(regexp_extract(html, '(?i)(\d+)\s*(?:banheiros?\b|b\.)', 1), '') AS BIGINT) AS banheiros_num
      FROM ad_pages, (SELECT '([A-Za-z0-9\s.,\-]+\b),\s*([A-Za-z\s]+)\s*-\s*([A-Z]{2})' AS p)
      WHERE length(html) >= 100) WHERE titulo IS NOT NULL OR preco IS NOT NULL OR metragem IS NOT NULL""",
)
def ex_regex_listing(spark: SparkSession, sf: str) -> DataFrame:
    rows = extract.typed(extract.regex_listings(derive(spark, sf, "ad_pages")))
    numbers = big("metragem_num", "quartos_num", "banheiros_num")
    return rows.select("page_id", *EX_FIELDS, *numbers, F.col("preco_num").cast("double").alias("preco_num"))


@register(
    "ex_listing", ["ads", "ad_pages"],
    f"SELECT page_id, {EX_KEY} AS id, {col_list(EX_FIELDS)}, fonte FROM {EXTRACTED}",
)
def ex_listing(spark: SparkSession, sf: str) -> DataFrame:
    rows = extract.listings(derive(spark, sf, "ad_pages"))
    return rows.select("page_id", "id", *EX_FIELDS, "fonte")


@register(
    "ex_embedded_address", ["ads"],
    """SELECT list_id AS page_id, CASE WHEN list_id % 4 < 2 THEN cidade END AS cidade,
       CASE WHEN list_id % 4 < 2 AND estado = upper(estado) THEN estado END AS estado,
       CASE WHEN list_id % 4 < 2 THEN cep END AS cep FROM ads""",
)
def ex_embedded_address(spark: SparkSession, sf: str) -> DataFrame:
    return extract.embedded_addresses(derive(spark, sf, "ad_pages"))


@register(
    "ex_ad_page_merge", ["ads", "ad_pages"],
    r"""SELECT a.list_id AS page_id,
        CASE a.list_id % 4 WHEN 0 THEN titulo WHEN 1 THEN NULL WHEN 2 THEN titulo
          ELSE CASE a.list_id % 20 WHEN 7 THEN NULL WHEN 11 THEN 'Busca' ELSE 'Just a moment...' END END AS titulo,
        CASE a.list_id % 4 WHEN 2 THEN CASE WHEN valor IS NOT NULL
          THEN CASE WHEN a.list_id % 12 = 6 THEN replace(preco, 'R$ ', 'R$') ELSE preco END || ',' END END AS preco,
        CASE a.list_id % 4 WHEN 0 THEN resumo WHEN 2 THEN resumo || CASE WHEN a.list_id % 12 = 6 THEN ' d''agua' ELSE '' END END AS descricao,
        CASE a.list_id % 4 WHEN 0 THEN endereco END AS endereco, CASE a.list_id % 4 WHEN 0 THEN cidade END AS cidade,
        CASE a.list_id % 4 WHEN 0 THEN estado END AS estado,
        CASE WHEN a.list_id % 4 IN (0, 2) THEN cep END AS cep,
        CASE WHEN a.list_id % 4 = 2 THEN contato END AS contato, p.url AS link
        FROM ads a JOIN ad_pages p ON a.list_id = p.page_id WHERE a.list_id % 4 > 0
        UNION ALL
        SELECT a.list_id, titulo, CASE WHEN valor IS NOT NULL THEN 'R$ ' || valor WHEN preco = 'Sob consulta' THEN preco END,
        resumo, endereco, cidade, estado, cep, NULL, p.url
        FROM ads a JOIN ad_pages p ON a.list_id = p.page_id WHERE a.list_id % 4 = 0""",
)
def ex_ad_page_merge(spark: SparkSession, sf: str) -> DataFrame:
    return extract.merged_ads(derive(spark, sf, "ad_pages"))


@register(
    "ex_requests_listing", ["ads", "ad_pages"],
    r"""SELECT * FROM (
        SELECT list_id AS page_id, titulo,
          CASE WHEN valor IS NOT NULL THEN 'R$ ' || valor WHEN preco = 'Sob consulta' THEN preco END AS preco, resumo AS descricao,
          endereco, cidade, estado, cep, CAST(NULL AS VARCHAR) AS contato, url AS link
        FROM ads JOIN ad_pages ON list_id = page_id WHERE list_id % 4 = 0
        UNION ALL
        SELECT list_id, NULL, 'R$ ' || nullif(regexp_extract(html, 'R\$\s*([\d.,]+)', 1), ''),
          nullif(regexp_extract(html, '<meta\s+name="description"\s+content="([^"]+)"', 1), ''), NULL, NULL, NULL,
          nullif(regexp_extract(html, '\d{5}-\d{3}'), ''), nullif(regexp_extract(html, '\(\d{2}\)\s*\d{4,5}-\d{4}'), ''), url
        FROM ads JOIN ad_pages ON list_id = page_id WHERE list_id % 4 > 0
      ) WHERE titulo IS NOT NULL OR preco IS NOT NULL OR endereco IS NOT NULL""",
)
def ex_requests_listing(spark: SparkSession, sf: str) -> DataFrame:
    rows = extract.requests_listings(derive(spark, sf, "ad_pages"))
    return rows.select("page_id", "titulo", "preco", "descricao", "endereco", "cidade", "estado", "cep", "contato", "link")


@register(
    "ex_text_listing", ["ads"],
    """SELECT *, md5(titulo || coalesce(preco, '') || coalesce(link, '')) AS id FROM (
       SELECT list_id, coalesce(titulo, nullif(preco, '') || ',', metragem || ' com ' || replace(quartos, 'Q', 'quartos')) AS titulo,
         CASE WHEN valor IS NOT NULL THEN preco || ',' END AS preco, replace(metragem, '12000', '2000') AS metragem, quartos, link FROM ads)""",
)
def ex_text_listing(spark: SparkSession, sf: str) -> DataFrame:
    return extract.text_listings(derive(spark, sf, "ad_texts"))


def card_page(list_column: str, per_page: int) -> str:
    return f"{list_column} // {per_page} AS page_id, {list_column} % {per_page} AS pos"


OFFER_KEY = "md5(coalesce(titulo, 'None') || coalesce(preco, 'None'))"


@register(
    "ex_cards_imovelweb", ["ads"],
    f"""SELECT page_id, pos, titulo, preco, metragem, bairro, descricao, link,
        md5(titulo || preco || coalesce(link, 'https://www.imovelweb.com.br/busca/' || page_id)) AS id FROM (
        SELECT {card_page('list_id', 12)}, titulo, CASE WHEN valor IS NOT NULL THEN preco END AS preco, metragem,
          coalesce(cidade, '') AS bairro,
          substr(titulo || ' ' || coalesce(cidade || ' ', '') || coalesce(preco || ' ', '') || '- ' || metragem
            || CASE WHEN list_id % 3 = 0 THEN '' ELSE ' ver' END, 1, 150) AS descricao,
          CASE WHEN list_id % 3 = 0 THEN NULL ELSE 'https://www.imovelweb.com.br/vi/' || list_id END AS link
        FROM ads) WHERE titulo IS NOT NULL AND preco IS NOT NULL""",
)
def ex_cards_imovelweb(spark: SparkSession, sf: str) -> DataFrame:
    found_cards = cards.portal_cards(derive(spark, sf, "card_pages_portal"))
    return found_cards.select(
        "page_id", *big("pos"), "titulo", "preco", "metragem", "bairro", "descricao", "link", "id"
    )


@register(
    "ex_cards_generic", ["ads"],
    f"""SELECT 'a' AS site, page_id, pos, {OFFER_KEY} AS id, titulo, preco, metragem, quartos, banheiros, link FROM (
          SELECT {card_page('list_id', 24)}, coalesce(titulo, nullif(preco, ''), metragem || ' ' || replace(quartos, 'Q', 'quartos')
              || ' ' || replace(banheiros, 'B', 'banheiros')) AS titulo,
            coalesce(CASE WHEN valor IS NOT NULL THEN preco END, 'Sob consulta') AS preco, metragem, quartos, banheiros,
            'https://www.imovelweb.com.br/vi/' || list_id AS link FROM ads)
        UNION ALL
        SELECT 'b', page_id, pos, {OFFER_KEY}, titulo, preco, metragem, quartos, NULL, NULL FROM (
          SELECT {card_page('list_id', 24)}, coalesce(titulo, nullif(preco, ''), metragem || ' ' || replace(quartos, 'Q', 'quartos')) AS titulo,
            coalesce(CASE WHEN valor IS NOT NULL THEN preco END, 'Sob consulta') AS preco, metragem, quartos FROM ads)""",
)
def ex_cards_generic(spark: SparkSession, sf: str) -> DataFrame:
    a = cards.browser_cards_a(derive(spark, sf, "card_pages_browser_a")).withColumn("site", F.lit("a"))
    b = cards.browser_cards_b(derive(spark, sf, "card_pages_browser_b")).withColumn("site", F.lit("b"))
    both = a.unionByName(b, allowMissingColumns=True)
    return both.select(
        "site", "page_id", *big("pos"), "id", "titulo", "preco", "metragem", "quartos", "banheiros", "link"
    )


@register(
    "ex_cards_article", ["ads"],
    f"""SELECT fonte, page_id, pos, {OFFER_KEY} AS id, titulo, preco, metragem, link FROM (
        SELECT unnest(['ImóvelVirtual', 'VivaReal']) AS fonte, {card_page('list_id', 12)}, titulo, nullif(preco, '') AS preco,
          metragem, 'https://www.imovelweb.com.br/imovel/' || list_id AS link FROM ads)
        WHERE titulo IS NOT NULL AND preco IS NOT NULL""",
)
def ex_cards_article(spark: SparkSession, sf: str) -> DataFrame:
    article = cards.offer_cards(derive(spark, sf, "card_pages_article"), cards.ARTICLE)
    anchor = cards.offer_cards(derive(spark, sf, "card_pages_anchor"), cards.ANCHOR)
    return article.unionByName(anchor).select(
        "fonte", "page_id", *big("pos"), "id", "titulo", "preco", "metragem", "link"
    )


@register(
    "ex_cards_bank", ["ads"],
    f"""SELECT {card_page('list_id', 12)}, titulo, endereco, cidade, preco AS valor,
        'https://venda-imoveis.caixa.gov.br/sistema/detalhe.asp?id=' || list_id AS link, 'Caixa' AS fonte FROM ads
        WHERE titulo IS NOT NULL AND endereco IS NOT NULL AND cidade IS NOT NULL AND preco IS NOT NULL""",
)
def ex_cards_bank(spark: SparkSession, sf: str) -> DataFrame:
    rows = cards.bank_cards(derive(spark, sf, "card_pages_bank"))
    return rows.select("page_id", *big("pos"), "titulo", "endereco", "cidade", "valor", "link", "fonte")


@register(
    "ex_anchors", ["ads"],
    """SELECT list_id // 25 AS page_id, list_id % 25 AS pos, host AS domain,
       'https://www.' || host || '/vi/' || list_id AS link FROM ads
       WHERE list_id % 4 <> 3 AND host <> 'anuncios.example.com'""",
)
def ex_anchors(spark: SparkSession, sf: str) -> DataFrame:
    links = discover.result_links(derive(spark, sf, "result_pages"))
    return links.select("page_id", *big("pos"), "domain", "link")


@register(
    "ex_listing_links", ["ads"],
    """SELECT page_id, CASE kind WHEN 1 THEN 'https://www.olx.com.br/imoveis/anuncio-' || list_id
         WHEN 2 THEN 'https://pr.olx.com.br/regiao-metropolitana/vi/' || list_id
         WHEN 5 THEN host || CASE WHEN page_id % 3 = 0 THEN '/x' ELSE '' END || '/venda/' || list_id
         WHEN 6 THEN host || CASE WHEN page_id % 3 = 0 THEN '/x/y' ELSE '/imoveis' END || '/aluguel/' || list_id
         ELSE host || '/imoveis/c/' || list_id || '#fotos' END AS link
       FROM (SELECT list_id, list_id % 8 AS kind, list_id // 20 AS page_id,
           CASE WHEN list_id // 20 % 3 = 0 THEN 'https://pr.olx.com.br' ELSE 'https://www.olx.com.br' END AS host FROM ads)
       WHERE kind IN (1, 2, 5, 6, 7)""",
)
def ex_listing_links(spark: SparkSession, sf: str) -> DataFrame:
    return discover.ad_links(derive(spark, sf, "listing_pages"))


@register(
    "ex_state_links", ["ads"],
    """SELECT DISTINCT list_id // 20 AS page_id,
       'https://www.olx.com.br/d/' || (list_id % 7 + list_id - list_id % 20) AS link FROM ads
       UNION ALL SELECT DISTINCT list_id // 20, 'https://www.olx.com.br/s/' || (list_id // 20) FROM ads""",
)
def ex_state_links(spark: SparkSession, sf: str) -> DataFrame:
    return discover.state_links(derive(spark, sf, "listing_pages"))


@register(
    "ex_json_prefix", ["captures"],
    """SELECT entry_id, CASE WHEN entry_id % 3 = 0 THEN 'urls' ELSE 'array' END AS kind,
       CAST(length(trim(text)) AS BIGINT) AS body_chars FROM captures""",
)
def ex_json_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return cap.payload_kinds(derive(spark, sf, "captures"))


@register(
    "ex_truncated_array", ["ads", "captures"],
    f"""SELECT entry_id, CAST(list_id AS VARCHAR) AS list_id, link AS ad_url, nullif(preco, '') AS preco, titulo, cidade, estado
        FROM {WHOLE_ADS} UNION ALL
        SELECT entry_id, NULL, NULL, NULL, NULL, NULL, NULL FROM captures WHERE entry_id % 2 = 0""",
)
def ex_truncated_array(spark: SparkSession, sf: str) -> DataFrame:
    return cap.salvaged_ads(derive(spark, sf, "captures"))


@register("ex_ad_urls", ["ads", "captures"], f"SELECT entry_id, pos, url FROM {FOUND_AD_URLS}")
def ex_ad_urls(spark: SparkSession, sf: str) -> DataFrame:
    return cap.ad_links(derive(spark, sf, "captures")).select("entry_id", *big("pos"), "url")


@register("ex_capture_ads", ["captures"], f"SELECT entry_id, pos, {col_list(CAPTURE_NAMES)} FROM {CAPTURE_ADS}")
def ex_capture_ads(spark: SparkSession, sf: str) -> DataFrame:
    rows = cap.ads_by_pattern(derive(spark, sf, "captures"))
    return rows.select("entry_id", *big("pos"), *CAPTURE_NAMES)


@register(
    "ex_nested_content", ["ads"],
    "SELECT list_id // 20 AS entry_id, coalesce(link, 'sem-link') AS ad_url, list_id FROM ads",
)
def ex_nested_content(spark: SparkSession, sf: str) -> DataFrame:
    return cap.nested_ads(derive(spark, sf, "nested_captures"))


TITLED = "array_to_string(list_transform(string_split({}, ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


@register(
    "ex_keyword_listing", ["keywords"],
    f"""SELECT md5(tipo || cidade) AS id, {TITLED.format('tipo')} || ' em ' || {TITLED.format('cidade')} || ' - Resultado de Busca' AS titulo,
        'Sob Consulta' AS preco, 'Variado' AS metragem, {TITLED.format('cidade')} AS cidade, estado,
        'Imóvel tipo ' || tipo || ' localizado em ' || cidade || ', ' || estado || '. Resultado da busca por ''' || keyword || '''' AS descricao,
        'https://www.busca-imovel.com.br/' || tipo || '/' || cidade || '/' || estado AS link,
        keyword AS palavras_chave, 'Busca por Palavras-Chave' AS fonte FROM {PLACED}""",
)
def ex_keyword_listing(spark: SparkSession, sf: str) -> DataFrame:
    return discover.keyword_listings(derive(spark, sf, "keywords").select("keyword"))


# --------------------------------------------------------------------- streams

VERSION_ORDER = ["seq", "preco"]


@register(
    "st_capture_ingest", ["ads", "captures"],
    f"""SELECT entry_id, CAST(list_id AS VARCHAR) AS list_id, link AS ad_url, nullif(preco, '') AS preco, titulo
        FROM {WHOLE_ADS} WHERE status = 200 UNION ALL
        SELECT entry_id, NULL, NULL, NULL, NULL FROM captures WHERE entry_id % 2 = 0 AND status = 200""",
)
def st_capture_ingest(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "ingest")
    arrived = derive(spark, sf, "captures")
    stream = stored_stream(arrived, f"{base}/in")
    jobs.ingest_captures(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("entry_id", "list_id", "ad_url", "preco", "titulo")


def stored_stream(arrived: DataFrame, path: str, batches: int = 2) -> DataFrame:
    """The rows added to a folder, and the folder as a stream of about so many batches of new files."""
    spark = arrived.sparkSession
    arrived.write.mode("append").parquet(path)
    files = len(spark.read.schema(arrived.schema).parquet(path).inputFiles())
    return jobs.file_stream(spark, path, arrived.schema, files_per_batch=-(-files // batches))


def half_streams(arrived: DataFrame, base: str, half: str) -> list[DataFrame]:
    """The rows as two file streams of several batches, one for each of two runs of a job."""
    parts = (("first", arrived.filter(half)), ("second", arrived.filter(f"NOT ({half})")))
    return [stored_stream(rows, f"{base}/{part}") for part, rows in parts]


@register("st_link_first_seen", ["link_events"], "SELECT DISTINCT id, url, domain FROM link_events")
def st_link_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "first-seen")
    events = derive(spark, sf, "link_events")
    for i, stream in enumerate(half_streams(events, base, "event_id % 2 = 0")):
        jobs.first_seen_links(stream, f"{base}/out", f"{base}/checkpoint-{i}").awaitTermination()
    return spark.read.schema(jobs.SEEN_SCHEMA).parquet(f"{base}/out").select("id", "url", "domain")


@register(
    "st_listing_upsert", ["revisions"],
    """SELECT 'accepted' AS verdict, id, titulo, preco FROM (
         SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC, preco DESC) AS rn
         FROM revisions WHERE titulo IS NOT NULL) WHERE rn = 1
       UNION ALL SELECT 'rejected', id, titulo, preco FROM revisions WHERE titulo IS NULL""",
)
def st_listing_upsert(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "upsert")
    arrived = derive(spark, sf, "revisions").select("id", "titulo", "preco", "seq")
    table = ListingTable(spark, f"{base}/table", VERSION_ORDER)
    for i, stream in enumerate(half_streams(arrived, base, "seq % 2 = 0")):
        jobs.upsert_table(stream, table, f"{base}/checkpoint-{i}", f"{base}/rejects").awaitTermination()
    rejects = jobs.stored_batches(spark, f"{base}/rejects", arrived.schema)
    both = table.rows().withColumn("verdict", F.lit("accepted")).unionByName(rejects.withColumn("verdict", F.lit("rejected")), allowMissingColumns=True)
    return both.select("verdict", "id", "titulo", "preco")


@register(
    "st_queue_stats", ["link_events"],
    """SELECT status, count(*) AS n FROM (SELECT id, max_by(status, (ts, event_id)) AS status FROM link_events GROUP BY id)
       GROUP BY status""",
)
def st_queue_stats(spark: SparkSession, sf: str) -> DataFrame:
    """One job that is stopped and started again when more events have come."""
    base = scratch_path(spark, "progress")
    events = derive(spark, sf, "link_events").select("id", "ts", "event_id", "status")
    for half in ("event_id % 3 = 0", "event_id % 3 <> 0"):
        stream = stored_stream(events.filter(half), f"{base}/in")
        jobs.status_counts(stream, f"{base}/changes", f"{base}/checkpoint").awaitTermination()
    return jobs.status_totals(spark, f"{base}/changes")

"""Listing inputs derived from the given tables.

The tables hold no listings, so ads, pages, payloads and queue events are
derived from orders, customers, line items and events. Every input grows with
its table. The text is plain SQL that Spark and the checking engine both run;
only the few functions in ``Dialect`` are spelled differently.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.functions.steps import computed
from garimpo.sources.readers import table

GIVEN = {"revisions": ["lineitem"], "link_events": ["events"], "keywords": ["customer"]}
AD_TABLES = ["orders", "customer"]


class Dialect(NamedTuple):
    thousands: str
    days: str
    joined: str
    base64: str

    def points(self, x: str) -> str:
        return self.thousands.format(x)

    def join_rows(self, x: str, order: str) -> str:
        return self.joined.format(x, order)


SPARK = Dialect(
    thousands="translate(format_number({}, 0), ',', '.')",
    days="unix_date(CAST({} AS DATE))",
    joined="listagg({0}, '') WITHIN GROUP (ORDER BY {1})",
    base64="base64(CAST({} AS BINARY))",
)
DUCK = Dialect(
    thousands="translate(format('{{:,}}', {}), ',', '.')",
    days="(CAST({} AS DATE) - DATE '1970-01-01')",
    joined="string_agg({0}, '' ORDER BY {1})",
    base64="to_base64(encode({}))",
)

HOSTS = """CASE list_id % 6 WHEN 0 THEN 'vivareal.com.br' WHEN 1 THEN 'imovelweb.com.br'
  WHEN 2 THEN 'olx.com.br' WHEN 3 THEN 'zapimoveis.com.br' WHEN 4 THEN 'mercadolivre.com.br'
  ELSE 'anuncios.example.com' END"""


def txt(x: str) -> str:
    return f"CAST({x} AS STRING)"


def optional(*parts: str) -> str:
    """Concatenation that vanishes when a part is null."""
    return f"coalesce({' || '.join(parts)}, '')"


def div(x: str, n: int) -> str:
    """Whole division of a non-negative number."""
    return f"CAST(({x} - {x} % {n}) / {n} AS BIGINT)"


def ads(d: Dialect) -> str:
    """One ad per order, titled and placed by its customer."""
    return f"""
SELECT *, md5(coalesce(titulo, 'None') || coalesce(preco, 'None') || coalesce(link, 'None')) AS id
FROM (
  SELECT list_id, c AS cust, {d.days.format('ts')} * 10000000000000 + list_id AS seq, host,
    CASE WHEN list_id % 29 = 0 THEN NULL
         ELSE 'https://www.' || host || '/vi/' || {txt('list_id')} END AS link,
    CASE WHEN list_id % 31 = 0 THEN NULL
         ELSE 'Apartamento ' || seg || ' ' || {txt('c')} END AS titulo,
    CASE WHEN list_id % 7 = 0 THEN 'Sob consulta' WHEN list_id % 11 = 0 THEN NULL
         WHEN list_id % 13 = 0 THEN '' ELSE 'R$ ' || {d.points('total')} END AS preco,
    CASE WHEN list_id % 7 = 0 OR list_id % 11 = 0 OR list_id % 13 = 0 THEN NULL
         ELSE total END AS valor,
    CASE WHEN list_id % 41 = 0 THEN '12000' ELSE {txt('c % 400 + 20')} END || ' m²' AS metragem,
    {txt('c % 5 + 1')} || ' Q' AS quartos,
    {txt('c % 3 + 1')} || ' B' AS banheiros,
    CASE WHEN list_id % 17 = 0 THEN NULL
         ELSE 'Imóvel "' || lower(seg) || '", perto do centro' || chr(10) || 'codigo '
              || {txt('list_id')} END AS descricao,
    CASE WHEN list_id % 17 = 0 THEN NULL
         ELSE 'Imóvel ' || lower(seg) || ', perto do centro codigo ' || {txt('list_id')} END AS resumo,
    CASE WHEN list_id % 19 = 0 THEN NULL
         ELSE 'Rua ' || {txt('c')} || ' n ' || {txt('list_id % 900 + 1')} END AS endereco,
    CASE WHEN list_id % 23 = 0 THEN NULL ELSE
      CASE nk % 8 WHEN 0 THEN 'Curitiba' WHEN 1 THEN 'Sao Paulo' WHEN 2 THEN 'Belo Horizonte'
        WHEN 3 THEN 'Salvador' WHEN 4 THEN 'Brasilia' WHEN 5 THEN 'Rio' WHEN 6 THEN 'Recife'
        ELSE 'Fortaleza' END END AS cidade,
    CASE WHEN list_id % 23 = 0 THEN NULL WHEN list_id % 2 = 0 THEN uf ELSE lower(uf) END AS estado,
    CASE WHEN list_id % 5 = 0 THEN NULL
         ELSE lpad({txt('c % 100000')}, 5, '0') || '-' || lpad({txt('list_id % 1000')}, 3, '0') END AS cep,
    CASE WHEN list_id % 3 = 0 THEN NULL
         ELSE '(' || {txt('list_id % 90 + 10')} || ') 9' || lpad({txt('c % 10000')}, 4, '0') || '-'
              || lpad({txt('list_id % 10000')}, 4, '0') END AS contato,
    CASE WHEN list_id % 6 = 5 THEN NULL ELSE upper(split_part(host, '.', 1)) END AS fonte,
    CASE WHEN list_id % 37 = 0 THEN 'invalid' ELSE replace(substring({txt('ts')}, 1, 19), ' ', 'T') END AS data_coleta
  FROM (
    SELECT *, {HOSTS} AS host,
      CASE nk % 8 WHEN 0 THEN 'PR' WHEN 1 THEN 'SP' WHEN 2 THEN 'MG' WHEN 3 THEN 'BA'
        WHEN 4 THEN 'DF' WHEN 5 THEN 'RJ' WHEN 6 THEN 'PE' ELSE 'CE' END AS uf
    FROM (
      SELECT o.o_orderkey AS list_id, o.o_custkey AS c, o.o_orderdate AS ts,
        CAST(floor(o.o_totalprice) AS BIGINT) AS total,
        cu.c_mktsegment AS seg, cu.c_nationkey AS nk
      FROM orders o JOIN customer cu ON o.o_custkey = cu.c_custkey
    ) b
  ) h
) f"""


def revisions(d: Dialect) -> str:
    """One later version of an ad per line item, in the short listing layout."""
    return f"""
SELECT {txt('l_orderkey')} AS id,
  'https://www.olx.com.br/vi/' || {txt('l_orderkey')} AS link,
  CASE WHEN l_suppkey % 13 = 0 THEN NULL
       ELSE 'Apartamento revisado ' || {txt('l_partkey')} END AS titulo,
  'R$ ' || {d.points('CAST(floor(l_extendedprice) AS BIGINT)')} AS preco,
  'OLX' AS fonte,
  CAST(200000000000000000 AS BIGINT) + l_linenumber * CAST(1000000000000000 AS BIGINT)
    + l_partkey % 100000000 * 10000000 + l_suppkey % 10000000 AS seq
FROM lineitem"""


def link_events(d: Dialect) -> str:
    """Queue events: one per user event, on the link the user looked at."""
    return f"""
SELECT event_id, ts, url, md5(url) AS id, 'olx.com.br' AS domain, status
FROM (
  SELECT event_id, ts, 'https://www.olx.com.br/vi/' || {txt('user_id')} AS url,
    CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'error'
      WHEN 'click' THEN 'retry' ELSE 'pending' END AS status
  FROM events
) e"""


def keywords(d: Dialect) -> str:
    """One search keyword per customer, with accents and upper case."""
    return f"""
SELECT CASE c_custkey % 6 WHEN 0 THEN 'Apartamento' WHEN 1 THEN 'casa' WHEN 2 THEN 'studio'
    WHEN 3 THEN 'kitnet' WHEN 4 THEN 'imóvel' ELSE 'CASA' END
  || CASE c_nationkey % 9 WHEN 0 THEN ' em Curitiba ' WHEN 1 THEN ' São Paulo '
    WHEN 2 THEN ' belo horizonte ' WHEN 3 THEN ' Salvador ' WHEN 4 THEN ' Brasília '
    WHEN 5 THEN ' rio ' WHEN 6 THEN ' recife ' WHEN 7 THEN ' fortaleza ' ELSE ' centro ' END
  || {txt('c_custkey')} AS keyword, c_custkey AS kw_id
FROM customer"""


def _jsonld_common() -> str:
    return " || ".join(
        [
            "'\"address\":{'",
            optional("'\"streetAddress\":\"'", "endereco", "'\",'"),
            optional("'\"addressLocality\":\"'", "cidade", "'\",'"),
            optional("'\"addressRegion\":\"'", "estado", "'\",'"),
            optional("'\"postalCode\":\"'", "cep", "'\",'"),
            "'\"addressCountry\":\"BR\"},'",
            optional("'\"description\":\"'", "resumo", "'\",'"),
        ]
    )


def ad_pages(d: Dialect) -> str:
    """A page per ad in four layouts: JSON-LD object, JSON-LD list, text, challenge.

    Script types are written in all quotings. Of the text pages, one kind in three
    has its title over two lines and its description meta turned round, one an
    apostrophe in the description and no space in the price, one references for
    the currency sign, spaces and letters. Some challenge pages are short, some
    say that nothing was found.
    """
    script = (
        "CASE list_id % 12 WHEN 4 THEN '<script type=''application/ld+json''>'"
        " WHEN 8 THEN '<script async type=application/ld+json>' WHEN 9 THEN '<script type = \"application/ld+json\" id=x>'"
        " ELSE '<script type=\"application/ld+json\">' END"
    )
    layout_object = " || ".join(
        [
            "'<!DOCTYPE html><html lang=\"pt-BR\"><head><meta charset=\"utf-8\">'",
            script,
            "'{\"@type\":\"Apartment\",'",
            optional("'\"name\":\"'", "titulo", "'\",'"),
            f"CASE WHEN valor IS NOT NULL THEN '\"offers\":{{\"price\":' || {txt('valor')} || '}},'"
            " WHEN preco = 'Sob consulta' THEN '\"offers\":{\"price\":\"Sob consulta\"},' ELSE '' END",
            _jsonld_common(),
            optional("'\"telephone\":\"'", "contato", "'\",'"),
            "'\"sku\":1}</script></head><body><div class=\"anuncio\">'",
            optional("resumo"),
            "'</div></body></html>'",
        ]
    )
    layout_list = " || ".join(
        [
            "'<!DOCTYPE html><html lang=\"pt-BR\"><head><meta charset=\"utf-8\">'",
            script,
            "'{\"name\": quebrado</script>'",
            script,
            "'[{\"@type\":\"BreadcrumbList\",\"itemListElement\":[]},{\"@type\":\"Product\",'",
            optional("'\"headline\":\"'", "titulo", "'\",'"),
            optional("'\"offers\":{\"priceSpecification\":{\"price\":\"'", "nullif(preco, '')", "'\"}},'"),
            _jsonld_common(),
            optional("'\"contactPoint\":{\"telephone\":\"'", "contato", "'\"},'"),
            "'\"sku\":1}]</script></head><body><div class=\"anuncio\">'",
            optional("resumo"),
            "'</div></body></html>'",
        ]
    )
    layout_text = " || ".join(
        [
            "'<!DOCTYPE html><html lang=\"pt-BR\"><head>'",
            "CASE WHEN list_id % 12 = 2 THEN " + optional("'<title data-n=\"1\">' || chr(10)", "titulo", "chr(10) || '</title>'")
            + " ELSE " + optional("'<title>'", "titulo", "'</title>'") + " END",
            "CASE list_id % 12 WHEN 2 THEN " + optional("'<meta content=\"'", "resumo", "'\" name=description>'")
            + " WHEN 6 THEN " + optional("'<meta name=\"description\" content=\"'", "resumo", "' d''agua\">'")
            + " ELSE " + optional("'<meta name=\"description\" content=\"'", "resumo", "'\">'") + " END",
            "'</head><body>'",
            "CASE WHEN titulo IS NULL THEN '<h1 class=\"t\"><b>Sem</b> titulo</h1>' ELSE '' END",
            "'<p>'",
            "CASE list_id % 12 WHEN 6 THEN replace(" + optional("nullif(preco, '')", "', '") + ", 'R$ ', 'R$')"
            + " WHEN 10 THEN replace(replace(" + optional("nullif(preco, '')", "','") + ", '$', '&#36;'), ' ', '&#xA0;') || ' '"
            + " ELSE " + optional("nullif(preco, '')", "', '") + " END",
            "metragem",
            "' '",
            "replace(quartos, 'Q', 'quartos')",
            "' '",
            "replace(banheiros, 'B', 'banheiros')",
            "'</p>'",
            optional("'<p>'", "endereco", "', '", "cidade", "' - '", "upper(estado)", "'</p>'"),
            optional("'<p>CEP '", "cep", "'</p>'"),
            f"coalesce('<p>Tel ' || contato || '</p>', CASE WHEN list_id % 24 = 18 THEN '<span data-phone=\"11 9' || {txt('list_id')}"
            f" || '\">ligar</span>' ELSE '<a href=\"tel:+55-11-' || {txt('list_id')} || '\">ligar</a>' END)",
            "'</body></html>'",
        ]
    )
    challenge = (
        "'<!DOCTYPE html><html lang=\"en-US\"><head><title>Just a moment...</title></head><body>"
        "Verifying that you are human. This page will continue by itself in a moment.</body></html>'"
    )
    no_result = (
        "'<!DOCTYPE html><html lang=\"pt-BR\"><head><title>Busca</title></head><body>"
        "Não encontramos resultados para a busca. Tente de novo com outras palavras.</body></html>'"
    )
    return f"""
SELECT list_id AS page_id,
  coalesce(link, 'https://www.olx.com.br/sem-link/' || {txt('list_id')}) AS url,
  CASE list_id % 4 WHEN 0 THEN {layout_object} WHEN 1 THEN {layout_list} WHEN 2 THEN {layout_text}
    ELSE CASE list_id % 20 WHEN 7 THEN '<p>curta</p>' WHEN 11 THEN {no_result} ELSE {challenge} END END AS html
FROM ads"""


def ad_texts(d: Dialect) -> str:
    """Plain text of an ad: blank first line, title, price, size."""
    return f"""
SELECT list_id, link AS url,
  chr(10) || '  ' || {optional('titulo', 'chr(10)')} || {optional("nullif(preco, '')", "','", 'chr(10)')}
  || metragem || ' com ' || replace(quartos, 'Q', 'quartos') AS text
FROM ads"""


def _ad_json() -> str:
    return " || ".join(
        [
            "'{\"list_id\":'",
            txt("list_id"),
            "',\"images\":[{\"alt\":\"a {b]\"}]'",
            optional("',\"ad_url\":\"'", "link", "'\"'"),
            optional("',\"price\":\"'", "nullif(preco, '')", "'\"'"),
            optional("',\"subject\":\"'", "titulo", "'\"'"),
            optional("',\"municipality\":\"'", "cidade", "'\"'"),
            optional("',\"state_uf\":\"'", "estado", "'\"'"),
            "'}'",
        ]
    )


DEEP = 12


def group_element(entry: str) -> str:
    """A payload element that holds one ad URL, ``DEEP`` levels down."""
    return (
        "'{\"type\":\"GalleryGroup\",' || repeat('\"n\":{', " + str(DEEP) + ") || '\"ad_url\":\"https://www.olx.com.br/fundo/' || "
        + txt(entry) + " || '\"' || repeat('}', " + str(DEEP) + ") || '},'"
    )


def captures(d: Dialect) -> str:
    """Twenty ads per recorded response; some refused, some cut off in an ad.

    Every other one starts with a group element whose ad lies deep inside.
    """
    entry = div("list_id", 20)
    comma = "CASE WHEN list_id % 20 = 0 THEN '' ELSE ',' END"
    return f"""
SELECT entry_id, 'fetch' AS type,
  CASE entry_id % 4 WHEN 0 THEN 'https://www.example.com/x/' || {txt('entry_id')}
    ELSE 'https://APIgw.olx.com.br/ads?page=' || {txt('entry_id % 50')} END AS url,
  CAST('GET' AS STRING) AS method,
  CAST(CASE WHEN entry_id % 9 = 0 THEN 403 ELSE 200 END AS INT) AS status,
  CASE WHEN entry_id % 3 = 0 THEN substring(whole, 1, CAST(floor(length(whole) * 0.7) AS INT))
    ELSE whole END AS text
FROM (
  SELECT {entry} AS entry_id,
    '[' || CASE WHEN {entry} % 2 = 0 THEN {group_element(entry)} ELSE '' END
    || {d.join_rows(comma + ' || ' + _ad_json(), 'list_id')} || ']' AS whole
  FROM ads GROUP BY {entry}
) w"""


def nested_captures(d: Dialect) -> str:
    """Ads two ``content`` levels deep, twenty per response."""
    entry = div("list_id", 20)
    comma = "CASE WHEN list_id % 20 = 0 THEN '' ELSE ',' END"
    ad = f"""'{{"ad_url":"' || coalesce(link, 'sem-link') || '","list_id":' || {txt('list_id')} || '}}'"""
    return f"""
SELECT {entry} AS entry_id,
  '[{{"content":[{{"content":[' || {d.join_rows(comma + ' || ' + ad, 'list_id')} || ']}}]}}]' AS text
FROM ads GROUP BY {entry}"""


def bank_responses(d: Dialect) -> str:
    """Bank API answers: an ``imoveis`` array, or an error without one."""
    entry = div("list_id", 20)
    comma = "CASE WHEN list_id % 20 = 0 THEN '' ELSE ',' END"
    item = " || ".join(
        [
            "'{\"uf\":\"'", "coalesce(upper(estado), 'ND')", "'\",\"valorminimo\":\"'",
            "coalesce(preco, '')", "'\",\"urldetalhes\":\"detalhe?id='", txt("list_id"), "'\"'",
            optional("',\"cidade\":\"'", "cidade", "'\"'"),
            optional("',\"endereco\":\"'", "endereco", "'\"'"),
            "',\"areaprivativa\":\"'", "metragem", "'\"}'",
        ]
    )
    return f"""
SELECT {entry} AS entry_id,
  CASE WHEN {entry} % 5 = 0 THEN '{{"erro":"vazio"}}'
    ELSE '{{"imoveis":[' || {d.join_rows(comma + ' || ' + item, 'list_id')} || ']}}' END AS text
FROM ads GROUP BY {entry}"""


def listing_pages(d: Dialect) -> str:
    """Result pages of twenty anchors in eight styles, with embedded state objects.

    Markup a browser reads and a plain pattern does not: ``>`` and names of attributes in
    other values, dot segments, a base address on every third page, a second state object
    without a semicolon, braces and semicolons in strings.
    """
    entry = div("list_id", 20)
    number = txt("list_id")
    anchor = f"""CASE list_id % 8
      WHEN 0 THEN '<li><a href="/vi/' || {number} || '?lis=1">ver</a></li>'
      WHEN 1 THEN '<li><a class="c" data-href="#" href="https&#58;//www.olx.com.br/imoveis/anuncio-' || {number} || '?x=1&amp;y=2&copy=3">ver</a></li>'
      WHEN 2 THEN '<li><a href=https://pr.olx.com.br/regiao-metropolitana/vi/' || {number} || '><img src="i.jpg"></a></li>'
      WHEN 3 THEN '<li><a href="https://www.example.com/venda/' || {number} || '">ver</a></li>'
      WHEN 4 THEN '<li><a href="/ajuda/' || {number} || '">ver</a></li>'
      WHEN 5 THEN '<li><a title="a>b href=/venda/nao" href="../venda/' || {number} || '">ver</a></li>'
      WHEN 6 THEN '<li><a rel="x" data-nota="1 > 0" href=./aluguel/' || {number} || '>ver</a></li>'
      ELSE '<li><a href="/a/b/../../imoveis/./c/' || {number} || '#fotos">ver</a></li>' END"""
    comma = "CASE WHEN list_id % 20 = 0 THEN '' ELSE ',' END"
    slash = "CASE list_id % 3 WHEN 0 THEN '/' WHEN 1 THEN chr(92) || '/' ELSE chr(92) || 'u002F' END"
    state = (
        f"""'{{"url":"' || replace('https://www.olx.com.br/d/' || {txt('list_id % 7 + list_id - list_id % 20')} || '?x=1', '/', {slash}) || '"}}'"""
    )
    base = f"""CASE WHEN {entry} % 3 = 0 THEN '<head><base href="https://pr.olx.com.br/x/y/"></head>' ELSE '' END"""
    return f"""
SELECT {entry} AS page_id, 'https://www.olx.com.br/imoveis/estado-pr?o=' || {txt(entry)} AS url,
  '<html>' || {base} || '<body><ul><!-- <a href="https://www.olx.com.br/imoveis/antigo">x</a> -->' || {d.join_rows(anchor, 'list_id')}
  || '</ul><script>window.__PRELOADED_STATE__ = {{"nota":"fim }}; nao","ads":[' || {d.join_rows(comma + ' || ' + state, 'list_id')}
  || '],"cdn":"https://cdn.example.com/i","https://www.olx.com.br/chave":1}}; window.__SSR_STATE__={{"u":"https://www.olx.com.br/s/'
  || {txt(entry)} || '"}}</script></body></html>' AS html
FROM ads GROUP BY {entry}"""


def result_pages(d: Dialect) -> str:
    """Search result pages: direct links, two kinds of redirects, engine links."""
    entry = div("list_id", 25)
    number = txt("list_id")
    anchor = f"""CASE list_id % 4
      WHEN 0 THEN '<a href="https://www.' || host || '/vi/' || {number} || '?utm=1">r</a>'
      WHEN 1 THEN '<a href="' || replace('https://www.bing.com/ck/a?!&&p=x&u=a1https3A%2F%2Fwww.' || host || '%2Fvi%2F' || {number} || '&ntb=1',
        '&', CASE WHEN list_id % 8 = 1 THEN '&amp;' ELSE '&' END) || '">r</a>'
      WHEN 2 THEN '<a href="https://www.bing.com/rdr.asp?ref=https%3A%2F%2Fwww.' || host || '%2Fvi%2F' || {number} || '">r</a>'
      ELSE '<a href="https://www.bing.com/search?first=' || {number} || '">mais</a>' END"""
    return f"""
SELECT {entry} AS page_id, 'https://www.bing.com/search?q=' || {txt(entry)} AS url,
  '<html><body>' || {d.join_rows(anchor, 'list_id')} || '</body></html>' AS html
FROM ads GROUP BY {entry}"""


def redirects(d: Dialect) -> str:
    """One search-result href per ad and the target it stands for."""
    number = txt("list_id")
    direct = f"'https://www.' || host || '/vi/' || {number}"
    encoded = f"'https%3A%2F%2Fwww.' || host || '%2Fvi%2F' || {number}"
    return f"""
SELECT list_id, {direct} AS target,
  CASE list_id % 5 WHEN 0 THEN {direct}
    WHEN 1 THEN 'https://www.bing.com/ck/a?!&&p=x&u=a1https3A' || substring({encoded}, 9) || '&ntb=1'
    WHEN 2 THEN 'https://www.bing.com/rdr.asp?ref=' || {encoded}
    WHEN 3 THEN 'https://www.bing.com/ck/a?u=a1' || replace({d.base64.format(direct)}, '=', '') || '&ntb=1'
    ELSE 'https://www.bing.com/search?q=' || {number} END AS href,
  CASE WHEN list_id % 3 = 0 THEN '/search?q=' || {number}
    ELSE '/url?q=' || {direct} || '&sa=U&ved=1' END AS result_href
FROM ads"""


def crawl_links(d: Dialect) -> str:
    """Links per crawled page; each page repeats the one before, some hold nothing new."""
    page = div("list_id", 120)
    return f"""
SELECT host AS site, page, 'https://www.' || host || '/vi/' || {txt('n')} AS link
FROM (
  SELECT host, {page} AS page,
    CASE WHEN {page} % 40 = 39 THEN list_id - 120 ELSE list_id END AS n FROM ads
  UNION ALL
  SELECT host, {page} + 1 AS page, list_id AS n FROM ads
) p"""


def search_hits(d: Dialect) -> str:
    """Search results: keyword, domain, position and link, each link twice."""
    return f"""
SELECT 'apartamento ' || lower(coalesce(cidade, 'centro')) AS keyword, host AS domain, pos,
  'https://www.' || host || '/vi/' || {txt('list_id')} AS url, id
FROM (SELECT *, seq * 2 AS pos FROM ads
  UNION ALL SELECT *, seq * 2 + 1 AS pos FROM ads) twice"""


CARD_LAYOUTS = {
    "portal": (12, """'<div class="property-card">' || {titulo_h2} || '<span class="location-x">' || coalesce(cidade, '')
      || '</span><p>' || coalesce(preco, '') || ' - ' || metragem || '</p>'
      || CASE WHEN list_id % 3 = 0 THEN '' ELSE '<a href="/vi/' || {n} || '">ver</a>' END || '</div>'"""),
    "browser_a": (24, """'<div class="x-listing"><h3>' || coalesce(titulo, '') || '</h3><p>' || coalesce(preco, '') || '</p><p>'
      || metragem || ' ' || replace(quartos, 'Q', 'quartos') || ' ' || replace(banheiros, 'B', 'banheiros')
      || '</p><a href="//www.imovelweb.com.br/vi/' || {n} || '">ver</a></div>'"""),
    "browser_b": (24, """'<a data-testid="card-property" href="/imovel/' || {n} || '"><p>'
      || CASE WHEN list_id % 8 = 0 THEN 'Novo' ELSE '' END || '</p><p>' || coalesce(titulo, '') || '</p><p>'
      || coalesce(preco, '') || '</p><p>' || metragem || ' ' || replace(quartos, 'Q', 'quartos') || '</p></a>'"""),
    "article": (12, """'<article><a class="css-1jv9qum" href="/imovel/' || {n} || '">' || coalesce(titulo, '')
      || '</a><span data-qa="price">' || coalesce(preco, '') || '</span><p>' || metragem || '</p></article>'"""),
    "anchor": (12, """'<a data-testid="card-property" href="/imovel/' || {n} || '"><div class="c-title">' || coalesce(titulo, '')
      || '</div><span class="c-price">' || coalesce(preco, '') || '</span><p>' || metragem || '</p></a>'"""),
    "bank": (12, """'<div class="card-imovel">' || coalesce('<h4 class="titulo-imovel">' || titulo || '</h4>', '')
      || coalesce('<span class="end-imovel">' || endereco || '</span>', '')
      || coalesce('<span class="cidade-imovel">' || cidade || '</span>', '')
      || coalesce('<b class="valor-imovel">' || preco || '</b>', '') || '<a href="detalhe.asp?id=' || {n} || '">ver</a></div>'"""),
}
TITLE_H2 = "coalesce('<h2>' || titulo || '</h2>', '')"


def card_pages(layout: str):
    per_page, card = CARD_LAYOUTS[layout]

    def build(d: Dialect) -> str:
        page = div("list_id", per_page)
        body = card.format(n=txt("list_id"), titulo_h2=TITLE_H2)
        return f"""
SELECT {page} AS page_id, 'https://www.imovelweb.com.br/busca/' || {txt(page)} AS url,
  '<html><body><main>' || {d.join_rows(body, 'list_id')} || '</main></body></html>' AS html
FROM ads GROUP BY {page}"""

    return build


INPUTS = {
    "ads": ads,
    "revisions": revisions,
    "link_events": link_events,
    "keywords": keywords,
    "ad_pages": ad_pages,
    "ad_texts": ad_texts,
    "captures": captures,
    "nested_captures": nested_captures,
    "bank_responses": bank_responses,
    "listing_pages": listing_pages,
    "result_pages": result_pages,
    "redirects": redirects,
    "crawl_links": crawl_links,
    "search_hits": search_hits,
    **{f"card_pages_{layout}": card_pages(layout) for layout in CARD_LAYOUTS},
}
FROM_TABLES = {"ads", "revisions", "link_events", "keywords"}


def derive(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A derived input as a DataFrame over the tables of ``folder``.

    Tables are handed to the statement itself, so no view of the session is touched.
    """
    scans = {given: table(spark, folder, given) for given in GIVEN.get(name, AD_TABLES)}
    if name == "ad_pages":
        # Narrow order rows are dealt over the tasks that render the pages: by the key they are joined on, so that a
        # join of two large sides shuffles them once and is not merged into few long tasks, in whole rounds of the cores.
        cores = spark.sparkContext.defaultParallelism
        rounds = max(4, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // cores))
        scans["orders"] = scans["orders"].repartition(rounds * cores, "o_custkey")
    if name not in FROM_TABLES:
        scans = {"ads": spark.sql(_named(ads(SPARK), scans), **scans)}
    rows = spark.sql(_named(INPUTS[name](SPARK), scans), **scans)
    if "html" not in rows.columns:
        return rows
    # Rendering under a lambda gets its own code, as the fields of ``computed`` do.
    rendered = F.get(F.transform(F.array("html"), lambda h: h), F.lit(0))
    return computed(rows.withColumn("html", rendered), [c for c in rows.columns if c != "html"], {"html": F.col("html")})


def _named(sql: str, scans: dict[str, DataFrame]) -> str:
    """The statement with its tables as parameters, braces in texts doubled."""
    sql = sql.replace("{", "{{").replace("}", "}}")
    return re.sub(rf"\b(FROM|JOIN) ({'|'.join(scans)})\b", r"\1 {\2}", sql)


def with_inputs(names: list[str], select: str) -> str:
    """The checking engine's statement over the same derived inputs."""
    wanted = list(names)
    if any(n not in FROM_TABLES for n in names) and "ads" not in wanted:
        wanted.insert(0, "ads")
    wanted.sort(key=lambda n: n != "ads")
    parts = ",\n".join(f"{n} AS ({INPUTS[n](DUCK)}\n)" for n in wanted)
    return f"WITH {parts}\n{select}"

"""Schemas, word lists, lookup tables, patterns and text formats.

These must equal the values the listing format uses, or results differ.
Patterns are written for the JVM regex engine: ``(?U)`` makes ``\\s``, ``\\d``
and ``\\b`` Unicode-aware, so a non-breaking space after ``R$`` is a space.
"""

from __future__ import annotations

from typing import NamedTuple

# --- fixed values: columns of the listing table, in storage order -----------
LISTING_COLUMNS = [
    "id", "titulo", "preco", "metragem", "quartos", "banheiros", "descricao",
    "endereco", "cidade", "estado", "cep", "contato", "link", "fonte",
    "data_coleta", "raw_text",
]
EXPORT_COLUMNS = LISTING_COLUMNS[:-1]

# --- fixed values: the short listing table written by the capture route -----
NARROW_COLUMNS = [
    "id", "link", "titulo", "preco", "cidade", "estado", "endereco",
    "descricao", "fonte", "data_coleta",
]

# --- fixed values: headings of the localized spreadsheet --------------------
CSV_HEADINGS = {
    "id": "ID", "titulo": "Título", "preco": "Preço", "metragem": "Metragem",
    "quartos": "Quartos", "banheiros": "Banheiros", "descricao": "Descrição",
    "endereco": "Endereço", "cidade": "Cidade", "estado": "Estado",
    "cep": "CEP", "contato": "Contato", "link": "Link", "fonte": "Fonte",
    "data_coleta": "Data Coleta",
}

# --- fixed values: portals, in tagging order --------------------------------
PORTALS = [
    "vivareal.com.br",
    "imovelweb.com.br",
    "olx.com.br",
    "zapimoveis.com.br",
    "mercadolivre.com.br",
]
OTHER_DOMAIN = "outro"
ENGINE_MARKERS = ["bing.com", "microsoft"]

# --- fixed values: keyword dictionaries, in match order ---------------------
CITY_UF = [
    ("curitiba", "PR"),
    ("sao paulo", "SP"),
    ("belo horizonte", "MG"),
    ("salvador", "BA"),
    ("brasilia", "DF"),
    ("rio", "RJ"),
    ("recife", "PE"),
    ("fortaleza", "CE"),
]
PROPERTY_TYPES = ["apartamento", "casa", "studio", "kitnet"]
DEFAULT_CITY_UF = ("curitiba", "PR")
DEFAULT_TYPE = "apartamento"

# --- fixed values: queue states and limits ----------------------------------
STATUS_PENDING, STATUS_RETRY, STATUS_DONE, STATUS_ERROR = "pending", "retry", "done", "error"
MAX_ATTEMPTS = 3
LINKS_PER_DOMAIN = 5
MAX_RESULTS = 50

# --- fixed values: lengths ---------------------------------------------------
MIN_PAGE_CHARS = 100
MIN_CARD_CHARS = 10
MIN_TITLE_CHARS = 5
RAW_TEXT_CHARS = 500
TITLE_CHARS = 150
CARD_TITLE_CHARS = 100
CARD_TEXT_CHARS = 150
PREVIEW_CHARS = 200

# --- fixed values: words that mark a page as blocked or empty ----------------
CHALLENGE_MARKERS = ["One last step", "Please solve the challenge", "Verifying", "Just a moment"]
EMPTY_RESULT_MARKERS = ["Não encontramos"]
CAPTURE_MARKER = "GalleryGroup"

# --- fixed values: texts used for missing values ------------------------------
PRICE_ON_REQUEST = "Sob consulta"
UNTITLED_CARD = "Imóvel em VivaReal"
NOT_AVAILABLE = "N/A"

# --- fixed values: texts of the listing a keyword stands for -------------------
KEYWORD_TITLE = "{tipo} em {cidade} - Resultado de Busca"
KEYWORD_TEXT = "Imóvel tipo {tipo} localizado em {cidade}, {estado}. Resultado da busca por '{keyword}'"
KEYWORD_LINK = "https://www.busca-imovel.com.br/{tipo}/{cidade}/{estado}"
KEYWORD_PRICE = "Sob Consulta"
KEYWORD_AREA = "Variado"
KEYWORD_SOURCE = "Busca por Palavras-Chave"

# --- fixed values: field patterns ---------------------------------------------
PRICE = r"(?U)R\$\s*[\d.,]+"
PRICE_ANY_CASE = r"(?iuU)R\$\s*[\d.,]+"
AREA = r"(?iuU)(\d{2,4})\s*m[²2]"
AREA_LOOSE = r"(?iuU)(?<!\d)(\d++)\s*m[²2]"
AREA_WHOLE = r"(?iuU)(?=\d)(?<!\d)(\d{2,6})\s*m[²2]"
# A look-behind before a digit or address run, and possessive runs, only stop
# retries that cannot match: the leftmost match is that of the plain pattern and
# the search stays linear in the page. A look-ahead for a digit before the look-behind,
# and a first character outside of the letter-case group, let most positions fail at
# their first test. Word borders are spelled out, because
# engines differ on whether a superscript digit is part of a word.
ROOMS = r"(?iuU)(?=\d)(?<!\d)(\d++)\s*(?:quartos|quarto|qt|q)(?![\p{L}\p{N}_])"
ROOMS_LOOSE = r"(?iuU)(?<!\d)(\d++)\s*(?:quarto|q)"
BATHS = r"(?iuU)(?=\d)(?<!\d)(\d++)\s*(?:banheiros?(?![\p{L}\p{N}_])|b\.)"
BATHS_LOOSE = r"(?iuU)(?<!\d)(\d++)\s*(?:banheiro|b\.)"
POSTAL_CODE = r"(?U)(?=\d)(?<![\p{L}\p{N}_])\d{5}-\d{3}(?![\p{L}\p{N}_])"
POSTAL_CODE_UNBOUNDED = r"\d{5}-\d{3}"
PHONE = r"(?U)\(?\d{2,3}\)?\s*\d{4,5}-\d{4}"
PHONE_SHORT = r"(?U)\(?\d{2}\)?\s*\d{4,5}-\d{4}"
PHONE_PARENS = r"(?U)\(\d{2}\)\s*\d{4,5}-\d{4}"
PHONE_INTERNATIONAL = r"\+\d{1,3} \(\d{3}\) \d{3}-\d{4}"
TEL_LINK = r"[hH](?iuU:ref=['\"]tel:(\+?[0-9\-\(\)\s]+)['\"])"
DATA_PHONE = r"[dD](?iu:ata-phone=['\"]([^'\"]+)['\"])"
ADDRESS_LINE = r"(?U)(?<![A-Za-z0-9\s.,\-])([A-Za-z0-9\s.,\-]+(?<=[A-Za-z0-9])),([A-Za-z\s]++)-\s*([A-Z]{2})"
ADDRESS_END = r"(?U),[A-Za-z\s]++-\s*[A-Z]{2}"
HTML_TITLE = r"<(?iud:title>(.*?)</title>)"
TITLE_ELEMENT = r"<(?ius:title\b[^>]*>(.*?)</title\s*>)"
META_TAG = r"""<(?iu:meta\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>)"""
NAMED_DESCRIPTION = r"""(?iu)(?<![\w-])name\s*=\s*["']?description["'\s/>]"""
HTML_H1 = r"<(?ius:h1[^>]*>(.*?)</h1>)"
# What a script, a style or a comment holds is taken in whole runs up to its end, or the page's.
NOT_TEXT = (
    r"<(?:(?iu:script\b)(?:[^<]++|<(?!(?iu:/script\s*>)))*+(?:<(?iu:/script\s*>)|\z)"
    r"|(?iu:style\b)(?:[^<]++|<(?!(?iu:/style\s*>)))*+(?:<(?iu:/style\s*>)|\z)"
    r"|!--(?:[^-]++|-(?!->))*+(?:-->|\z))"
)
HTML_H1_PLAIN = r"<h1[^>]*>([^<]+)</h1>"
META_DESCRIPTION = r"<(?iuU:meta\s+name=[\"']description[\"']\s+content=[\"']([^\"']+)[\"'])"
OG_DESCRIPTION = r"<(?iuU:meta\s+property=[\"']og:description[\"']\s+content=[\"']([^\"']+)[\"'])"
SCRIPT_END = r"<(?iu:/script>)"
JSONLD_MARKS = ["ld+", "LD+", "Ld+", "lD+"]
JSONLD_START = r"""<(?ius:script[^>]*\btype\s*=\s*["']?application/ld\+json(?:["'\s][^>]*)?>(.*)\z)"""
EMBEDDED_CITY = r'(?U)"addressLocality"\s*:\s*"([^"]{2,100})"'
EMBEDDED_REGION = r'(?U)"addressRegion"\s*:\s*"([A-Z]{2})"'
EMBEDDED_POSTAL = r'(?U)"postalCode"\s*:\s*"(\d{5}-\d{3})"'
STATE_BEGIN = r"window\.__(?:PRELOADED_STATE|INITIAL_STATE|SSR_STATE)__\s*=\s*(?=\{)"
# A string, with the colon behind it if it is a key.
JSON_STRING = r'"(?:[^"\\]|\\.)*+"(?:\s*:)?'
STATE_URL = r"^https?://.*olx\."
AD_PATH = r"/anuncio|/imoveis/|/venda/|/aluguel/"
NATIVE_ID = r"/vi/(\d+)"
NATIVE_URL = "https://www.olx.com.br/vi/"
# Each lazy step is atomic: taking a later occurrence of one key can never help
# the keys after it, so the result is that of the plain lazy chain without its
# backtracking.
CAPTURE_AD = (
    r'(?s)"list_id":(\d++)'
    r'(?>.*?"ad_url":"([^"]+)")'
    r'(?>.*?"price":"([^"]+)")'
    r'(?>.*?"subject":"([^"]+)")'
    r'(?>.*?"municipality":"([^"]+)")'
    r'(?>.*?"state_uf":"([^"]+)")'
)
CAPTURE_KEYS = [
    ("ad_url", "ad_url"), ("price", "preco"), ("subject", "titulo"), ("municipality", "cidade"), ("state_uf", "estado"),
]
# The plain lazy chain the pattern above must equal.
CAPTURE_AD_PLAIN = (
    r'(?s)"list_id":(\d+).*?"ad_url":"([^"]+)".*?"price":"([^"]+)".*?"subject":"([^"]+)"'
    r'.*?"municipality":"([^"]+)".*?"state_uf":"([^"]+)"'
)
CURSOR_KEYS = ["next", "cursor", "after", "nextCursor", "endCursor", "page_next", "next_token"]
LINK_NEXT = r'<([^>]+)>;\s*rel="next"'
MERGED_TYPES = ["Offer", "Product", "Apartment", "SingleFamilyResidence"]
SKIPPED_TYPES = ["BreadcrumbList", "Thing"]
COVERAGE_FIELDS = ["preco", "endereco", "cep", "contato"]
CONSOLIDATED_FIELDS = ["preco", "endereco", "cidade", "cep", "contato"]
BANK_BASE_URL = "https://venda-imoveis.caixa.gov.br/sistema/"
BANK_SOURCE = "Caixa"


class Selector(NamedTuple):
    """One compound selector: tag, attribute, test (has, has_word, contains, equals), value."""

    tag: str | None = None
    attr: str | None = None
    test: str | None = None
    value: str | None = None


# --- fixed values: card selectors, tried in order; the first that hits is used
CARDS_PORTAL = [
    Selector("div", "data-listing-id", "has"),
    Selector("article", "data-listing", "has"),
    Selector("div", "class", "has_word", "listing-item"),
    Selector("div", "class", "has_word", "property-card"),
    Selector("li", "class", "has_word", "search-result"),
    Selector("div", "class", "has_word", "home-card"),
    Selector("div", "class", "contains", "card"),
    Selector("div", "class", "contains", "listing"),
]
CARDS_BROWSER_A = [
    Selector("div", "class", "contains", "listing"),
    Selector("div", "class", "contains", "propiedad"),
    Selector("div", "data-id", "has"),
    Selector("article", "class", "contains", "item"),
    Selector("li", "class", "contains", "resultsItem"),
    Selector("div", "id", "contains", "listing-"),
]
CARDS_BROWSER_B = [
    Selector("a", "data-testid", "equals", "card-property"),
    Selector("div", "class", "contains", "card"),
    Selector("div", "class", "contains", "Card_"),
    Selector("article", "class", "contains", "Property"),
    Selector("div", "data-component-name", "equals", "Card"),
]
CARDS_ARTICLE = [Selector("article")]
CARDS_ANCHOR = [Selector("a", "data-testid", "equals", "card-property")]
CARDS_BANK = [Selector(None, "class", "has_word", "card-imovel")]

# --- fixed values: field selectors inside a card, tried in order ---------------
PORTAL_TITLE = [
    Selector("h2"),
    Selector("h3"),
    Selector("a", "class", "has_word", "property-name"),
    Selector(None, "class", "contains", "title"),
]
PORTAL_PLACE = [
    Selector("span", "class", "contains", "location"),
    Selector("span", "class", "contains", "city"),
    Selector(None, "class", "contains", "neighborhood"),
]
ARTICLE_TITLE = [Selector("a", "class", "has_word", "css-1jv9qum")]
ARTICLE_PRICE = [Selector("span", "data-qa", "equals", "price")]
ANCHOR_TITLE = [Selector("div", "class", "contains", "title")]
ANCHOR_PRICE = [Selector("span", "class", "contains", "price")]
BANK_TITLE = [Selector(None, "class", "has_word", "titulo-imovel")]
BANK_ADDRESS = [Selector(None, "class", "has_word", "end-imovel")]
BANK_CITY = [Selector(None, "class", "has_word", "cidade-imovel")]
BANK_PRICE = [Selector(None, "class", "has_word", "valor-imovel")]

# --- fixed values: probed selectors as open-tag patterns ------------------------
PROBED_SELECTORS = [
    ("article", r"(?iu)<article\b"),
    ("li[data-listing]", r"(?iu)<li\b[^>]*\sdata-listing\b"),
    ("div[data-id]", r"(?iu)<div\b[^>]*\sdata-id\b"),
    (".card", r"(?iu)<\w+\b[^>]*\sclass=\"(?:[^\"]*\s)?card[\"\s]"),
    (".listing", r"(?iu)<\w+\b[^>]*\sclass=\"(?:[^\"]*\s)?listing[\"\s]"),
    (".item", r"(?iu)<\w+\b[^>]*\sclass=\"(?:[^\"]*\s)?item[\"\s]"),
]

# --- fixed values: bank API fields and the listing names they get --------------
BANK_FIELDS = [
    ("cidade", "cidade"),
    ("uf", "uf"),
    ("bairro", "bairro"),
    ("endereco", "endereco"),
    ("valoravaliacao", "valor_avaliacao"),
    ("valorminimo", "valor_minimo"),
    ("areaprivativa", "area_total"),
    ("tipoimovel", "tipo_imovel"),
    ("modalidadevenda", "modalidade_venda"),
    ("urldetalhes", "link_edital"),
]

"""URL helpers: unwrap, resolve, tag, page and encode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.functions.text import find


def domain_of(url: Column, domains: list[str] | None = None) -> Column:
    """First known domain the URL contains, else null."""
    picked = F.when(F.lit(False), F.lit(None).cast("string"))
    for domain in domains or C.PORTALS:
        picked = picked.when(url.contains(domain), F.lit(domain))
    return picked


def queue_domain(url: Column) -> Column:
    return F.coalesce(domain_of(url), F.lit(C.OTHER_DOMAIN))


def site_label(url: Column) -> Column:
    """First label of the known domain, upper case; null for other URLs."""
    return F.upper(F.split_part(domain_of(url), F.lit("."), F.lit(1)))


def strip_query(url: Column) -> Column:
    return F.split_part(url, F.lit("?"), F.lit(1))


def without_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments: a stack of segments, folded from left to right."""
    segments = F.split(path, "/")
    dots = F.element_at(segments, -1).isin(".", "..")

    def fold(stack: Column, segment: Column) -> Column:
        # The first segment, empty before the leading slash, is never taken off.
        up = F.when(F.size(stack) > 1, F.slice(stack, F.lit(1), F.size(stack) - 1)).otherwise(stack)
        return F.when(segment == "..", up).when(segment == ".", stack).otherwise(F.concat(stack, F.array(segment)))

    kept = F.aggregate(segments, F.array().cast("array<string>"), fold)
    joined = F.array_join(F.concat(kept, F.when(dots, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))), "/")
    return F.when(path.rlike(r"(?:^|/)\.\.?(?:/|$)"), joined).otherwise(path)


def resolve(href: Column, base: Column) -> Column:
    """Absolute URL of an href found on the page ``base`` (RFC 3986, 5.2).

    An href with a scheme is returned as it is written.
    """
    scheme = find(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", 1)
    origin = find(base, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*")
    folder = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(/(?:[^?#]*/)?)", 1)
    path, tail = F.regexp_extract(href, r"^[^?#]*", 0), F.regexp_extract(href, r"(?s)[?#].*$", 0)
    host = F.regexp_extract(path, "^//[^/]*", 0)
    behind = F.substr(path, F.length(host) + 1, F.length(path))
    # Most hrefs are a whole path without query, fragment or dot segments, which takes no splitting.
    simple = ~(href.contains("?") | href.contains("#") | href.contains("/."))
    return (
        F.when(simple & href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(simple & href.startswith("/"), F.concat(origin, href))
        .when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), host, without_dots(behind), tail))
        .when(href.startswith("/"), F.concat(origin, without_dots(path), tail))
        .when(href == "", base)
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), href))
        .when(href.startswith("?"), F.concat(F.regexp_replace(base, r"[?#].*$", ""), href))
        .otherwise(F.concat(origin, without_dots(F.concat(F.when(folder == "", "/").otherwise(folder), path)), tail))
    )


def query_value(url: Column, name: str) -> Column:
    """Decoded value of a query parameter, null when absent or malformed."""
    return F.try_url_decode(find(url, rf"[?&]{name}=([^&#]+)", 1))


def _web_address(c: Column) -> Column:
    return find(c, r"(?s)^http.*$")


def unwrap_redirect(href: Column) -> Column:
    """Target of a search-engine redirect; other URLs are returned unchanged.

    The ``u`` value carries a two-character marker before the target, which is
    percent-encoded text (sometimes with the colon's ``%`` lost) or URL-safe
    base64. ``ref`` carries the target itself. Anything else gives null.
    """
    body = F.regexp_replace(query_value(href, "u"), "^a.?", "")
    decoded = F.try_url_decode(F.replace(body, F.lit("+"), F.lit("%2B")))
    plain = F.regexp_replace(decoded, r"^(https?)3A", "$1:")
    code = F.rtrim(F.translate(body, "-_", "+/"), F.lit("="))
    padding = F.substr(F.lit("=="), F.lit(1), F.pmod(-F.length(code), F.lit(4)))
    binary = F.try_to_binary(F.concat(code, padding), F.lit("base64"))
    target = F.coalesce(
        _web_address(plain),
        _web_address(F.try_validate_utf8(binary.cast("string"))),
        _web_address(query_value(href, "ref")),
    )
    return F.when(href.contains("bing.com"), target).otherwise(href)


def unwrap_result_link(href: Column) -> Column:
    """Target in ``url?q=`` result links up to the next ``&``; cached copies are dropped."""
    target = F.split_part(F.split_part(href, F.lit("url?q="), F.lit(2)), F.lit("&"), F.lit(1))
    return F.when(href.contains("url?q=") & ~href.contains("webcache"), target)


def is_engine_url(url: Column) -> Column:
    hit = F.lit(False)
    for marker in C.ENGINE_MARKERS:
        hit = hit | url.contains(marker)
    return hit


def native_id(url: Column) -> Column:
    return find(url, C.NATIVE_ID, 1)


def native_url(ad_id: Column) -> Column:
    return F.concat(F.lit(C.NATIVE_URL), ad_id.cast("string"))


def slug(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("-"))


def city_search_url(host: str, city: Column) -> Column:
    """Search page of a portal for a city."""
    return F.concat(F.lit(f"https://{host}/venda/apartamentos/"), slug(city), F.lit("-pr/"))


def quote(c: Column) -> Column:
    """Percent-encode for a URL; spaces as ``%20``, slashes kept."""
    encoded = F.url_encode(c)
    for encoded_char, char in [("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")]:
        encoded = F.replace(encoded, F.lit(encoded_char), F.lit(char))
    return encoded


def search_url(query: Column) -> Column:
    return F.concat(F.lit("https://www.bing.com/search?q="), quote(query))


def page_url(start_url: Column, page: Column) -> Column:
    """URL of the n-th page of a paged listing."""
    joiner = F.when(start_url.contains("?"), F.lit("&page=")).otherwise(F.lit("?page="))
    return F.concat(start_url, joiner, page.cast("string"))


def header_next(link_header: Column) -> Column:
    """Target of ``rel="next"`` in a Link header."""
    return find(link_header, C.LINK_NEXT, 1)


def contains_domain(url: Column, domain: Column) -> Column:
    return F.contains(url, domain) & F.startswith(url, F.lit("http"))

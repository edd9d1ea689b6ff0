"""Links found on pages: anchors, ad links, embedded state, paging."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.functions import jsons, tags, text, urls
from garimpo.functions.steps import computed
from garimpo.operators.dedup import top_n
from garimpo.operators.places import first_places, known_places
from garimpo.session import scratch_path


def _hrefs(html: Column) -> Column:
    return tags.attributes(tags.markup(html), "a", "href")


def page_base(markup: Column, url: Column) -> Column:
    """What relative links of a page are relative to: its first ``<base href>``, or its URL."""
    tag = F.when(markup.rlike("(?i)<base"), F.regexp_extract(markup, tags.pattern("base"), 0))
    # Bound to a lambda's variable, the address is made once.
    given = F.transform(F.array(text.strip(tags.attribute(tag, "href"))), lambda href: urls.resolve(href, url))
    return F.coalesce(F.get(given, F.lit(0)), url)


def hrefs(pages: DataFrame) -> DataFrame:
    """One row per anchor href, decoded, in page order, with the page's ``base``."""
    read = computed(pages, ["page_id", "url"], {"markup": tags.markup(F.col("html"))})
    base = page_base(F.col("markup"), F.col("url")).alias("base")
    return read.select("page_id", "url", base, F.posexplode(tags.attributes(F.col("markup"), "a", "href")).alias("pos", "href"))


ANCHOR_BODY = r"(?ius)^(.*?)(?:</a(?=[\s/>])|\z)"
SALTS = 64


def result_links(pages: DataFrame, domains: list[str] | None = None) -> DataFrame:
    """Links to a target domain on a result page, unwrapped, cleaned and distinct.

    Redirects are decoded and kept as they are; direct links must start with
    ``http`` and lose their query.
    """
    listed = hrefs(pages).withColumn("href", text.strip(F.col("href")))
    wrapped = urls.is_engine_url(F.col("href"))
    target = F.when(wrapped, urls.unwrap_redirect(F.col("href"))).when(
        F.col("href").startswith("http"), urls.strip_query(F.col("href"))
    )
    linked = computed(listed, ["page_id", "pos"], {"link": target})
    tagged = linked.withColumn("domain", urls.domain_of(F.col("link"), domains))
    return (
        tagged.filter("domain is not null")
        .groupBy("page_id", "domain", "link")
        .agg(F.min("pos").alias("pos"))
    )


def anchor_counts(pages: DataFrame, samples: int = 8) -> DataFrame:
    """Anchors per target domain, a few sample links, and all anchors under a null domain.

    Pages are read and searched once: each is reduced to its number of anchors
    per domain and its first links, and both results come from that narrow table, which is
    written to the shared folder. A page's samples beyond ``samples`` never leave it.
    """
    domains = F.array(*[F.lit(d) for d in C.PORTALS])
    read = computed(pages, ["page_id"], {"hrefs": _hrefs(F.col("html"))})
    placed = F.transform("hrefs", lambda h, i: F.struct(i.alias("pos"), h.alias("href")))

    def tally(domain: Column) -> Column:
        own = F.filter(placed, lambda x: F.contains(x["href"], domain))
        return F.struct(domain.alias("domain"), F.size(own).alias("n"), F.slice(own, 1, samples).alias("first"))

    every = F.struct(F.lit(None).cast("string").alias("domain"), F.size(placed).alias("n"), F.slice(placed, 1, 0).alias("first"))
    per_page = read.select("page_id", F.inline(F.concat(F.transform(domains, tally), F.array(every)))).filter("n > 0")
    path = scratch_path(pages.sparkSession, "anchor-counts")
    per_page.write.parquet(path)
    counted = pages.sparkSession.read.schema(per_page.schema).parquet(path)
    totals = counted.groupBy("domain").agg(F.sum("n").alias("anchors"))
    listed = counted.select("domain", "page_id", F.inline("first"))
    # A first cut by a salted key keeps any one domain's candidates spread over tasks.
    salted = top_n(listed, ["domain", F.pmod(F.xxhash64("page_id"), F.lit(SALTS))], [F.col("page_id"), F.col("pos")], samples)
    kept = top_n(salted, ["domain"], [F.col("page_id"), F.col("pos")], samples)
    in_order = F.array_sort(F.collect_list(F.struct("page_id", "pos", "href")))
    sampled = kept.groupBy("domain").agg(F.array_join(F.transform(in_order, lambda s: s["href"]), " ").alias("samples"))
    return totals.join(sampled, "domain", "left")


def anchor_totals(pages: DataFrame) -> DataFrame:
    """Anchors and portal anchors per page."""
    return pages.select("page_id", _hrefs(F.col("html")).alias("hrefs")).select(
        "page_id",
        F.size("hrefs").cast("bigint").alias("anchors"),
        F.size(F.filter("hrefs", lambda h: urls.domain_of(h).isNotNull())).cast("bigint").alias("portal_anchors"),
    )


def ad_links(pages: DataFrame, site: str = "olx.com.br") -> DataFrame:
    """Candidate ad links of a listing page, distinct per page.

    An anchor counts when its path names an ad section, when it shows an image
    and is longer than 40 characters, or when it is longer than 60 characters.
    """
    # The page is cut at its anchor tags, so an anchor that is never closed ends
    # at the next one and no text is searched twice.
    read = computed(pages, ["page_id", "url"], {"markup": tags.markup(F.col("html"))})
    anchors = read.select(
        "page_id", page_base(F.col("markup"), F.col("url")).alias("base"), F.inline(tags.followed(F.col("markup"), "a"))
    )
    body = F.regexp_extract("after", ANCHOR_BODY, 1)
    listed = computed(
        anchors, ["page_id", "base"],
        {"raw": text.strip(tags.attribute(F.col("tag"), "href")), "has_image": body.rlike(r"(?iu)<img(?=[\s/>])")},
    )
    resolved = computed(listed, ["page_id", "has_image"], {"href": urls.resolve(F.col("raw"), F.col("base"))})
    length = F.length("href")
    wanted = (
        F.col("href").rlike(C.AD_PATH) | (F.col("has_image") & (length > 40)) | (length > 60)
    )
    return (
        resolved.filter(F.col("href").contains(site) & wanted)
        .select("page_id", urls.strip_query(F.col("href")).alias("link"))
        .distinct()
    )


def state_links(pages: DataFrame) -> DataFrame:
    """Portal URLs among the values of embedded state objects, distinct per page.

    The JSON parser reads one object from where each begins, so it ends at its own
    last brace, whatever its strings hold and whatever follows. Strings are unescaped
    by the parser; keys are no links.
    """
    begun = F.split("html", C.STATE_BEGIN)
    blocks = F.array_compact(F.transform(F.slice(begun, F.lit(2), F.size(begun)), jsons.first_value))
    strings = F.flatten(F.transform(blocks, lambda b: F.regexp_extract_all(b, F.lit(C.JSON_STRING), F.lit(0))))
    likely = F.filter(strings, lambda s: s.startswith('"http') & s.endswith('"') & s.contains("olx"))
    links = F.filter(jsons.elements(F.concat(F.lit("["), F.array_join(likely, ","), F.lit("]"))), lambda u: u.rlike(C.STATE_URL))
    cleaned = F.transform(links, lambda u: urls.strip_query(u))
    return pages.select("page_id", F.explode(F.array_distinct(cleaned)).alias("link"))


def first_seen(found: DataFrame) -> DataFrame:
    """Each link once per crawl, with the first page it was seen on."""
    return found.groupBy("site", "link").agg(F.min("page").alias("page"))


def new_links_per_page(found: DataFrame) -> DataFrame:
    """Per crawl and page: links found, and links no earlier page had.

    Paging stops at the first page with nothing new, so later pages are left
    out. Only per-link and per-page aggregates are shuffled, never a whole crawl.
    """
    total = (
        found.select("site", "page", "link").distinct()
        .groupBy("site", "page").agg(F.count("*").alias("found"))
    )
    fresh = first_seen(found).groupBy("site", "page").agg(F.count("*").alias("new"))
    pages = total.join(fresh, ["site", "page"], "left").withColumn(
        "new", F.coalesce("new", F.lit(0).cast("bigint"))
    )
    stops = pages.filter("new = 0").groupBy("site").agg(F.min("page").alias("stop_page"))
    return (
        pages.join(stops, "site", "left")
        .filter(F.col("stop_page").isNull() | (F.col("page") <= F.col("stop_page")))
        .drop("stop_page")
    )


def page_urls(starts: DataFrame, pages: int) -> DataFrame:
    """One URL per page of each paged listing."""
    return starts.select(
        "start_url", F.explode(F.sequence(F.lit(1), F.lit(pages))).alias("page")
    ).withColumn("page_url", urls.page_url(F.col("start_url"), F.col("page")))


def _first_in_text(folded: str, words: list[str], default: str) -> Column:
    """The first of the words, in their order, that the text contains."""
    listed = F.array(*[F.lit(w) for w in words])
    return F.coalesce(F.get(F.filter(listed, lambda w: F.contains(folded, w)), F.lit(0)), F.lit(default))


def keyword_places(keywords: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """City, state and property type named in a keyword, first in dictionary order.

    ``places`` is a gazetteer ``ordem, nome, uf`` of any size; without it, the fixed cities are looked for.
    """
    default_city, default_uf = C.DEFAULT_CITY_UF
    found = first_places(keywords, "keyword", known_places(keywords.sparkSession) if places is None else places, "_place")
    folded = computed(found, [*keywords.columns, "_place"], {"_folded": text.fold(F.col("keyword"))})
    named = F.col("_place").isNotNull()
    return folded.select(
        *keywords.columns,
        F.when(named, F.col("_place.nome")).otherwise(default_city).alias("cidade"),
        F.when(named, F.col("_place.uf")).otherwise(default_uf).alias("estado"),
        _first_in_text("_folded", C.PROPERTY_TYPES, C.DEFAULT_TYPE).alias("tipo"),
    )


def _filled(template: str, **values: Column | str) -> Column:
    """A text with its ``{names}`` replaced by columns."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def keyword_listings(keywords: DataFrame) -> DataFrame:
    """A listing row describing the search each keyword stands for."""
    place = keyword_places(keywords)
    city, kind, uf = F.col("cidade"), F.col("tipo"), F.col("estado")
    return place.select(
        F.md5(F.concat(kind, city)).alias("id"),
        _filled(C.KEYWORD_TITLE, tipo=text.title_case(kind), cidade=text.title_case(city)).alias("titulo"),
        F.lit(C.KEYWORD_PRICE).alias("preco"),
        F.lit(C.KEYWORD_AREA).alias("metragem"),
        text.title_case(city).alias("cidade"),
        uf.alias("estado"),
        _filled(C.KEYWORD_TEXT, tipo=kind, cidade=city, estado=uf, keyword="keyword").alias("descricao"),
        _filled(C.KEYWORD_LINK, tipo=kind, cidade=city, estado=uf).alias("link"),
        F.col("keyword").alias("palavras_chave"),
        F.lit(C.KEYWORD_SOURCE).alias("fonte"),
    )


def keyword_results(found: DataFrame) -> DataFrame:
    """Results per keyword, and how many of them no earlier keyword had."""
    first = found.groupBy("id").agg(F.min("keyword").alias("keyword"))
    unique = first.groupBy("keyword").agg(F.count("*").alias("new_ids"))
    total = found.groupBy("keyword").agg(F.count("*").alias("results"))
    return total.join(unique, "keyword", "left").withColumn(
        "new_ids", F.coalesce("new_ids", F.lit(0).cast("bigint"))
    )

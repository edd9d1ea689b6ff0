"""Queries on listing tables: sources, sinks, filters, joins, counts, windows, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.functions import text, urls
from garimpo.operators import captures as cap
from garimpo.operators import cards, dedup, discover, extract, queue, report
from garimpo.plans.corpus import derive
from garimpo.plans.registry import (
    CAPTURE_ADS,
    EX_KEY,
    EXTRACTED,
    FOUND_AD_URLS,
    PLACED,
    QUEUE_DOMAIN,
    big,
    col_list,
    register,
)
from garimpo.session import scratch_path
from garimpo.sources import readers, writers
from garimpo.sources.listing_table import ListingTable

EXPORT = col_list(C.EXPORT_COLUMNS)
READ_BACK = col_list(
    [f"nullif({c}, '') AS {c}" if c == "preco" else c for c in C.EXPORT_COLUMNS]
)

# --------------------------------------------------------------------- sources


@register(
    "src_capture_json", ["captures"],
    """SELECT entry_id, url, CAST(status AS BIGINT) AS status, md5(text) AS text_md5 FROM captures WHERE entry_id // 64 % 5 <> 4
       UNION ALL SELECT NULL, 'unreadable', count(DISTINCT entry_id // 64), NULL FROM captures WHERE entry_id // 64 % 5 = 4""",
)
def src_capture_json(spark: SparkSession, sf: str) -> DataFrame:
    """Files of one indented array each; every fifth is broken and comes back as a count."""
    path = scratch_path(spark, "captures-json")
    entry = F.to_json(F.struct("entry_id", "type", "url", "method", "status", "text"), {"pretty": "true"})
    rows = derive(spark, sf, "captures").withColumn("arquivo", F.expr("entry_id div 64"))
    files = rows.groupBy("arquivo").agg(F.array_join(F.collect_list(entry), ",\n").alias("body"))
    end = F.when(F.col("arquivo") % 5 != 4, "\n]").otherwise(",{")
    files = files.select("arquivo", F.concat(F.lit("[\n"), "body", end).alias("value"))
    files.repartition("arquivo").write.partitionBy("arquivo").text(path)
    read = readers.json_array(spark, f"{path}/*", readers.CAPTURE_SCHEMA, indent=0, whole_files=True).select(
        "entry_id", "url", *big("status"), F.md5("text").alias("text_md5")
    )
    broken = readers.cut_files(spark, f"{path}/*", indent=0).agg(F.count("*").alias("status"))
    none = F.lit(None)
    return read.unionByName(
        broken.select(none.cast("long").alias("entry_id"), F.lit("unreadable").alias("url"), "status", none.cast("string").alias("text_md5"))
    )


@register(
    "src_latest_file", ["ads"],
    """SELECT id, titulo, link FROM ads
       WHERE seq // 3650000000000000 = (SELECT max(seq // 3650000000000000) FROM ads)""",
)
def src_latest_file(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "exports")
    exports = derive(spark, sf, "ads").withColumn("lote", F.expr("seq div 3650000000000000"))
    writers.export_csv_by(exports, "lote", path)
    newest = readers.latest_batch(spark, path, "*.csv")
    return readers.export_csv(spark, newest).select("id", "titulo", "link")


@register("src_csv_glob", ["ads"], f"SELECT {READ_BACK} FROM ads")
def src_csv_glob(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    ads = derive(spark, sf, "ads")
    writers.export_csv(ads.filter("fonte is null"), f"{path}/a")
    writers.export_csv(ads.filter("fonte is not null"), f"{path}/b")
    return readers.export_csv(spark, f"{path}/*")


@register("src_keyword_lines", ["keywords"], "SELECT keyword FROM keywords")
def src_keyword_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "keywords")
    padded = F.concat(F.lit("  "), "keyword", F.lit(" \t\n   \n"))
    derive(spark, sf, "keywords").select(padded.alias("value")).write.text(path)
    return readers.keyword_lines(spark, path)


@register("src_pages", None, "SELECT page_id, url, CAST(length(html) AS BIGINT) AS chars FROM pages")
def src_pages(spark: SparkSession, sf: str) -> DataFrame:
    return readers.pages(spark, sf).select("page_id", "url", F.length("html").cast("bigint").alias("chars"))


BANK_EXPECTED = """SELECT list_id // 20 AS entry_id, cidade, coalesce(upper(estado), 'ND') AS uf, endereco,
  coalesce(preco, '') AS valorminimo, metragem AS areaprivativa, 'detalhe?id=' || list_id AS urldetalhes
  FROM ads WHERE (list_id // 20) % 5 <> 0"""


@register("src_bank_api", ["ads"], BANK_EXPECTED)
def src_bank_api(spark: SparkSession, sf: str) -> DataFrame:
    rows = cap.bank_rows(derive(spark, sf, "bank_responses"))
    return rows.select("entry_id", "cidade", "uf", "endereco", "valorminimo", "areaprivativa", "urldetalhes")


@register("src_listing_scan", ["ads"], f"SELECT {EXPORT} FROM ads")
def src_listing_scan(spark: SparkSession, sf: str) -> DataFrame:
    return readers.listing_scan(derive(spark, sf, "ads"))


@register(
    "src_schema_describe", ["ads"],
    "SELECT * FROM (VALUES "
    + ", ".join(f"(CAST({i} AS BIGINT), '{c}', 'string')" for i, c in enumerate(C.EXPORT_COLUMNS))
    + ") v(pos, coluna, tipo), (SELECT count(*) AS linhas FROM ads) n",
)
def src_schema_describe(spark: SparkSession, sf: str) -> DataFrame:
    listing = readers.listing_scan(derive(spark, sf, "ads"))
    return report.describe_schema(listing).withColumn("pos", F.col("pos").cast("bigint"))


# ----------------------------------------------------------------------- sinks


@register("snk_json", ["ads"], f"SELECT {EXPORT} FROM ads")
def snk_json(spark: SparkSession, sf: str) -> DataFrame:
    rows = readers.listing_scan(derive(spark, sf, "ads"))
    path = writers.export_array(rows, scratch_path(spark, "json"))
    return readers.json_array(spark, path, readers.EXPORT_SCHEMA) if path else rows.limit(0)


@register("snk_csv", ["ads"], f"SELECT {READ_BACK} FROM ads")
def snk_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = writers.export_csv(derive(spark, sf, "ads"), scratch_path(spark, "csv"))
    return readers.export_csv(spark, path)


@register("snk_csv_localized", ["ads"], f"SELECT {READ_BACK} FROM ads ORDER BY data_coleta DESC NULLS LAST, id")
def snk_csv_localized(spark: SparkSession, sf: str) -> DataFrame:
    path = writers.export_csv_localized(derive(spark, sf, "ads"), scratch_path(spark, "csv-pt"))
    shown = spark.read.options(**readers.CSV_OPTIONS).csv(path)
    return shown.withColumnsRenamed({shown_as: c for c, shown_as in C.CSV_HEADINGS.items()})


def listing_versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Stored listings by native id, and later versions of them."""
    stored = derive(spark, sf, "ads").filter("titulo is not null")
    stored = stored.select(
        F.col("list_id").cast("string").alias("id"), "link", "titulo", "preco", "cidade", "fonte", "seq"
    )
    return stored, derive(spark, sf, "revisions")


UPSERT_INPUTS = ["ads", "revisions"]
UPSERT_EXPECTED = """SELECT id, link, titulo, preco, cidade, fonte FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC, preco DESC) AS rn FROM (
    SELECT CAST(list_id AS VARCHAR) AS id, link, titulo, preco, cidade, fonte, seq FROM ads
    WHERE titulo IS NOT NULL
    UNION ALL
    SELECT id, link, titulo, preco, NULL, fonte, seq FROM revisions WHERE titulo IS NOT NULL))
  WHERE rn = 1"""
VERSION_ORDER = ["seq", "preco"]


@register(
    "snk_listing_upsert", UPSERT_INPUTS,
    f"""SELECT *, 'accepted' AS verdict FROM ({UPSERT_EXPECTED}) UNION ALL
        SELECT id, link, titulo, preco, NULL, fonte, 'rejected' FROM revisions WHERE titulo IS NULL""",
)
def snk_listing_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The stored table, versions added to it, and both compacted; rows the table does not take, on the side."""
    stored, incoming = listing_versions(spark, sf)
    path, side = scratch_path(spark, "listing-table"), scratch_path(spark, "listing-rejects")
    incoming = incoming.withColumn("cidade", F.lit(None).cast("string")).select(*stored.columns)
    table = ListingTable(spark, path, VERSION_ORDER).create(stored, single=True)
    table.add(dedup.accepted(incoming))
    writers.rejects(dedup.rejected(incoming), side)
    table.compact()
    columns = ["id", "link", "titulo", "preco", "cidade", "fonte"]
    newest = table.rows().select(*columns, F.lit("accepted").alias("verdict"))
    rejects = spark.read.schema(stored.schema).parquet(side).select(*columns, F.lit("rejected").alias("verdict"))
    return newest.unionByName(rejects)


def queued_and_found(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    queued = queue.as_links(derive(spark, sf, "link_events").select("url"))
    found = queue.as_links(derive(spark, sf, "ads").select(F.col("link").alias("url")))
    return queued, found


FIRST_FOUND = f"""SELECT md5(url) AS id, url, {QUEUE_DOMAIN} AS domain, keyword, data_add FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY place) AS rn FROM (
    SELECT link AS url, 'apartamento ' || lower(coalesce(cidade, 'centro')) AS keyword, data_coleta AS data_add,
      1000000000 + list_id AS place FROM ads WHERE link IS NOT NULL
    UNION ALL SELECT url, CAST(NULL AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S'), event_id - 1000000000 FROM link_events)) WHERE rn = 1"""


@register("snk_link_insert_ignore", ["ads", "link_events"], FIRST_FOUND)
def snk_link_insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    """Queued links first; a link keeps the keyword and date it was first found with."""
    events = derive(spark, sf, "link_events")
    day = text.prefix(F.col("ts").cast("string"), 19).alias("data_add")
    queued = queue.as_links(events.select("url", day, "event_id"), order="event_id")
    word = F.concat(F.lit("apartamento "), F.lower(F.coalesce("cidade", F.lit("centro"))))
    hits = derive(spark, sf, "ads").select(F.col("link").alias("url"), word.alias("keyword"), F.col("data_coleta").alias("data_add"), "list_id")
    found = queue.as_links(hits, order="list_id")
    path = scratch_path(spark, "queue")
    queued.write.mode("append").parquet(path)
    queue.insert_ignore(spark.read.schema(queued.schema).parquet(path), found).write.parquet(f"{path}-new")
    stored = spark.read.schema(queued.schema).parquet(path, f"{path}-new")
    return stored.select("id", "url", "domain", "keyword", "data_add")


def stored_events(spark: SparkSession, sf: str) -> DataFrame:
    events = derive(spark, sf, "link_events").select("event_id", "ts", "id", "status")
    path = writers.status_events(events, scratch_path(spark, "events"))
    return spark.read.schema(events.schema).parquet(path)


FOLDED = """SELECT id, max_by(status, (ts, event_id)) AS status,
  count(*) FILTER (WHERE status IN ('retry', 'error')) AS tentativas FROM link_events GROUP BY id"""


@register("snk_link_status", ["link_events"], f"SELECT id, status FROM ({FOLDED})")
def snk_link_status(spark: SparkSession, sf: str) -> DataFrame:
    return queue.fold_status(stored_events(spark, sf)).select("id", "status")


@register("snk_link_attempts", ["link_events"], f"SELECT id, tentativas FROM ({FOLDED})")
def snk_link_attempts(spark: SparkSession, sf: str) -> DataFrame:
    return queue.fold_status(stored_events(spark, sf)).select("id", "tentativas")


def two_exports(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The full export and a later, narrower one that repeats every link."""
    ads = derive(spark, sf, "ads")
    wide = ads.select(*C.EXPORT_COLUMNS, F.lit(0).alias("export"), "list_id")
    narrow = ads.select(
        F.md5(F.concat(F.lit("n"), "id")).alias("id"), "titulo", "preco", "link", "fonte", "data_coleta",
        F.lit(1).alias("export"), "list_id",
    )
    return [wide, narrow]


CONSOLIDATED = """SELECT id, titulo, nullif(preco, '') AS preco, link, fonte, data_coleta FROM (
  SELECT *, row_number() OVER (PARTITION BY coalesce(link, id) ORDER BY export, list_id) AS rn FROM (
    SELECT id, titulo, preco, link, fonte, data_coleta, 0 AS export, list_id FROM ads UNION ALL
    SELECT md5('n' || id), titulo, preco, link, fonte, data_coleta, 1, list_id FROM ads)) WHERE rn = 1"""
EXPORT_ORDER = ["export", "list_id"]


@register("snk_consolidated", ["ads"], CONSOLIDATED)
def snk_consolidated(spark: SparkSession, sf: str) -> DataFrame:
    whole = report.consolidate(*two_exports(spark, sf), order=EXPORT_ORDER)
    path = writers.consolidated_csv(
        whole.select(*C.EXPORT_COLUMNS, "coletado_em"), scratch_path(spark, "consolidated")
    )
    read = readers.export_csv(spark, path)
    return read.select("id", "titulo", "preco", "link", "fonte", "data_coleta")


# ------------------------------------------------------- projections and filters


@register(
    "prj_api_normalize", ["ads"],
    """SELECT md5(CAST(list_id AS VARCHAR)) AS id, titulo, preco, metragem, endereco AS bairro, cidade,
       'PR' AS estado, cep, link, try_cast(data_coleta AS TIMESTAMP) AS timestamp FROM ads""",
)
def prj_api_normalize(spark: SparkSession, sf: str) -> DataFrame:
    items = derive(spark, sf, "ads").select(
        F.col("list_id").alias("id"),
        F.col("titulo").alias("title"),
        F.col("preco").alias("price"),
        F.col("metragem").alias("size"),
        F.struct(F.col("endereco").alias("neighborhood"), F.col("cidade").alias("municipality")).alias("location"),
        F.col("cep").alias("zip"),
        F.col("link").alias("url"),
        "data_coleta",
    )
    return cap.api_items(items, "pr", text.iso_time(F.col("data_coleta")))


@register(
    "prj_bank_rename", ["ads"],
    f"""SELECT cidade, uf, CAST(NULL AS VARCHAR) AS bairro, endereco, CAST(NULL AS VARCHAR) AS valor_avaliacao,
        valorminimo AS valor_minimo, areaprivativa AS area_total, CAST(NULL AS VARCHAR) AS tipo_imovel,
        CAST(NULL AS VARCHAR) AS modalidade_venda, urldetalhes AS link_edital, 'Caixa' AS fonte
        FROM ({BANK_EXPECTED})""",
)
def prj_bank_rename(spark: SparkSession, sf: str) -> DataFrame:
    return cap.bank_listings(cap.bank_rows(derive(spark, sf, "bank_responses")))


@register("prj_export_columns", ["ads"], f"SELECT {EXPORT} FROM ads")
def prj_export_columns(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spark, sf, "ads").select(*C.EXPORT_COLUMNS)


@register(
    "prj_truncate", None,
    """SELECT doc_id, substr(text, 1, 500) AS raw_text, substr(text, 1, 150) AS titulo,
       substr(text, 1, 100) AS titulo_card FROM documents""",
)
def prj_truncate(spark: SparkSession, sf: str) -> DataFrame:
    body = F.col("text")
    return readers.table(spark, sf, "documents").select(
        "doc_id",
        text.prefix(body, C.RAW_TEXT_CHARS).alias("raw_text"),
        text.prefix(body, C.TITLE_CHARS).alias("titulo"),
        text.prefix(body, C.CARD_TITLE_CHARS).alias("titulo_card"),
    )


@register("prj_site_from_url", ["ads"], "SELECT list_id, CASE WHEN link IS NULL THEN NULL ELSE fonte END AS site FROM ads")
def prj_site_from_url(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spark, sf, "ads").select("list_id", urls.site_label(F.col("link")).alias("site"))


@register("flt_min_length", None, "SELECT page_id, url FROM pages WHERE length(html) >= 1000")
def flt_min_length(spark: SparkSession, sf: str) -> DataFrame:
    return extract.usable_pages(readers.pages(spark, sf), 1000).select("page_id", "url")


@register(
    "flt_any_field", ["ads"],
    "SELECT list_id FROM ads WHERE nullif(preco, '') IS NOT NULL OR cep IS NOT NULL OR contato IS NOT NULL",
)
def flt_any_field(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spark, sf, "ads").filter(extract.any_field("preco", "cep", "contato")).select("list_id")


@register("flt_all_fields", ["ads"], "SELECT list_id FROM ads WHERE titulo IS NOT NULL AND preco IS NOT NULL")
def flt_all_fields(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spark, sf, "ads").filter(extract.all_fields("titulo", "preco")).select("list_id")


def current_queue(spark: SparkSession, sf: str) -> DataFrame:
    """Every known link with its folded status."""
    found = derive(spark, sf, "ads").select(F.col("link").alias("url"))
    return queue.known_links(found, derive(spark, sf, "link_events"))


QUEUE_INPUTS = ["ads", "link_events"]
QUEUE = f"""(SELECT l.id, l.url, l.domain, coalesce(f.status, 'pending') AS status,
  coalesce(f.tentativas, 0) AS tentativas FROM (
    SELECT DISTINCT md5(url) AS id, url, {QUEUE_DOMAIN} AS domain FROM (
      SELECT link AS url FROM ads WHERE link IS NOT NULL UNION ALL SELECT url FROM link_events)) l
  LEFT JOIN ({FOLDED}) f ON l.id = f.id)"""


@register(
    "flt_pending_links", QUEUE_INPUTS,
    f"SELECT url, status, tentativas FROM {QUEUE} WHERE status IN ('pending', 'retry') AND tentativas < 3",
)
def flt_pending_links(spark: SparkSession, sf: str) -> DataFrame:
    return queue.pending(current_queue(spark, sf)).select("url", "status", "tentativas")


@register("flt_http_ok", ["captures"], "SELECT entry_id, url FROM captures WHERE status = 200 AND length(text) > 0")
def flt_http_ok(spark: SparkSession, sf: str) -> DataFrame:
    return cap.answered(derive(spark, sf, "captures")).select("entry_id", "url")


@register(
    "flt_engine_urls", ["redirects"],
    "SELECT list_id, href FROM redirects WHERE href NOT LIKE '%bing.com%' AND href NOT LIKE '%microsoft%'",
)
def flt_engine_urls(spark: SparkSession, sf: str) -> DataFrame:
    hrefs = derive(spark, sf, "redirects").select("list_id", "href")
    return hrefs.filter(~urls.is_engine_url(F.col("href")))


@register(
    "flt_domain_contains", ["redirects"],
    "SELECT list_id, href FROM redirects WHERE href LIKE 'http%' AND href LIKE '%olx.com.br%'",
)
def flt_domain_contains(spark: SparkSession, sf: str) -> DataFrame:
    hrefs = derive(spark, sf, "redirects").select("list_id", "href")
    return hrefs.filter(urls.contains_domain(F.col("href"), F.lit("olx.com.br")))


@register(
    "flt_api_endpoint", ["captures"],
    "SELECT DISTINCT url FROM captures WHERE lower(url) LIKE '%api%' AND lower(url) LIKE '%olx%'",
)
def flt_api_endpoint(spark: SparkSession, sf: str) -> DataFrame:
    return cap.api_endpoints(derive(spark, sf, "captures"))


@register("flt_present", ["ads"], "SELECT list_id, preco FROM ads WHERE preco IS NOT NULL AND preco <> ''")
def flt_present(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spark, sf, "ads").select("list_id", "preco").filter(text.present(F.col("preco")))


@register(
    "flt_blocked_page", ["ad_pages"],
    """SELECT page_id, url, CASE WHEN page_id % 4 = 3
         THEN CASE page_id % 20 WHEN 7 THEN 'short' WHEN 11 THEN 'empty' ELSE 'challenge' END ELSE 'ok' END AS state FROM ad_pages""",
)
def flt_blocked_page(spark: SparkSession, sf: str) -> DataFrame:
    return extract.classify_pages(derive(spark, sf, "ad_pages"))


@register(
    "flt_title_not_null", ["revisions"],
    """SELECT id, preco, seq, 'accepted' AS verdict FROM revisions WHERE titulo IS NOT NULL
       UNION ALL SELECT id, preco, seq, 'rejected' FROM revisions WHERE titulo IS NULL""",
)
def flt_title_not_null(spark: SparkSession, sf: str) -> DataFrame:
    incoming = derive(spark, sf, "revisions").select("id", "titulo", "preco", "seq")
    return incoming.withColumn("verdict", dedup.verdict()).drop("titulo")


# ----------------------------------------------------------------------- joins


@register(
    "jn_links_new_only", QUEUE_INPUTS,
    """SELECT DISTINCT md5(link) AS id, link AS url FROM ads
       WHERE link IS NOT NULL AND link NOT IN (SELECT url FROM link_events)""",
)
def jn_links_new_only(spark: SparkSession, sf: str) -> DataFrame:
    queued, found = queued_and_found(spark, sf)
    return queue.insert_ignore(queued, found).select("id", "url")


@register("jn_listing_upsert", UPSERT_INPUTS, UPSERT_EXPECTED)
def jn_listing_upsert(spark: SparkSession, sf: str) -> DataFrame:
    stored, incoming = listing_versions(spark, sf)
    table = dedup.upsert(stored, incoming, VERSION_ORDER)
    return table.select("id", "link", "titulo", "preco", "cidade", "fonte")


@register("jn_status_update", QUEUE_INPUTS, f"SELECT id, url, status, tentativas FROM {QUEUE}")
def jn_status_update(spark: SparkSession, sf: str) -> DataFrame:
    return current_queue(spark, sf).select("id", "url", "status", "tentativas")


@register(
    "jn_seen_links", ["crawl_links"],
    "SELECT site, link, min(page) AS page FROM crawl_links GROUP BY site, link",
)
def jn_seen_links(spark: SparkSession, sf: str) -> DataFrame:
    return discover.first_seen(derive(spark, sf, "crawl_links"))


@register(
    "jn_keyword_domain_cross", ["keywords"],
    "SELECT keyword, domain, 'site:' || domain || ' ' || keyword AS query FROM keywords, (VALUES "
    + ", ".join(f"('{p}')" for p in C.PORTALS) + ") p(domain)",
)
def jn_keyword_domain_cross(spark: SparkSession, sf: str) -> DataFrame:
    return queue.search_tasks(derive(spark, sf, "keywords")).select("keyword", "domain", "query")


@register("jn_keyword_gazetteer", ["keywords"], f"SELECT keyword, cidade, estado, tipo FROM {PLACED}")
def jn_keyword_gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    return discover.keyword_places(derive(spark, sf, "keywords").select("keyword"))


@register(
    "jn_url_domain", ["ads"],
    f"SELECT list_id, {QUEUE_DOMAIN.replace('url', 'link')} AS domain FROM ads WHERE link IS NOT NULL",
)
def jn_url_domain(spark: SparkSession, sf: str) -> DataFrame:
    ads = derive(spark, sf, "ads").filter("link is not null")
    return ads.select("list_id", urls.queue_domain(F.col("link")).alias("domain"))


# ---------------------------------------------------------------- aggregations


@register("ag_total", ["ads"], "SELECT count(*) AS n FROM ads")
def ag_total(spark: SparkSession, sf: str) -> DataFrame:
    return report.total(derive(spark, sf, "ads"))


@register(
    "ag_queue_stats", QUEUE_INPUTS,
    f"""SELECT (SELECT count(*) FROM ads) AS listings, count(*) AS links_total, count(*) FILTER (WHERE status = 'done') AS links_done,
        count(*) FILTER (WHERE status = 'error') AS links_error,
        count(*) FILTER (WHERE status NOT IN ('done', 'error')) AS links_pending FROM {QUEUE}""",
)
def ag_queue_stats(spark: SparkSession, sf: str) -> DataFrame:
    return queue.stats(derive(spark, sf, "ads"), current_queue(spark, sf))


@register(
    "ag_queue_stats_report", QUEUE_INPUTS,
    f"""SELECT (SELECT count(*) FROM ads) AS listings, count(*) AS links,
        count(*) FILTER (WHERE status = 'done') AS done,
        count(*) FILTER (WHERE status = 'pending') AS pending FROM {QUEUE}""",
)
def ag_queue_stats_report(spark: SparkSession, sf: str) -> DataFrame:
    return queue.stats_report(derive(spark, sf, "ads"), current_queue(spark, sf))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Pages to listings to newest version per key to counts by source."""
    found = extract.listings(derive(spark, sf, "ad_pages"))
    table = dedup.first_by(found.select("id", "page_id", "fonte"), ["id"], ["page_id"])
    return report.by_source(table)


@register(
    "ag_by_source", ["ad_pages", "ads"],
    f"SELECT fonte, count(DISTINCT {EX_KEY}) AS n FROM {EXTRACTED} GROUP BY fonte",
)
def ag_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return flagship(spark, sf)


@register("ag_by_state", ["ads"], "SELECT estado, count(*) AS n FROM ads GROUP BY estado")
def ag_by_state(spark: SparkSession, sf: str) -> DataFrame:
    return report.by_state(derive(spark, sf, "ads"))


@register(
    "ag_by_state_upper", ["ads"],
    "SELECT upper(estado) AS estado, count(*) AS n FROM ads WHERE estado IS NOT NULL GROUP BY upper(estado)",
)
def ag_by_state_upper(spark: SparkSession, sf: str) -> DataFrame:
    return report.by_state_upper(derive(spark, sf, "ads"))


TOP_CITIES = "SELECT cidade, count(*) AS n FROM ads GROUP BY cidade ORDER BY n DESC, cidade NULLS FIRST LIMIT 5"


@register("ag_top_cities", ["ads"], TOP_CITIES)
def ag_top_cities(spark: SparkSession, sf: str) -> DataFrame:
    return report.top_cities(derive(spark, sf, "ads"))


@register("ag_distinct_sources", ["ads"], "SELECT count(DISTINCT fonte) AS n FROM ads")
def ag_distinct_sources(spark: SparkSession, sf: str) -> DataFrame:
    return report.distinct_count(derive(spark, sf, "ads"), "fonte")


@register("ag_distinct_cities", ["ads"], "SELECT count(DISTINCT cidade) AS n FROM ads")
def ag_distinct_cities(spark: SparkSession, sf: str) -> DataFrame:
    return report.distinct_count(derive(spark, sf, "ads"), "cidade")


COVERAGE = " UNION ALL ".join(
    f"""SELECT '{c}' AS campo, count(*) AS total, count(nullif({c}, '')) AS preenchidos,
        CAST(CASE WHEN count(*) > 0 THEN round(count(nullif({c}, '')) * 100.0 / count(*), 1) ELSE 0 END AS DOUBLE) AS pct
        FROM ads"""
    for c in C.CONSOLIDATED_FIELDS
)


@register("ag_field_coverage", ["ads"], COVERAGE)
def ag_field_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return report.coverage(derive(spark, sf, "ads"), C.CONSOLIDATED_FIELDS)


@register(
    "ag_price_range_cast", ["ads"],
    r"""SELECT min(v) AS minimo, max(v) AS maximo FROM (SELECT CASE WHEN preco IS NULL THEN NULL ELSE
        coalesce(try_cast(nullif(regexp_extract(replace(preco, 'R$ ', ''), '^\s*([+-]?\d+(?:\.\d+)?)', 1), '') AS DOUBLE), 0.0)
        END AS v FROM ads)""",
)
def ag_price_range_cast(spark: SparkSession, sf: str) -> DataFrame:
    return report.price_range_cast(derive(spark, sf, "ads"))


@register(
    "ag_price_stats", ["ads"],
    """SELECT count(valor) AS n, CAST(min(valor) AS DOUBLE) AS minimo, CAST(max(valor) AS DOUBLE) AS maximo,
       round(CAST(sum(valor) AS DOUBLE) / count(valor), 2) AS media FROM ads""",
)
def ag_price_stats(spark: SparkSession, sf: str) -> DataFrame:
    return report.price_stats(derive(spark, sf, "ads"))


@register(
    "ag_ingest_by_domain", ["ads"],
    f"""SELECT {QUEUE_DOMAIN.replace('url', 'link')} AS domain, count(*) AS n FROM ads
        WHERE link IS NOT NULL AND link <> '' GROUP BY 1""",
)
def ag_ingest_by_domain(spark: SparkSession, sf: str) -> DataFrame:
    return queue.ingested_by_domain(derive(spark, sf, "ads"))


@register(
    "ag_load_delta", UPSERT_INPUTS,
    f"""SELECT b AS antes, a AS depois, a - b AS adicionados FROM
        (SELECT count(*) AS b FROM ads WHERE titulo IS NOT NULL),
        (SELECT count(*) AS a FROM ({UPSERT_EXPECTED}))""",
)
def ag_load_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Counted by the job that writes the load into the stored table, which is not scanned for it."""
    stored, incoming = listing_versions(spark, sf)
    incoming = incoming.withColumn("cidade", F.lit(None).cast("string"))
    table = ListingTable(spark, scratch_path(spark, "load-table"), VERSION_ORDER).create(stored, single=True)
    table.add(incoming, required="titulo")
    counts = table.compact()
    return spark.range(1).select(*(F.lit(counts[name]).cast("long").alias(name) for name in ("antes", "depois", "adicionados")))


@register(
    "ag_capture_parse_stats", ["ads", "captures"],
    f"""SELECT (SELECT count(*) FROM captures) AS entries, (SELECT count(*) FROM captures WHERE length(text) > 0) AS with_text,
        (SELECT count(*) FROM captures WHERE regexp_matches(text, '"(ad_url|list_id)"')) AS parsed,
        count(url) AS urls, count(DISTINCT url) AS distinct_urls FROM {FOUND_AD_URLS}""",
)
def ag_capture_parse_stats(spark: SparkSession, sf: str) -> DataFrame:
    return cap.parse_stats(derive(spark, sf, "captures"))


@register(
    "ag_capture_profile", ["captures"],
    """SELECT entry_id, CAST(status AS BIGINT) AS status, CAST(length(text) AS BIGINT) AS chars,
       contains(text, 'GalleryGroup') AS has_marker, substr(text, 1, 200) AS preview FROM captures""",
)
def ag_capture_profile(spark: SparkSession, sf: str) -> DataFrame:
    return cap.profile(derive(spark, sf, "captures")).withColumn("status", F.col("status").cast("bigint"))


ANCHOR_TEXT = """(SELECT list_id // 25 AS page_id, list_id % 25 AS pos, CASE list_id % 4
  WHEN 0 THEN 'https://www.' || host || '/vi/' || list_id || '?utm=1'
  WHEN 1 THEN 'https://www.bing.com/ck/a?!&&p=x&u=a1https3A%2F%2Fwww.' || host || '%2Fvi%2F' || list_id || '&ntb=1'
  WHEN 2 THEN 'https://www.bing.com/rdr.asp?ref=https%3A%2F%2Fwww.' || host || '%2Fvi%2F' || list_id
  ELSE 'https://www.bing.com/search?first=' || list_id END AS href, host AS domain, list_id % 4 AS style,
  list_id FROM ads)"""


@register(
    "ag_anchor_counts", ["ads"],
    f"""SELECT domain, count(*) AS anchors,
        string_agg(href, ' ' ORDER BY page_id, pos) FILTER (WHERE rn <= 8) AS samples FROM (
          SELECT *, row_number() OVER (PARTITION BY domain ORDER BY page_id, pos) AS rn
          FROM {ANCHOR_TEXT} WHERE style <> 3 AND domain <> 'anuncios.example.com') GROUP BY domain
        UNION ALL SELECT NULL, (SELECT count(*) FROM ads), NULL""",
)
def ag_anchor_counts(spark: SparkSession, sf: str) -> DataFrame:
    return discover.anchor_counts(derive(spark, sf, "result_pages"))


def _count_tags(pattern: str) -> str:
    cleaned = (
        r"regexp_replace(html, '(?is)<script\b.*?</script\s*>|<!--.*?-->', '', 'g')"
    )
    return f"len(regexp_extract_all({cleaned}, '{pattern}'))"


@register(
    "ag_selector_counts", None,
    "SELECT page_id, selector, n FROM ("
    + " UNION ALL ".join(
        f"SELECT page_id, '{name}' AS selector, CAST({_count_tags(pattern.replace('(?iu)', '(?i)'))} AS BIGINT) AS n FROM pages"
        for name, pattern in C.PROBED_SELECTORS
    )
    + ") WHERE n > 0",
)
def ag_selector_counts(spark: SparkSession, sf: str) -> DataFrame:
    return cards.selector_counts(readers.pages(spark, sf))


@register(
    "ag_prices_per_page", ["ad_pages"],
    r"""SELECT page_id, CAST(len(p) AS BIGINT) AS n, array_to_string(p[1:3], ' | ') AS exemplos
        FROM (SELECT page_id, regexp_extract_all(html, 'R\$\s*[\d.,]+') AS p FROM ad_pages)""",
)
def ag_prices_per_page(spark: SparkSession, sf: str) -> DataFrame:
    return report.prices_per_page(derive(spark, sf, "ad_pages"))


@register(
    "ag_rows_per_file", ["ads"],
    """SELECT CAST(seq // 3650000000000000 AS VARCHAR) AS arquivo, count(*) AS n FROM ads GROUP BY 1
       UNION ALL SELECT 'total', count(*) FROM ads
       UNION ALL SELECT 'unicos', count(DISTINCT link) + max(CASE WHEN link IS NULL THEN 1 ELSE 0 END) FROM ads""",
)
def ag_rows_per_file(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "exports")
    exports = derive(spark, sf, "ads").withColumn("lote", F.expr("seq div 3650000000000000"))
    writers.export_csv_by(exports, "lote", path)
    rows = readers.export_csv(spark, f"{path}/*")
    batch = F.regexp_extract("_metadata.file_path", "lote=([0-9]+)", 1)
    return report.rows_per_file(rows.select("link", batch.alias("arquivo_lote")), name="arquivo_lote")


@register(
    "ag_by_keyword", ["search_hits"],
    """SELECT t.keyword, t.results, coalesce(u.new_ids, 0) AS new_ids FROM
       (SELECT keyword, count(*) AS results FROM search_hits GROUP BY keyword) t LEFT JOIN
       (SELECT keyword, count(*) AS new_ids FROM (SELECT id, min(keyword) AS keyword FROM search_hits GROUP BY id)
        GROUP BY keyword) u ON t.keyword = u.keyword""",
)
def ag_by_keyword(spark: SparkSession, sf: str) -> DataFrame:
    return discover.keyword_results(derive(spark, sf, "search_hits"))


# --------------------------------------------------- windows and deduplication

ID_COLUMNS = ["id", "list_id", "titulo", "preco"]


def _one_per(key: str, order: str, columns: list[str], source: str = "ads") -> str:
    return f"""SELECT {col_list(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn
        FROM {source}) WHERE rn = 1"""


@register("wn_dedup_first_id", ["ads"], _one_per("id", "seq", ID_COLUMNS))
def wn_dedup_first_id(spark: SparkSession, sf: str) -> DataFrame:
    rows = derive(spark, sf, "ads").select(*ID_COLUMNS, "seq")
    return dedup.first_by(rows, ["id"], ["seq"]).drop("seq")


@register("wn_dedup_last_id", ["ads"], _one_per("id", "seq DESC", ID_COLUMNS))
def wn_dedup_last_id(spark: SparkSession, sf: str) -> DataFrame:
    rows = derive(spark, sf, "ads").select(*ID_COLUMNS, "seq")
    return dedup.last_by(rows, ["id"], ["seq"]).drop("seq")


@register("wn_dedup_first_link", ["ads"], _one_per("link", "seq", ["link", "id", "list_id"]))
def wn_dedup_first_link(spark: SparkSession, sf: str) -> DataFrame:
    rows = derive(spark, sf, "ads").select("link", "id", "list_id", "seq")
    return dedup.first_by_link(rows, ["seq"], merge_null_links=True).drop("seq")


@register(
    "wn_dedup_list_id", ["captures"],
    "SELECT list_id AS id, ad_url AS link, titulo, preco, cidade, upper(estado) AS estado, 'OLX' AS fonte, '2025-01-01' AS data_coleta FROM ("
    + _one_per("list_id", "entry_id, pos", ["list_id", "ad_url", "titulo", "preco", "cidade", "estado"], CAPTURE_ADS) + ")",
)
def wn_dedup_list_id(spark: SparkSession, sf: str) -> DataFrame:
    """The capture route: ads found, one row an id, in the short listing layout."""
    ads = cap.ads_by_pattern(derive(spark, sf, "captures"))
    unique = dedup.first_by(ads, ["list_id"], ["entry_id", "pos"])
    rows = cap.as_listings(unique, "2025-01-01")
    return rows.select("id", "link", "titulo", "preco", "cidade", "estado", "fonte", "data_coleta")


@register(
    "wn_links_per_domain", ["search_hits"],
    """SELECT keyword, domain, url, pos FROM (
         SELECT *, row_number() OVER (PARTITION BY keyword, domain ORDER BY pos, url) AS rn FROM (
           SELECT keyword, domain, url, min(pos) AS pos FROM search_hits GROUP BY ALL)) WHERE rn <= 5""",
)
def wn_links_per_domain(spark: SparkSession, sf: str) -> DataFrame:
    return queue.links_per_domain(derive(spark, sf, "search_hits"))


@register(
    "wn_new_links_per_page", ["crawl_links"],
    """SELECT site, page, found, new FROM (SELECT *, min(CASE WHEN new = 0 THEN page END) OVER (PARTITION BY site) AS stop
         FROM (SELECT t.site, t.page, t.found, coalesce(f.new, 0) AS new FROM
           (SELECT site, page, count(DISTINCT link) AS found FROM crawl_links GROUP BY ALL) t LEFT JOIN
           (SELECT site, page, count(*) AS new FROM (SELECT site, link, min(page) AS page FROM crawl_links GROUP BY ALL)
            GROUP BY ALL) f ON t.site = f.site AND t.page = f.page)) WHERE stop IS NULL OR page <= stop""",
)
def wn_new_links_per_page(spark: SparkSession, sf: str) -> DataFrame:
    return discover.new_links_per_page(derive(spark, sf, "crawl_links"))


@register("wn_latest_by_key", ["revisions"], _one_per("id", "seq DESC, preco DESC", ["id", "titulo", "preco"], "revisions"))
def wn_latest_by_key(spark: SparkSession, sf: str) -> DataFrame:
    versions = derive(spark, sf, "revisions").select("id", "titulo", "preco", "seq")
    return dedup.latest(versions, order=("seq", "preco")).drop("seq")


# ------------------------------------------------------- sorts, limits and top-k


@register(
    "sl_recent_first", ["ads"],
    "SELECT list_id, try_cast(data_coleta AS TIMESTAMP) AS coletado_em FROM ads ORDER BY 2 DESC NULLS LAST, list_id",
)
def sl_recent_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = derive(spark, sf, "ads").select("list_id", "data_coleta")
    return report.recent_first(rows, tie="list_id").select(
        "list_id", "coletado_em"
    )


@register("sl_by_id", ["ads"], "SELECT id, titulo, preco, cidade, estado, link FROM ads ORDER BY id, list_id")
def sl_by_id(spark: SparkSession, sf: str) -> DataFrame:
    rows = derive(spark, sf, "ads").orderBy("id", "list_id")
    return rows.select("id", "titulo", "preco", "cidade", "estado", "link")


@register("sl_topk_count", ["ads"], "SELECT metragem, count(*) AS n FROM ads GROUP BY metragem ORDER BY n DESC, metragem LIMIT 5")
def sl_topk_count(spark: SparkSession, sf: str) -> DataFrame:
    return report.count_by(derive(spark, sf, "ads"), "metragem", "metragem").limit(5)


@register("sl_limit", ["ads"], "SELECT list_id, titulo, preco FROM ads ORDER BY list_id LIMIT 72")
def sl_limit(spark: SparkSession, sf: str) -> DataFrame:
    return report.first_rows(derive(spark, sf, "ads").select("list_id", "titulo", "preco"), ["list_id"], 72)


@register("sl_last_n", ["ads"], "SELECT list_id, seq, titulo FROM ads ORDER BY seq DESC LIMIT 5")
def sl_last_n(spark: SparkSession, sf: str) -> DataFrame:
    return report.last_rows(derive(spark, sf, "ads").select("list_id", "seq", "titulo"), ["seq"])


@register("sl_global_cap", ["search_hits"], "SELECT keyword, url, pos FROM search_hits ORDER BY pos, keyword, url LIMIT 50")
def sl_global_cap(spark: SparkSession, sf: str) -> DataFrame:
    hits = derive(spark, sf, "search_hits").select("keyword", "url", "pos")
    return report.first_rows(hits, ["pos", "keyword", "url"], C.MAX_RESULTS)


# ------------------------------------------------------------------ set operations


@register(
    "so_union_all", UPSERT_INPUTS,
    """SELECT id, titulo, preco, cidade, seq FROM ads UNION ALL SELECT id, titulo, preco, NULL, seq FROM revisions""",
)
def so_union_all(spark: SparkSession, sf: str) -> DataFrame:
    stored = derive(spark, sf, "ads").select("id", "titulo", "preco", "cidade", "seq")
    return dedup.union_all(stored, derive(spark, sf, "revisions").select("id", "titulo", "preco", "seq"))


@register("so_distinct", ["crawl_links"], "SELECT DISTINCT link FROM crawl_links")
def so_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return derive(spark, sf, "crawl_links").select("link").distinct()


@register("so_distinct_ordered", ["search_hits"], "SELECT url, min(pos) AS first_pos FROM search_hits GROUP BY url ORDER BY first_pos, url")
def so_distinct_ordered(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.distinct_in_order(derive(spark, sf, "search_hits"), "url", "pos").orderBy("first_pos", "url")


@register("so_consolidate", ["ads"], CONSOLIDATED + " ORDER BY try_cast(data_coleta AS TIMESTAMP) DESC NULLS LAST, id")
def so_consolidate(spark: SparkSession, sf: str) -> DataFrame:
    whole = report.consolidate(*two_exports(spark, sf), order=EXPORT_ORDER)
    return whole.select(
        "id", "titulo", text.none_if_empty(F.col("preco")).alias("preco"), "link", "fonte", "data_coleta"
    )

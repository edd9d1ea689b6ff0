"""Recorded API responses to ads, URLs and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.functions import jsons, keys, text
from garimpo.functions.payload import payload_ad_urls, payload_kind, payload_summary, salvaged_objects
from garimpo.functions.steps import computed

NESTED_SCHEMA = (
    "array<struct<content:array<struct<content:array<struct<ad_url:string,list_id:bigint>>>>>>"
)
BANK_SCHEMA = "imoveis array<struct<" + ",".join(f"{f}:string" for f, _ in C.BANK_FIELDS) + ">>"


def answered(captures: DataFrame) -> DataFrame:
    """Entries that were answered with a text."""
    return captures.filter((F.col("status") == 200) & (F.length("text") > 0))


def api_endpoints(captures: DataFrame) -> DataFrame:
    """Distinct URLs that look like the portal's API."""
    low = F.lower("url")
    return (
        captures.filter(low.contains("api") & low.contains("olx"))
        .select(text.strip(F.col("url")).alias("url"))
        .distinct()
    )


def ads_by_pattern(captures: DataFrame) -> DataFrame:
    """Six fields per ad by one pattern over the payload text."""
    ads = answered(captures).select(
        "entry_id", F.posexplode(F.regexp_extract_all("text", F.lit(C.CAPTURE_AD), F.lit(0))).alias("pos", "m")
    )
    # The match starts with the id and holds the first of each later key behind the one before, so each key's
    # value follows from the rest of the match by a pattern of its own.
    row = ads.select("entry_id", "pos", F.regexp_extract("m", r'^"list_id":(\d+)', 1).alias("list_id"), F.col("m").alias("rest"))
    for key, name in C.CAPTURE_KEYS:
        mark = f'"{key}":"'
        at = F.instr("rest", mark) + len(mark)
        row = row.withColumn("rest", F.substring("rest", at, F.length("rest")))
        row = row.withColumn(name, F.substring_index("rest", '"', 1))
    return row.select("entry_id", "pos", "list_id", *[name for _, name in C.CAPTURE_KEYS])


def salvaged_ads(captures: DataFrame) -> DataFrame:
    """Ads from whole objects of complete or cut-off array payloads.

    A complete array of objects is taken apart by the JSON parser; only other
    texts are sent to the scanner.
    """
    parts = jsons.elements(F.when(F.col("text").startswith("["), F.col("text")))
    read = computed(captures, ["entry_id", "text"], {"parts": parts})
    whole = F.forall("parts", lambda p: p.startswith("{"))
    rest = F.when(~F.coalesce(whole, F.lit(False)), F.col("text"))
    objects = read.select("entry_id", F.explode(F.when(whole, F.col("parts")).otherwise(salvaged_objects(rest))).alias("object"))
    fields = F.from_json(
        "object",
        "list_id string, ad_url string, price string, subject string, municipality string, state_uf string",
        jsons.STRICT,
    )
    return objects.select("entry_id", fields.alias("ad")).select(
        "entry_id", "ad.list_id", "ad.ad_url",
        F.col("ad.price").alias("preco"),
        F.col("ad.subject").alias("titulo"),
        F.col("ad.municipality").alias("cidade"),
        F.col("ad.state_uf").alias("estado"),
    )


def ad_links(captures: DataFrame) -> DataFrame:
    """Distinct ad URLs per entry, one per ad."""
    return captures.filter(F.length("text") > 0).select(
        "entry_id", F.posexplode(payload_ad_urls(F.col("text"))).alias("pos", "url")
    )


def payload_kinds(captures: DataFrame) -> DataFrame:
    """Per entry: which JSON was recognised in the text and how long it is.

    Whole arrays are recognised by the JSON parser, other texts by the scanner.
    """
    read = computed(captures, ["entry_id"], {"body": F.trim("text", F.lit(" \t\n\r\x0b\x0c"))})
    array = computed(read, ["entry_id", "body"], {"is_array": F.col("body").startswith("[") & F.coalesce(jsons.is_valid(F.col("body")), F.lit(False))})
    kind = array.select("entry_id", "is_array", "body", payload_kind(F.when(~F.col("is_array"), F.col("body"))).alias("payload"))
    return kind.select(
        "entry_id",
        F.when(F.col("is_array"), "array").otherwise(F.col("payload.kind")).alias("kind"),
        F.length(F.when(F.col("is_array"), F.col("body")).otherwise(F.col("payload.body"))).cast("bigint").alias("body_chars"),
    )


def nested_ads(captures: DataFrame) -> DataFrame:
    """Ads in two levels of ``content`` arrays."""
    groups = captures.select(
        "entry_id", F.explode(F.from_json("text", NESTED_SCHEMA, jsons.STRICT)).alias("group")
    )
    rows = groups.select("entry_id", F.explode("group.content").alias("row"))
    return rows.select("entry_id", F.inline("row.content"))


def bank_rows(responses: DataFrame) -> DataFrame:
    """Elements of the ``imoveis`` array; a response without it gives none."""
    return responses.select(F.from_json("text", BANK_SCHEMA, jsons.STRICT).alias("r"), "entry_id").select(
        "entry_id", F.inline("r.imoveis")
    )


def bank_listings(rows: DataFrame) -> DataFrame:
    """Bank API fields under their listing names."""
    return rows.select(
        *[F.col(old).alias(new) for old, new in C.BANK_FIELDS], F.lit(C.BANK_SOURCE).alias("fonte")
    )


def api_items(items: DataFrame, state: str, collected_at: Column | None = None) -> DataFrame:
    """API items with nested place flattened, the id hashed and the time they were collected at."""
    return items.select(
        keys.api_key(F.col("id")).alias("id"),
        F.col("title").alias("titulo"),
        F.col("price").alias("preco"),
        F.col("size").alias("metragem"),
        F.col("location.neighborhood").alias("bairro"),
        F.col("location.municipality").alias("cidade"),
        F.lit(state.upper()).alias("estado"),
        F.col("zip").alias("cep"),
        F.col("url").alias("link"),
        (F.current_timestamp() if collected_at is None else collected_at).alias("timestamp"),
    )


def as_listings(ads: DataFrame, collected_at: str) -> DataFrame:
    """Capture ads in the short listing layout; they carry no district or category."""
    return ads.select(
        F.col("list_id").alias("id"),
        F.col("ad_url").alias("link"),
        "titulo", "preco", "cidade",
        F.upper("estado").alias("estado"),
        F.lit("").alias("endereco"),
        F.lit("Categoria: ").alias("descricao"),
        F.lit("OLX").alias("fonte"),
        F.lit(collected_at).alias("data_coleta"),
    ).select(*C.NARROW_COLUMNS)


def profile(captures: DataFrame) -> DataFrame:
    """Per entry: status, text length, marker, preview."""
    return captures.select(
        "entry_id", "status",
        F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("chars"),
        F.coalesce(F.contains("text", F.lit(C.CAPTURE_MARKER)), F.lit(False)).alias("has_marker"),
        text.prefix(F.col("text"), C.PREVIEW_CHARS).alias("preview"),
    )


def parse_stats(captures: DataFrame) -> DataFrame:
    """Entries, recognised payloads, URLs in total and distinct."""
    parsed = captures.select(F.length("text").alias("chars"), payload_summary(F.col("text")).alias("p")).select(
        "chars", "p.kind", "p.urls"
    )
    exploded = parsed.select("chars", "kind", F.posexplode_outer("urls").alias("pos", "url"))
    first = F.coalesce("pos", F.lit(0)) == 0
    return exploded.agg(
        F.count_if(first).alias("entries"),
        F.count_if(first & (F.col("chars") > 0)).alias("with_text"),
        F.count_if(first & F.col("kind").isNotNull()).alias("parsed"),
        F.count("url").alias("urls"),
        F.countDistinct("url").alias("distinct_urls"),
    )

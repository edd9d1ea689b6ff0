"""The URL queue: an append-only event log and the views folded from it.

A status update is an appended event. The latest status of a link is an
aggregate over its events, so updates never rewrite a table and a link with
very many events is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.functions import keys, urls
from garimpo.operators.dedup import top_n


def as_links(found: DataFrame, keyword: str | None = None, order: str | None = None) -> DataFrame:
    """Queue rows for found URLs, each URL once, with the keyword and date it was first found with.

    ``found`` has ``url`` and may have ``keyword`` and ``data_add``; ``keyword``
    stands in where a row has none. The first row is that of the smallest
    ``order`` value, if an order column is named, else of the smallest date and keyword.
    """
    text = F.lit(None).cast("string")
    rows = found.filter("url is not null").select(
        "url",
        F.coalesce(F.col("keyword") if "keyword" in found.columns else text, F.lit(keyword)).alias("keyword"),
        (F.col("data_add") if "data_add" in found.columns else text).alias("data_add"),
        *([F.col(order).alias("place")] if order else []),
    )
    if "keyword" in found.columns or "data_add" in found.columns:
        place = ["place"] if order else []
        rows = rows.groupBy("url").agg(F.min(F.struct(*place, "data_add", "keyword")).alias("first"))
        rows = rows.select("url", "first.keyword", "first.data_add")
    else:  # nothing to choose between: a plain hash aggregate
        rows = rows.select("url", "keyword", "data_add").distinct()
    return rows.select(
        keys.link_key(F.col("url")).alias("id"),
        "url",
        urls.queue_domain(F.col("url")).alias("domain"),
        "keyword",
        "data_add",
        F.lit(C.STATUS_PENDING).alias("status"),
        F.lit(0).alias("tentativas"),
    )


def insert_ignore(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of ``incoming``, which has one row per id, whose id is not queued yet."""
    return incoming.join(existing.select("id"), "id", "left_anti")


def fold_status(events: DataFrame) -> DataFrame:
    """Latest status and number of failed attempts per link id."""
    return events.groupBy("id").agg(
        F.max_by("status", F.struct("ts", "event_id")).alias("status"),
        F.count_if(F.col("status").isin(C.STATUS_RETRY, C.STATUS_ERROR))
        .cast("bigint")
        .alias("tentativas"),
    )


def batch_status(events: DataFrame) -> DataFrame:
    """The events of a batch combined to one row per link, to be folded again with other batches."""
    last = F.max(F.struct("ts", "event_id", "status")).alias("last")
    failed = F.count_if(F.col("status").isin(C.STATUS_RETRY, C.STATUS_ERROR)).cast("bigint")
    combined = events.groupBy("id").agg(last, failed.alias("tentativas"))
    return combined.select("id", "last.ts", "last.event_id", "last.status", "tentativas")


def with_status(links: DataFrame, events: DataFrame) -> DataFrame:
    """Queue rows with the status folded from their events; none means pending."""
    folded = fold_status(events)
    return links.drop("status", "tentativas").join(folded, "id", "left").withColumns(
        {
            "status": F.coalesce("status", F.lit(C.STATUS_PENDING)),
            "tentativas": F.coalesce("tentativas", F.lit(0).cast("bigint")),
        }
    )


def known_links(found: DataFrame, events: DataFrame) -> DataFrame:
    """``id, url, domain, status, tentativas`` of every link found or named by an event, each once.

    As ``with_status`` over the distinct links of both, in one aggregate: each input is scanned once, and a link with
    many rows is combined before the one shuffle. ``events`` has ``url, ts, event_id, status``, ``found`` has ``url``;
    rows without a URL are left out.
    """
    schema = events.schema
    none = [F.lit(None).cast(schema[c].dataType).alias(c) for c in ("ts", "event_id", "status")]
    listed = found.select("url", *none, F.lit(False).alias("told"))
    told = events.select("url", "ts", "event_id", "status", F.lit(True).alias("told"))
    rows = listed.unionByName(told).filter("url is not null")
    last = F.max_by("status", F.when(F.col("told"), F.struct("ts", "event_id")))
    failed = F.count_if(F.col("status").isin(C.STATUS_RETRY, C.STATUS_ERROR)).cast("bigint")
    folded = rows.groupBy("url").agg(last.alias("status"), failed.alias("tentativas"))
    return folded.select(
        keys.link_key(F.col("url")).alias("id"), "url", urls.queue_domain(F.col("url")).alias("domain"),
        F.coalesce("status", F.lit(C.STATUS_PENDING)).alias("status"), "tentativas",
    )


def pending(links: DataFrame, domain: str | None = None, limit: int | None = None) -> DataFrame:
    """Links to process next: waiting or to be retried, with attempts left."""
    ready = links.filter(
        F.col("status").isin(C.STATUS_PENDING, C.STATUS_RETRY)
        & (F.col("tentativas") < C.MAX_ATTEMPTS)
    )
    if domain:
        ready = ready.filter(F.col("domain") == domain)
    return ready if limit is None else ready.orderBy("id").limit(limit)


def _with_listings(listings: DataFrame, links: DataFrame) -> DataFrame:
    """Listings and links as one table of kinds and statuses, to be counted in one pass."""
    none = F.lit(None).cast("string").alias("status")
    return listings.select(F.lit("listing").alias("kind"), none).unionByName(links.select(F.lit("link").alias("kind"), "status"))


def stats(listings: DataFrame, links: DataFrame) -> DataFrame:
    """Listings, and total, done, failed and waiting links, in one pass."""
    return _with_listings(listings, links).agg(
        F.count_if(F.col("kind") == "listing").alias("listings"),
        F.count_if(F.col("kind") == "link").alias("links_total"),
        F.count_if(F.col("status") == C.STATUS_DONE).alias("links_done"),
        F.count_if(F.col("status") == C.STATUS_ERROR).alias("links_error"),
    ).withColumn(
        "links_pending", F.col("links_total") - F.col("links_done") - F.col("links_error")
    )


def stats_report(listings: DataFrame, links: DataFrame) -> DataFrame:
    """Report lines: listings, links, processed, waiting."""
    return _with_listings(listings, links).agg(
        F.count_if(F.col("kind") == "listing").alias("listings"),
        F.count_if(F.col("kind") == "link").alias("links"),
        F.count_if(F.col("status") == C.STATUS_DONE).alias("done"),
        F.count_if(F.col("status") == C.STATUS_PENDING).alias("pending"),
    )


def ingested_by_domain(found: DataFrame) -> DataFrame:
    """Rows with a link, per tagged domain."""
    return (
        found.filter(F.col("link").isNotNull() & (F.col("link") != ""))
        .groupBy(urls.queue_domain(F.col("link")).alias("domain"))
        .agg(F.count("*").alias("n"))
    )


def search_tasks(keywords: DataFrame, domains: list[str] | None = None) -> DataFrame:
    """Every keyword with every target domain, as search queries.

    The domains are a fixed short list, so this is an ``explode`` per keyword.
    """
    listed = F.array(*[F.lit(d) for d in domains or C.PORTALS])
    tasks = keywords.select("keyword", F.posexplode(listed).alias("domain_pos", "domain"))
    query = F.concat(F.lit("site:"), "domain", F.lit(" "), "keyword")
    return tasks.withColumn("query", query).withColumn("search_url", urls.search_url(query))


def links_per_domain(found: DataFrame, n: int = C.LINKS_PER_DOMAIN) -> DataFrame:
    """First ``n`` distinct links for each keyword and domain, in result order."""
    once = found.groupBy("keyword", "domain", "url").agg(F.min("pos").alias("pos"))
    return top_n(once, ["keyword", "domain"], [F.col("pos"), F.col("url")], n)

"""Identity keys of listings and links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def listing_key(titulo: Column, preco: Column, link: Column) -> Column:
    """Hash of title, price and link; a missing part is written ``None``."""
    return F.md5(F.concat(*[F.coalesce(c, F.lit("None")) for c in (titulo, preco, link)]))


def text_key(titulo: Column, preco: Column, url: Column) -> Column:
    """As ``listing_key`` with a missing part left empty."""
    return F.md5(F.concat(*[F.coalesce(c, F.lit("")) for c in (titulo, preco, url)]))


def card_key(titulo: Column, preco: Column, link: Column, page_url: Column) -> Column:
    """Card key: the page stands in for a missing card link."""
    return listing_key(titulo, preco, F.coalesce(F.nullif(link, F.lit("")), page_url))


def offer_key(titulo: Column, preco: Column) -> Column:
    """Key without a link."""
    return F.md5(F.concat(*[F.coalesce(c, F.lit("None")) for c in (titulo, preco)]))


def api_key(item_id: Column) -> Column:
    return F.md5(F.coalesce(item_id.cast("string"), F.lit("None")))


def link_key(url: Column) -> Column:
    return F.md5(url)

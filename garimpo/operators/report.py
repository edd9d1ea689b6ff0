"""Counts, coverage, prices, newest listings and consolidation.

Reports are one aggregation pass each, combined before the shuffle; ordered
reports end in a top-k or a range-partitioned sort with a unique last key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.functions import money, text
from garimpo.operators.dedup import first_by_link, union_all


def total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def count_by(df: DataFrame, key: Column | str, name: str) -> DataFrame:
    """Rows per key, largest first; a null key is a group."""
    key = F.col(key) if isinstance(key, str) else key
    return df.groupBy(key.alias(name)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(name))


def by_source(df: DataFrame) -> DataFrame:
    return count_by(df, "fonte", "fonte")


def by_state(df: DataFrame) -> DataFrame:
    return count_by(df, "estado", "estado")


def by_state_upper(df: DataFrame) -> DataFrame:
    """Counts by upper-case state in state order."""
    return (
        df.filter("estado is not null")
        .groupBy(F.upper("estado").alias("estado"))
        .agg(F.count("*").alias("n"))
        .orderBy("estado")
    )


def top_cities(df: DataFrame, k: int = 5) -> DataFrame:
    return count_by(df, "cidade", "cidade").limit(k)


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Distinct non-null values, exact unless asked otherwise."""
    count = F.approx_count_distinct(column) if approximate else F.countDistinct(column)
    return df.agg(count.alias("n"))


def coverage(df: DataFrame, fields: list[str] = C.COVERAGE_FIELDS) -> DataFrame:
    """Filled count and percentage per field, in one pass; zero for an empty table."""
    counted = df.agg(
        F.count("*").alias("total"),
        *[F.count(text.none_if_empty(F.col(c))).alias(c) for c in fields],
    )
    rows = counted.unpivot(["total"], fields, "campo", "preenchidos")
    share = F.when(
        F.col("total") > 0, F.round(F.col("preenchidos") * 100.0 / F.col("total"), 1)
    ).otherwise(F.lit(0.0))
    return rows.withColumn("pct", share.cast("double"))


def price_stats(df: DataFrame) -> DataFrame:
    """Lowest, highest and mean price; texts that are no price are left out."""
    value = money.money_br(F.col("preco"))
    return df.select(value.alias("valor")).agg(
        F.count("valor").alias("n"),
        F.min("valor").cast("double").alias("minimo"),
        F.max("valor").cast("double").alias("maximo"),
        F.round(F.sum("valor").cast("double") / F.count("valor"), 2).alias("media"),
    )


def price_range_cast(df: DataFrame) -> DataFrame:
    """Price range by numeric prefix, kept for compatibility."""
    value = money.money_naive(F.col("preco"))
    return df.agg(F.min(value).alias("minimo"), F.max(value).alias("maximo"))


def load_delta(stored: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """Rows before an upsert, after it and added: the distinct incoming keys not stored yet.

    ``stored`` has one row per key. Only keys are read, and combined per key before
    the shuffle: a key is new if it was met as incoming only.
    """
    keys = stored.select(key, F.lit(1).alias("old")).unionAll(incoming.select(key, F.lit(0).alias("old")))
    met = keys.groupBy(key).agg(F.max("old").alias("old"))
    return met.agg(
        F.count_if(F.col("old") == 1).alias("antes"), F.count("*").alias("depois"), F.count_if(F.col("old") == 0).alias("adicionados")
    )


def prices_per_page(pages: DataFrame, examples: int = 3) -> DataFrame:
    """Number of price texts on each page with the first few."""
    found = pages.select(
        "page_id", F.regexp_extract_all("html", F.lit(C.PRICE), F.lit(0)).alias("precos")
    )
    return found.select(
        "page_id",
        F.size("precos").cast("bigint").alias("n"),
        F.array_join(F.slice("precos", 1, examples), " | ").alias("exemplos"),
    )


def rows_per_file(df: DataFrame, key: str = "link", name: str = "_metadata.file_name") -> DataFrame:
    """Rows per input file, and under ``total`` and ``unicos`` all rows and those with distinct keys.

    Keys are combined by file first; a null key is one key, as in the deduplication.
    """
    by_key = df.groupBy(F.col(name).alias("arquivo"), F.col(key).alias("k")).agg(F.count("*").alias("n"))
    counted = by_key.groupBy("arquivo").agg(F.sum("n").alias("n"))
    total = counted.agg(F.lit("total").alias("arquivo"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    unique = by_key.select("k").distinct().agg(F.lit("unicos").alias("arquivo"), F.count("*").alias("n"))
    return counted.unionByName(total).unionByName(unique)


def recent_first(df: DataFrame, tie: str = "id") -> DataFrame:
    """Newest first; an unreadable time sorts last, ties by a unique column."""
    return df.withColumn("coletado_em", text.iso_time(F.col("data_coleta"))).orderBy(
        F.desc_nulls_last("coletado_em"), F.asc(tie)
    )


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def last_rows(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def describe_schema(df: DataFrame) -> DataFrame:
    """Column names, types and the row count, from the schema and one count."""
    fields = F.array(
        *[
            F.struct(
                F.lit(i).alias("pos"), F.lit(f.name).alias("coluna"), F.lit(f.dataType.simpleString()).alias("tipo")
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return total(df).select(F.inline(fields), F.col("n").alias("linhas"))


def consolidate(*exports: DataFrame, order: list[str], merge_null_links: bool = False) -> DataFrame:
    """All exports in one table: one row per link, newest first."""
    return recent_first(first_by_link(union_all(*exports), order, merge_null_links))

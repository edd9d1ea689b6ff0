"""Keys, first / last / latest row per key, upsert and insert-ignore.

All "one row per key" operators are ranked windows with a rank limit. Spark puts
a group limit in front of the shuffle for these, so each map task sends at most
``n`` rows per key and a key that holds a large part of the table never meets in
one task. Nulls count as one key, as in the window's grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, by: list, order: list, n: int) -> DataFrame:
    """First ``n`` rows per key in the given order."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def first_by(df: DataFrame, by: list, order: list[str]) -> DataFrame:
    """First row per key."""
    return top_n(df, by, [F.col(c).asc() for c in order], 1)


def last_by(df: DataFrame, by: list, order: list[str]) -> DataFrame:
    """Last row per key."""
    return top_n(df, by, [F.col(c).desc() for c in order], 1)


def first_by_link(df: DataFrame, order: list[str], merge_null_links: bool = False) -> DataFrame:
    """First row per link; rows without a link are kept apart by id unless merged."""
    key: Column = F.col("link") if merge_null_links else F.coalesce("link", "id")
    return top_n(df, [key], [F.col(c).asc() for c in order], 1)


def latest(df: DataFrame, key: str = "id", order: tuple[str, ...] = ("data_coleta", "seq")) -> DataFrame:
    """Newest version of each key in a log of versions."""
    return last_by(df, [key], list(order))


def accepted(incoming: DataFrame) -> DataFrame:
    """Rows the listing table takes: a title is required."""
    return incoming.filter(F.col("titulo").isNotNull())


def rejected(incoming: DataFrame) -> DataFrame:
    """Rows for the side table of rejects."""
    return incoming.filter(F.col("titulo").isNull())


def verdict() -> Column:
    """Accepted or rejected, to count or split both in one pass."""
    return F.when(F.col("titulo").isNotNull(), "accepted").otherwise("rejected")


def upsert(existing: DataFrame, incoming: DataFrame, order: list[str], key: str = "id") -> DataFrame:
    """Insert or replace by key; within ``incoming`` the last row wins.

    The join needs the distinct incoming keys only, so a hot key costs one row
    there and the stored table is not shuffled while those keys are few. Missing
    columns on either side become null.
    """
    taken = accepted(incoming)
    kept = existing.join(taken.select(key).distinct(), key, "left_anti")
    return kept.unionByName(last_by(taken, [key], order), allowMissingColumns=True)


def merged(base: DataFrame, delta: DataFrame, order: list[str], key: str = "id") -> DataFrame:
    """Newest version per key of a table with one row per key and later versions.

    Only keys of the delta are ranked; other rows pass through.
    """
    touched = delta.select(key).distinct()
    untouched = base.join(touched, key, "left_anti")
    ranked = last_by(base.join(touched, key, "left_semi").unionByName(delta), [key], order)
    return untouched.unionByName(ranked)


def union_all(*parts: DataFrame) -> DataFrame:
    """Concatenate tables by column name; a column missing somewhere is null there."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def distinct_in_order(df: DataFrame, value: str, position: str) -> DataFrame:
    """Distinct values with the position of their first appearance."""
    return df.groupBy(value).agg(F.min(position).alias("first_" + position))

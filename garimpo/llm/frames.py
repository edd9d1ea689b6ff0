"""Small helpers on DataFrames shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends there,
    and a lost executor costs nothing that was written."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def set_aside(
    df: DataFrame, names: Iterable[str], used: Iterable[str] = ()
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with columns named like ``names`` (compared as Spark does, without case)
    renamed, so an operator can add columns of those names; the function returned
    drops what the operator added and gives the renamed ones their names back."""
    taken = {n.lower() for n in names} - {n.lower() for n in used}
    moved = {c: f"own_{i}_{c}" for i, c in enumerate(df.columns) if c.lower() in taken}
    order = [moved.get(c, c) for c in df.columns]
    back = {v: k for k, v in moved.items()}

    def restore(out: DataFrame) -> DataFrame:
        return out.select(*(f"`{c}`" for c in order)).withColumnsRenamed(back)

    return df.withColumnsRenamed(moved), restore


def small_hash(key: Column, rows: int, total: int) -> Column:
    """A condition that about ``2 * rows + 1000`` of ``total`` keys meet: those of the smallest hash.

    A sample of the ``rows`` smallest hashes lies among them, unless so few keys
    meet it that all the sample loses is size.
    """
    share = min(1.0, (2 * rows + 1000) / max(1, total))
    return F.xxhash64(key) <= int(-(2**63) + share * (2**64 - 1)) if share < 1 else F.lit(True)

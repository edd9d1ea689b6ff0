"""Evaluate costly columns once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, keep: list[str], fields: dict[str, Column]) -> DataFrame:
    """``keep`` columns plus ``fields``, each field evaluated once per row.

    A filter on a column is pushed below the projection that makes it, which
    repeats its expression: a page would be searched again for every condition.
    Filters do not pass a generator's output, so the fields go through a
    one-element ``inline``. It streams inside the stage and needs no shuffle.
    All of them are evaluated, so give it those a filter or several later
    columns use, and leave the rest to a projection that can be pruned.
    """
    row = F.struct(*[value.alias(name) for name, value in fields.items()])
    # Under a lambda the step gets its own code: with all around it, the method would pass 8,000 bytes, which the JVM never compiles.
    return df.select(*keep, F.inline(F.transform(F.array(row), lambda r: r)))

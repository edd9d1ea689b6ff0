"""Places named in short texts: a gazetteer of any size, matched by equi-joins.

A text names a place if it contains the place's name, letter case and accents aside,
also inside a word. Each place is filed under one piece of its name: the one of
``PIECE`` characters that the fewest places share, or the whole name where that is
shorter. A text is looked up by all its pieces, so the few places it meets are checked
against it and no text is compared with the whole gazetteer. Texts and places meet in
joins of their keys. The gazetteer is broadcast or shuffled by its size; rows of texts are
never broadcast: Spark's guess of their size comes from compressed files and does not see
that a text becomes its pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.functions import text
from garimpo.functions.steps import computed

PIECE = 4


def known_places(spark: SparkSession) -> DataFrame:
    """The fixed cities as a gazetteer, ``ordem, nome, uf``."""
    rows = [F.struct(F.lit(i).alias("ordem"), F.lit(name).alias("nome"), F.lit(uf).alias("uf")) for i, (name, uf) in enumerate(C.CITY_UF)]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def _pieces(folded: str, size: int) -> Column:
    """All runs of ``size`` characters of a text, once each; none of a shorter text."""
    return F.array_distinct(F.regexp_extract_all(folded, F.lit(rf"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def filed(places: DataFrame) -> DataFrame:
    """``piece, ordem, nome, uf, folded``: each place under its rarest piece, the smaller of equally rare ones.

    Places without a name are left out, repeated rows are one.
    """
    named = places.select("ordem", "nome", "uf").filter(F.length("nome") > 0)
    keep = ["ordem", "nome", "uf", "folded"]
    folded = computed(named, keep[:3], {"folded": text.fold(F.col("nome"))})
    pieces = F.when(F.length("folded") < PIECE, F.array("folded")).otherwise(_pieces("folded", PIECE))
    listed = folded.select(*keep, F.explode(pieces).alias("piece"))
    # Counted in a window: a join would hide from Spark how small the index is.
    shared = listed.withColumn("n", F.count("*").over(Window.partitionBy("piece")))
    rarest = shared.groupBy(*keep).agg(F.min(F.struct("n", "piece")).alias("rarest"))
    return rarest.select(F.col("rarest.piece").alias("piece"), *keep)


def first_places(texts: DataFrame, column: str, places: DataFrame, into: str = "place") -> DataFrame:
    """``texts`` with a new column ``into``, the struct ``ordem, nome, uf`` of the first place named in ``column``.

    First is the place of the smallest ``ordem``, then name and state; null where the
    text is null or names none. Equal texts are looked up once, so a text that a third of all rows
    hold is one row until the last join. Only hashes of texts travel with their pieces.
    """
    distinct = texts.select(text.fold(F.col(column)).alias("folded")).filter("folded is not null").distinct()
    keyed = distinct.select(F.xxhash64("folded").alias("key"), "folded")
    pieces = F.concat(*(_pieces("folded", size) for size in range(1, PIECE + 1)))
    asked = keyed.select("key", F.explode(pieces).alias("piece"))
    index = filed(places).withColumnRenamed("folded", "name")
    # Of a left join only the right side can be broadcast. It stays one, as neither this filter nor the check below
    # rules out a missing place by the place alone; no piece is null.
    met = asked.join(index, "piece", "left").filter("name is not null or piece is null")
    met = met.select("key", "name", F.struct("ordem", "nome", "uf").alias("place"))
    # Texts of one hash meet each other's places; the check is on the text itself.
    sure = keyed.join(met.hint("merge"), "key").filter(F.coalesce(F.contains("folded", "name"), F.lit(False)))
    best = sure.groupBy(F.col("folded").alias("_folded")).agg(F.min("place").alias(into))
    return texts.join(best.hint("merge"), text.fold(F.col(column)) == F.col("_folded"), "left").drop("_folded")

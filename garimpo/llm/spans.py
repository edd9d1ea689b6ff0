"""Matches of a pattern with their places, by DataFrame functions.

Spark gives the matches of a pattern (``regexp_extract_all``) and the pieces
between them (``split``) but no offsets. Both walk the text alike, so running
sums of their lengths are the offsets, in code points. Sums over a whole text's
matches are a window over exploded rows, linear in the matches; only short texts
are summed in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


ITEMS = "array<struct<kind:string,rank:int,i:int,value:string,gap:int,left:string,right:string>>"


def found_items(text: Column, kind: str, rank: int, pattern: str, around: int, needs: Column | None = None) -> Column:
    """An array of ``(kind, rank, i, value, gap, left, right)``: each match, the code
    points between it and the match before, and up to ``around`` on either side.

    ``pattern`` must not match the empty string. Texts without ``needs``, a cheap
    condition that every text with a match meets, are not searched. Null texts
    give an empty array.
    """
    # Bound to a lambda's variable, the matches and the pieces are made once.
    read = F.struct(F.regexp_extract_all(text, F.lit(pattern), 0).alias("found"), F.split(text, pattern, -1).alias("pieces"))
    # Only the ends of the pieces travel on.
    cut = F.transform(
        F.array(read),
        lambda r: F.struct(
            r["found"].alias("found"),
            F.transform(
                r["pieces"],
                lambda p: F.struct(
                    F.length(p).alias("gap"), F.right(p, F.lit(around)).alias("left"), F.left(p, F.lit(around)).alias("right")
                ),
            ).alias("ends"),
        ),
    )

    def items(r: Column) -> Column:
        return F.transform(
            F.arrays_zip(r["found"].alias("value"), F.slice(r["ends"], F.lit(1), F.size(r["found"])).alias("before"),
                         F.slice(r["ends"], F.lit(2), F.size(r["found"])).alias("after")),
            lambda x, i: F.struct(
                F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), i.alias("i"), x["value"].alias("value"),
                x["before"]["gap"].alias("gap"), x["before"]["left"].alias("left"), x["after"]["right"].alias("right"),
            ),
        )

    every = F.flatten(F.transform(cut, items))
    return every if needs is None else F.when(needs, every).otherwise(F.array().cast(ITEMS))


def exploded(
    docs: DataFrame, text: str, patterns: list[tuple[str, str]], around: int, needs: dict[str, str] | None = None
) -> DataFrame:
    """A row for each match of the named patterns, with ``begin`` and ``end`` (exclusive), and
    one row with null ``kind`` for a row without any; ``rid`` numbers the input rows.

    ``needs`` may name a short pattern that texts with a match of a kind contain.
    Other columns are kept, the text is not.
    """
    cover = F.coalesce(F.col(text), F.lit(""))
    hints = {kind: cover.rlike(pattern) for kind, pattern in (needs or {}).items()}
    lists = [
        found_items(cover, kind, rank, pattern, around, hints.get(kind)) for rank, (kind, pattern) in enumerate(patterns)
    ]
    kept = [c for c in docs.columns if c != text]
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), *kept, F.concat(*lists).alias("items"))
    rows = rows.select("rid", *kept, F.inline_outer("items"))
    # One text's matches of one kind are summed together, never more.
    upto = W.partitionBy("rid", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(upto).cast("long")
    return rows.withColumn("end", end).withColumn("begin", F.col("end") - F.length("value")).drop("gap", "i")


def short_matches(text: Column, pattern: str) -> Column:
    """``array<struct<value, begin, end>>`` for texts of bounded length: sums are made anew for each match."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    pieces = F.split(text, pattern, -1)
    sizes = F.zip_with(found, F.slice(pieces, 1, F.size(found)), lambda v, p: F.length(v) + F.length(p))

    def placed(value: Column, i: Column) -> Column:
        end = F.aggregate(F.slice(sizes, F.lit(1), i + 1), F.lit(0), lambda s, x: s + x)
        return F.struct(value.alias("value"), (end - F.length(value)).alias("begin"), end.alias("end"))

    return F.transform(found, placed)


def listed(spans: Column) -> Column:
    """``kind:begin:end`` by begin, then rank, comma-joined; ``spans`` are structs of begin, rank, kind, end."""
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ","
    )

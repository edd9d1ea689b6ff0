"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Each source has a target, in words: its weight's share of the mix, at most
``MOST_EPOCHS`` times its own size, with the excess shared out again by weight.
A source is taken in complete epochs first; what is left of its target goes to
documents in the order of their exponential keys ``-ln(u) / quality``, each whole
while the budget lasts and the last one in part, so a source's taken words meet
its target to the word.

``u`` comes from the document id, so reruns agree and do not depend on how rows
are dealt. The order within a source is never one task's work: rows are
range-partitioned by source and key, summed by range, and only the sums of the
ranges (one row for each range a source lies in) are accumulated per source.

* null and blank texts have size 0 and take 0; they still get a row;
* null is a source of its own, last in order; source order is by code point;
* rows of equal id are separate rows with the same ``u``; null ids share one;
* without rows, or with no words at all, every target is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from garimpo.llm.frames import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
MARKS = "$%&*#!|"  # characters that junk text is strewn with


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: str, size: Column) -> Column:
    """Words against words and marks: 1 for clean prose, less for text full of marks, always above 0."""
    marks = F.length(text) - F.length(F.translate(F.col(text), MARKS, ""))
    return F.coalesce((size + 1) / (size + 1 + marks), F.lit(1.0))


def exponential_key(doc_id: str, weight: Column) -> Column:
    """``-ln(u) / weight`` with u in (0, 1) from 52 bits of the id's digest."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return -F.ln((bits + F.lit(0.5)) / F.lit(float(2**52))) / weight


def _ranged(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` cut into ordered ranges and stored, each row with the number of its range."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.repartitionByRange(partitions, *order).withColumn("range", F.spark_partition_id()), label)


def _weighted(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """``sources`` with ``weight``: the weights in turn, by code point order of the source, null last.

    Ranks are counted within ranges and the counts of ranges added up, so no task sorts all sources.
    """
    order = F.asc_nulls_last("source")
    cut = _ranged(sources, [order], "sources")
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # one row a range
    offsets = cut.groupBy("range").agg(F.count("*").alias("c")).withColumn("ahead", F.coalesce(F.sum("c").over(before), F.lit(0)))
    place = F.row_number().over(W.partitionBy("range").orderBy(order)) - 1 + F.col("ahead")
    table = F.array(*[F.lit(float(w)) for w in weights])
    turn = (F.pmod(place, F.lit(len(weights))) + 1).cast("int")
    return cut.join(offsets.select("range", "ahead"), "range").withColumn("weight", F.element_at(table, turn)).drop("range", "ahead")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Each round shares what capped sources leave by weight; rounds end when no
    source is above its cap. A round is one aggregate of two numbers.
    """
    table = stored(_weighted(sizes, weights), "weights")
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("s")).first()["s"] * share
    cap = F.col("source_size") * most
    level, capped = -1.0, -1
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        row = table.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
            F.count(F.when(full, 1)).alias("capped"),
        ).first()
        if row["capped"] == capped or not row["open"]:
            break
        level, capped = (total - row["held"]) / row["open"], row["capped"]
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(max(level, 0.0)))
    return table.select("source", "source_size", target.alias("target"))


def mixed(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS, quality: Column | None = None,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, epochs, taken)`` for every row.

    ``taken`` counts words, repeats included: ``epochs`` complete passes and the
    fractional selection. ``quality`` is a positive weight for each row, by
    default ``quality_weight``; a null or smaller one counts as 1e-9.
    """
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"), F.col(text).alias("text"),
        *([quality.alias("quality")] if quality is not None else []),
    )
    if quality is None:
        sized = sized.withColumn("quality", quality_weight("text", F.col("size")))
    positive = F.greatest(F.coalesce("quality", F.lit(0.0)), F.lit(1e-9))
    rows = stored(sized.select("doc_id", "source", "size", exponential_key("doc_id", positive).alias("key")), "sizes")
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    plan = plan.withColumns({
        "epochs": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"),
    }).withColumn("left", F.floor("target") - F.col("epochs") * F.col("source_size"))

    order = [F.asc_nulls_last("source"), F.col("key"), F.asc_nulls_last("doc_id"), F.col("size")]
    cut = _ranged(rows, order, "ranges")
    sums = cut.groupBy("source", "range").agg(F.sum("size").alias("s"))
    earlier = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("s").over(earlier), F.lit(0)))
    # Sources are few beside rows; both small tables meet first, so rows are joined once.
    same = F.col("p.source").eqNullSafe(F.col("s.source"))
    pieces = sums.alias("s").join(plan.alias("p"), same).select(
        F.col("s.source"), "range", "ahead", "source_size", "target", "epochs", "left"
    )
    same = (F.col("c.range") == F.col("p.range")) & F.col("c.source").eqNullSafe(F.col("p.source"))
    found = cut.alias("c").join(pieces.alias("p"), same).select(
        "c.doc_id", "c.source", "c.size", "c.key", "c.range", "ahead", "source_size", "target", "epochs", "left"
    )
    inside = W.partitionBy("range", "source").orderBy(*order[1:]).rowsBetween(W.unboundedPreceding, -1)
    found = found.withColumn("before", F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("before")))
    return found.select(
        "doc_id", "source", "size", "source_size", "target", "epochs",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
    )

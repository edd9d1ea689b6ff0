"""Which links were seen before: an exact anti-join that reads few files of the history.

The history is a table of links with a folder for each run and batch, and in it one
for each ``shard``, a hash bucket of the id; a batch has as many shards as files of
``PER_FILE`` links need. Beside it lies a Bloom filter of each of these files, as a
table too: a row is one 64-bit word that is not empty, and an id sets ``MARKS`` bits
of one word, so that a look-up is an equi-join on (shard, word).
Links of a new batch are joined with the filters; only files whose filter has all bits
of some link are read for the anti-join. A filter never misses a link it was made of,
and one not in it is told apart but in about one of a thousand cases, so what is read
grows with the links seen again, not with the history.

Filters are about a twentieth of the links' size. They are written before the links:
a batch that fails in between leaves a filter without links, which costs nothing, and
is run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.session import exists

PER_FILE = 1 << 15
COUNTS = [4**i for i in range(9)]  # of shards that a batch may have
WORDS = 1 << 14  # of a filter: 32 bits a link
MARKS = 4
BATCH_SCHEMA = [T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType())]
SEEN_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("domain", T.StringType()),
        *BATCH_SCHEMA,
        T.StructField("shard", T.StringType()),
    ]
)
FILTER_SCHEMA = T.StructType(
    [
        T.StructField("shard", T.StringType()),
        T.StructField("word", T.IntegerType()),
        T.StructField("bits", T.LongType()),
        *BATCH_SCHEMA,
    ]
)


def shard(key: Column, count: Column) -> Column:
    """The name of a link's shard among ``count``."""
    return F.concat_ws("-", count.cast("string"), F.pmod(F.xxhash64(key), count).cast("string"))


def _word(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 24).bitwiseAND(WORDS - 1).cast("int")


def _count(total: int) -> Column:
    return F.lit(next((c for c in COUNTS if c * PER_FILE >= total), COUNTS[-1]))


def _bits(key: Column) -> Column:
    marks, bits = F.xxhash64(key, F.lit("marks")), F.lit(0).cast("long")
    for i in range(MARKS):
        place = F.shiftrightunsigned(marks, 6 * i).bitwiseAND(63).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return bits


def filter_words(links: DataFrame, total: int) -> DataFrame:
    """The filters of ``total`` links, one for each shard, as ``(shard, word, bits)``."""
    key = F.col("id")
    marked = links.select(shard(key, _count(total)).alias("shard"), _word(key).alias("word"), _bits(key).alias("bits"))
    return marked.groupBy("shard", "word").agg(F.bit_or("bits").alias("bits"))


def asked(links: DataFrame) -> DataFrame:
    """``(shard, word, wanted)``: what the filter of any file with one of ``links`` has."""
    key, count = F.col("id"), F.explode(F.array(*(F.lit(c) for c in COUNTS)))
    every = links.select("id", count.alias("count"))
    return every.select(shard(key, F.col("count")).alias("shard"), _word(key).alias("word"), _bits(key).alias("wanted")).distinct()


def folders(filters: DataFrame, links: DataFrame, root: str) -> list[str]:
    """Folders of the history that may hold some of ``links``; their number is bounded by the files there are."""
    may = filters.join(asked(links), ["shard", "word"]).where(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
    found = may.select("run_id", "batch_id", "shard").distinct().toLocalIterator()
    return [f"{root}/run_id={r['run_id']}/batch_id={r['batch_id']}/shard={r['shard']}" for r in found]


def history(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """The links of these folders; what a failed batch never wrote is left out."""
    written = [p for p in paths if exists(spark, p)]
    if not written:
        return spark.createDataFrame([], SEEN_SCHEMA)
    return spark.read.schema(SEEN_SCHEMA).option("basePath", root).parquet(*written)


def add(links: DataFrame, total: int, root: str, filters: str, batch: str) -> None:
    """Store ``links``, the filters first, under the batch's folder; run again, it replaces what it wrote."""
    filter_words(links, total).coalesce(1 + total // 2_000_000).write.mode("overwrite").parquet(f"{filters}/{batch}")
    rows = links.withColumn("shard", shard(F.col("id"), _count(total))).repartition("shard")
    rows.write.mode("overwrite").partitionBy("shard").parquet(f"{root}/{batch}")

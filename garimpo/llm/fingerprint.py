"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below ``2**64 / SCALE``, so its size follows
the document and two sketches of very unequal documents are samples of the same
hash range: overlap, containment and Jaccard index are estimated from the kept
hashes alone. A set without any such hash keeps its smallest one instead; the
sketch stays a function of the shingle set, so merging sketches gives the sketch
of the union (``merge``) and equal texts have equal fingerprints.

* shingles are ``SHINGLE`` words as in ``hashing``, A-Z lower-cased; a shorter
  text is one shingle; null and blank texts have the empty sketch, written '';
* likeness is the Jaccard index of two sketches on what both must keep: 1 for two
  empty ones, 0 if only one is empty;
* repeated rows are fingerprinted each on their own.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm import hashing

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
SCALE = 8
BUCKETS_PER_PARTITION = 4


def highest(scale: int) -> np.uint64:
    """The largest hash a sketch keeps by the threshold."""
    return np.uint64((2**64 - 1) // scale)


def keep(hashes: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of a sorted distinct hash array."""
    kept = hashes[: np.searchsorted(hashes, highest(scale), side="right")]
    return kept if len(kept) else hashes[:1]


def merge(one: np.ndarray, other: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of the union of the two shingle sets."""
    return keep(np.union1d(one, other), scale)


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """Estimated Jaccard index."""
    if not len(one) and not len(other):
        return 1.0
    both = len(np.intersect1d(one, other, assume_unique=True))
    return both / (len(one) + len(other) - both)


def containment(one: np.ndarray, other: np.ndarray) -> float:
    """Estimated share of ``one``'s shingles that ``other`` has too."""
    return len(np.intersect1d(one, other, assume_unique=True)) / len(one) if len(one) else 1.0


def written(sketch: np.ndarray) -> str:
    """Sixteen hex digits a hash, ascending."""
    return sketch.astype(">u8").tobytes().hex()


def read(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), dtype=">u8").astype(np.uint64)


def sketches(column: pa.Array, size: int = SHINGLE, scale: int = SCALE) -> list[np.ndarray]:
    """The sketch of each row; only hashes below the threshold are sorted."""
    words = hashing.Words(column, lower=True)
    every = hashing.grams(words.hashes, size)
    at = np.flatnonzero(every <= highest(scale))
    low = every[at]
    begin = np.searchsorted(at, words.first[:-1])
    end = np.searchsorted(at, np.maximum(words.first[1:] - size + 1, words.first[:-1]))
    out = []
    for i, n in enumerate(words.counts().tolist()):
        kept = np.unique(low[begin[i] : end[i]])
        if not len(kept) and n:
            first, width = words.first[i], min(n, size)
            own = every[first : first + n - size + 1] if n >= size else hashing.grams(words.hashes[first : first + n], width)
            kept = own.min(keepdims=True)
        out.append(kept)
    return out


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", size: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """``docs`` with column ``out`` (replaced if there): the written sketch of each text. No shuffle."""

    @F.arrow_udf("string")
    def fingerprint(column: pa.Array) -> pa.Array:
        return pa.array([written(s) for s in sketches(column, size, scale)], type=pa.string())

    return docs.withColumn(out, fingerprint(F.col(text)))


def similar(one: str, other: str) -> F.Column:
    """Likeness of two written sketches, by array functions; equal to ``likeness``."""

    def parts(name: str) -> F.Column:
        return F.regexp_extract_all(F.col(name), F.lit("([0-9a-f]{16})"), 1)

    both = F.size(F.array_intersect(parts(one), parts(other)))
    every = F.size(F.array_union(parts(one), parts(other)))
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many, or all, of the following text's first."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


REPORT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
REPORT_SQL = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _neighbours(size: int, scale: int):
    """Rows arrive by bucket in order, each bucket ended by the copy of the next bucket's first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        previous: tuple | None = None
        for batch in hashing.slices(batches, "text"):
            column = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            prints = sketches(column["text"], size, scale)
            values = (column[n].to_pylist() for n in ("bucket", "extra", "doc_id", "text"))
            pairs = []
            for row in zip(*values, prints, strict=True):
                if previous is not None and previous[0] == row[0] and not previous[1]:
                    pairs.append((*previous[2:], *row[3:]))
                previous = row
            if not pairs:
                continue
            after = [edited(text, following) for _, text, _, following, _ in pairs]
            marks = sketches(pa.array(after, type=pa.string()), size, scale)
            rows = [
                (doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                 written(own), written(mark), likeness(own, mark), likeness(own, other))
                for (doc_id, text, own, _, other), new, mark in zip(pairs, after, marks, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(REPORT)], schema=REPORT
            )

    return run


def edit_report(docs: DataFrame, size: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document.

    The next document is the following one by descending ``doc_id``, null ids
    last, equal ids by a hash of the text; after the last comes the first, and a
    single document is its own next one. Neighbours meet without a global sort:
    ids are cut at sampled quantiles into buckets, a few for each shuffle
    partition, each bucket is sorted in one task, and the first row of a bucket
    is also sent to the end of the one before. One shuffle carries the texts; the
    driver sees one key a bucket.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = BUCKETS_PER_PARTITION * partitions
    cuts = docs.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().stat.approxQuantile(
        "doc_id", [i / wanted for i in range(1, wanted)], 0.2 / wanted
    )
    points = np.unique(np.array(cuts, dtype=np.int64))

    @F.arrow_udf("int")
    def bucket_of(ids: pa.Array) -> pa.Array:
        at = len(points) - np.searchsorted(points, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right")
        null = ids.is_null().to_numpy(zero_copy_only=False)
        return pa.array(np.where(null, len(points) + 1, at), type=pa.int32())

    placed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumns({"tie": F.xxhash64("text"), "bucket": bucket_of("doc_id")})
    tops = placed.groupBy("bucket").agg(F.max(F.struct("doc_id", "tie")).alias("top"))
    heads = sorted((r["bucket"], r["top"]["doc_id"], r["top"]["tie"]) for r in tops.toLocalIterator())
    before = [(heads[i - 1][0], *heads[i]) for i in range(len(heads))]
    marked = spark.createDataFrame(before, "before int, bucket int, head_id long, head_tie long")
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    places = F.array_compact(
        F.array(
            F.struct(F.col("bucket"), F.lit(False).alias("extra")),
            F.when(is_head, F.struct(F.col("before").alias("bucket"), F.lit(True).alias("extra"))),
        )
    )
    # One row a bucket, so the size of this side is set by the partition count.
    sent = placed.join(F.broadcast(marked), "bucket").select("doc_id", "text", "tie", F.inline(places))
    ordered = sent.repartition(partitions, "bucket").sortWithinPartitions(
        "bucket", "extra", F.desc_nulls_last("doc_id"), F.desc("tie")
    )
    return ordered.mapInArrow(_neighbours(size, scale), REPORT_SQL)

"""Quality classifier: supervised subword embeddings.

Every word, word pair and byte n-gram of a text is hashed to one of ``BUCKETS``
learned vectors; a text is the average of its vectors, and a softmax layer turns
it into class probabilities. Vectors and layer are trained together by numpy
stochastic gradient descent. A word pair that repeats a word is written as one
common mark, so that stuttering text shares a vector whatever the word.

The model is fitted on a bounded sample: the ``rows`` labelled documents with the
smallest hash of their id, whole texts. Scoring covers every row, and needs one
number a bucket (the layer applied to its vector), so what is broadcast has a
fixed size.

* null and blank texts score the layer's bias alone;
* labels other than 0 and 1, null labels and null ids are not learned from; an id
  labelled twice with different labels is not either;
* without labels of both classes the model is the constant share of label 1 (0.5
  without any label);
* repeated rows get equal scores; other columns pass through.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm import hashing
from garimpo.llm.frames import set_aside

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
DIM = 8
SAMPLE_ROWS = 4000
EPOCHS = 6
RATE = 0.5
THRESHOLD = 0.3
FOLDS = 5
_REPEAT = np.uint64(0xA0761D6478BD642F)
_SPACES = np.array([32 if b in (9, 10, 11, 12, 13) else b for b in range(256)], dtype=np.uint32)


def _bucket64(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def features(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bucket numbers of all features of all rows, in one array a kind with the row bounds in it."""
    words = hashing.Words(column, lower=False)
    h = words.hashes
    pairs = hashing.grams(h, 2) if len(h) > 1 else np.empty(0, dtype=np.uint64)
    if len(h) > 1:
        pairs = np.where(h[1:] == h[:-1], _REPEAT, pairs)
    data = _SPACES[words.data]
    three = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:] if len(data) > 2 else data[:0]
    four = (three[:-1] << np.uint32(8)) | data[3:] if len(data) > 3 else data[:0]
    shift = np.uint32(32 - BUCKET_BITS)
    last = words.first[1:]
    begin = words.bounds[:-1]

    def spans(starts: np.ndarray, ends: np.ndarray, total: int) -> np.ndarray:
        """First and past-the-last feature of each row."""
        starts = np.minimum(starts, total)
        return np.stack([starts, np.minimum(np.maximum(ends, starts), total)])

    return [
        (_bucket64(h), spans(words.first[:-1], last, len(h))),
        (_bucket64(pairs), spans(words.first[:-1], last - 1, len(pairs))),
        (((three * np.uint32(0x9E3779B1)) >> shift).astype(np.int32), spans(begin, words.bounds[1:] - 2, len(three))),
        (((four * np.uint32(0x85EBCA6B)) >> shift).astype(np.int32), spans(begin, words.bounds[1:] - 3, len(four))),
    ]


def scores(column: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """Probability of label 1: the mean weight of a row's features plus the bias, through the logistic function."""
    total, count = np.zeros(len(column)), np.zeros(len(column))
    for buckets, (begin, end) in features(column):
        sums = np.concatenate([[0.0], np.cumsum(weights[buckets], dtype=np.float64)])
        total += sums[end] - sums[begin]
        count += end - begin
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -50, 50)))


def train(
    rows: list[tuple[np.ndarray, np.ndarray, int]], dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weight of every bucket and bias, for the difference of the two classes' logits.

    ``rows`` are ``(buckets, counts, label)``. Deterministic for a given order and seed.
    """
    share = np.mean([label for *_, label in rows]) if rows else 0.5
    if not 0 < share < 1:
        share = min(max(share, 0.001), 0.999)
        return np.zeros(BUCKETS, dtype=np.float32), float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim))
    layer, bias = np.zeros((2, dim)), np.zeros(2)
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            buckets, counts, label = rows[i]
            lr = rate * (1 - step / steps)
            step += 1
            part = counts / max(1, counts.sum())
            mean = part @ vectors[buckets]
            logits = layer @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ layer
            layer -= lr * np.outer(p, mean)
            bias -= lr * p
            # The average shares the gradient out; frequent features of a short text move most.
            vectors[buckets] -= lr * VECTOR_GAIN * np.outer(part, back)
    return (vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0])


VECTOR_GAIN = 20.0


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct buckets and their counts for each row: at most ``BUCKETS`` numbers a text."""
    for batch in hashing.slices(batches, "text"):
        kinds = features(batch.column(batch.schema.get_field_index("text")))
        buckets, counts = [], []
        for i in range(batch.num_rows):
            own, n = np.unique(np.concatenate([b[at[0][i] : at[1][i]] for b, at in kinds]), return_counts=True)
            buckets.append(own.astype(np.int32).tobytes())
            counts.append(n.astype(np.float32).tobytes())
        kept = [batch.column(batch.schema.get_field_index(n)) for n in ("place", "label")]
        made = [pa.array(x, type=pa.binary()) for x in (buckets, counts)]
        yield pa.RecordBatch.from_arrays([*kept, *made], names=["place", "label", "buckets", "counts"])


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows never learned from: crc32 of the id as text, modulo ``FOLDS``, is 0; null ids too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, **options) -> tuple[np.ndarray, float]:
    """Train on at most ``rows`` labelled documents outside the held-out fold."""
    usable = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out())
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("other")).where("label = other")
    known = docs.select("doc_id").dropna().distinct()
    # Labels of other documents go first, so that the sample is of labelled documents; it is bounded
    # by ``rows``, and so are this broadcast and the task that learns.
    sample = usable.join(known, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id", "label")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    texts = texts.select(F.xxhash64("doc_id", "text").alias("place"), "label", "text")
    counted = texts.mapInArrow(_counted, "place bigint, label int, buckets binary, counts binary")
    order = ["place", "label", "buckets"]
    model = counted.repartition(1).sortWithinPartitions(*order).mapInArrow(_learned(options), "weights binary, bias double").first()
    if model is None:  # a table without rows, whose one partition is left out
        return train([])
    return np.frombuffer(model["weights"], dtype=np.float32), model["bias"]


def _learned(options: dict):
    """Trains on the rows of the only task, so that the driver holds nothing but the model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [
            (np.frombuffer(b.as_py(), dtype=np.int32), np.frombuffer(c.as_py(), dtype=np.float32), label.as_py())
            for batch in batches
            for b, c, label in zip(batch.column("buckets"), batch.column("counts"), batch.column("label"), strict=True)
        ]
        weights, bias = train(found, **options)
        found.clear()
        hashing.tidy()
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([bias])], names=["weights", "bias"])

    return run


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (columns of those names are replaced). Scoring shuffles nothing."""
    weights, bias = fit(docs, labels, **options)
    model = docs.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        out = np.zeros(len(column))
        batch = pa.RecordBatch.from_arrays([column.fill_null("")], names=["text"])
        at = 0
        for part in hashing.slices(iter([batch]), "text"):
            out[at : at + part.num_rows] = scores(part.column(0), model.value, bias)
            at += part.num_rows
        return pa.array(out)

    found = docs.withColumn("score", score(F.col("text")))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` predicted to have label 1, with the columns of ``docs``."""
    inner, back = set_aside(docs, ["score", "predicted"], ["doc_id", "text"])
    return back(scored(inner, labels, **options).where("predicted = 1"))

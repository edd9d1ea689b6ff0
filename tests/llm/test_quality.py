import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from garimpo.llm import quality as Q

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = Q.scored(docs, labels).join(labels, "doc_id").where(Q.held_out()).select("predicted", "quality").collect()
    assert len(found) > 40
    assert np.mean([r["predicted"] == r["quality"] for r in found]) > 0.9


def test_held_out_rows_and_other_columns_do_not_matter(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(Q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one = Q.fit(docs, labels)
    other = Q.fit(docs.withColumns({"lang": F.lit("zz"), "source": F.lit(None)}), flipped)
    assert one[1] == other[1] and (one[0] == other[0]).all()


def test_features_equal_one_row_at_a_time():
    texts = ["a b b c", None, "", "é x\ty", "x"]
    whole = Q.features(pa.array(texts).fill_null(""))
    for i, text in enumerate(texts):
        own = Q.features(pa.array([text or ""]))
        for (buckets, at), (one, place) in zip(whole, own, strict=True):
            assert buckets[at[0][i] : at[1][i]].tolist() == one[place[0][0] : place[1][0]].tolist()


def test_repeated_words_share_a_feature():
    buckets, at = Q.features(pa.array(["q q q", "r r"]))[1]
    assert len(set(buckets[at[0][0] : at[1][0]].tolist() + buckets[at[0][1] : at[1][1]].tolist())) == 1


def test_degenerate_labels(spark, documents):
    docs = documents([(i, f"text {i}") for i in range(20)] + [(None, None), (3, "again")])
    schema = "doc_id long, quality int"
    for labels, low, high in [([], 0.5, 0.5), ([(i, 1) for i in range(20)], 0.99, 1), ([(1, 0), (1, 1), (2, None), (None, 1), (4, 7)], 0.5, 0.5)]:
        rows = Q.scored(docs, spark.createDataFrame(labels, schema)).collect()
        assert len(rows) == 22 and all(low <= r["score"] <= high for r in rows)
    assert Q.scored(documents([]), spark.createDataFrame([], schema)).count() == 0


def test_accepted_keeps_columns(spark, documents):
    docs = documents([(i, "fine words here") for i in range(10)]).withColumnRenamed("lang", "Score")
    kept = Q.accepted(docs, spark.createDataFrame([(i, 1) for i in range(10)], "doc_id long, quality int"))
    assert kept.columns == docs.columns and kept.count() == 10


@pytest.mark.parametrize("size", [0, 1])
def test_training_is_deterministic(size):
    rows = [(np.array([i, i + 1]), np.array([1.0, 2.0]), i % 2) for i in range(10)][: 10 * size]
    one, other = Q.train(rows), Q.train(rows)
    assert (one[0] == other[0]).all() and one[1] == other[1]


def test_sample_is_of_labelled_documents(spark, documents):
    """Labels of documents that are not there do not crowd out the others."""
    docs = documents([(i, "good plain words" if i % 2 else "qqq zzz 111") for i in range(200)])
    own = [(i, i % 2) for i in range(200)]
    labels = spark.createDataFrame(own + [(i, i % 2) for i in range(1000, 60_000)], "doc_id long, quality int")
    found = Q.scored(docs, labels, rows=100).select("doc_id", "predicted").collect()
    assert all(r.predicted == r.doc_id % 2 for r in found)

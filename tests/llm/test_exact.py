"""Exact dedup against plain grouping, with hashes that collide too."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from garimpo.llm import exact as E

ROWS = [
    (5, "a  b"), (3, "a\tb"), (9, "a b"), (4, " a b"), (None, "a b"), (2, None), (1, ""), (7, " "), (8, "\n\x0b"), (3, "a b"),
    (None, "lone"), (None, "pair\x0c"), (None, "pair "), (11, "A b"), (12, "a b"), (13, "x " * 60_000), (14, "x\n" * 60_000),
]
KEYS = {
    "production": E.content_hash,
    "few bits": lambda d: F.unhex(F.substring(F.hex(d), 1, 2)),
    "one value": lambda d: F.lit(b"\x00"),
}


def expected(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    out = []
    for body, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("key", KEYS)
def test_groups(spark, documents, key):
    rows = ROWS + [(i, f"text {i % 40}") for i in range(100, 300)]
    found = E.marked(documents(rows), key=KEYS[key])
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows)


def test_a_group_of_most_rows(spark, documents, monkeypatch):
    """Hot groups are found by broadcast, the others by a join."""
    monkeypatch.setattr(E, "HOT", 3)
    rows = [(i, "same") for i in range(400)] + [(i, f"other {i // 2}") for i in range(400, 500)]
    assert sorted((tuple(r) for r in E.marked(documents(rows)).collect()), key=str) == expected(rows)


def test_rows_that_stay_keep_their_columns(spark):
    rows = [(2, "a", "first", 1), (1, "a ", "second", 2), (1, "a ", "third", 3), (3, "a b", None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, RID int")
    found = E.deduplicated(df)
    assert found.columns == df.columns
    got = [tuple(r) for r in found.collect()]
    assert len(got) == 3 and (2, "a", "first", 1) in got and (3, "a b", None, 4) in got
    assert ((1, "a ", "second", 2) in got) != ((1, "a ", "third", 3) in got)


def test_empty_table(spark, documents):
    assert E.marked(documents([])).collect() == [] and E.deduplicated(documents([])).collect() == []


def test_texts_are_not_shuffled_unless_repeated(spark, documents):
    """The comparison reads only texts whose hash may be repeated."""
    rows = [(i, f"text {i}") for i in range(500)] + [(1000, "twice"), (1001, "twice")]
    texts = documents(rows).select(F.xxhash64("text").alias("h"), F.col("text").alias("body"))
    groups = texts.groupBy("h").agg(F.count("*").alias("size"))
    assert [r.body for r in E._suspects(texts, groups).collect()] == ["twice", "twice"]

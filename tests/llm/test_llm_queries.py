"""The registered queries against their SQL, and the pipeline's stages."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from garimpo.llm import contamination, jaccard, quality
from garimpo.llm.queries import ORACLES, QUERIES
from tools.check import rows_of

FOLDER = "/root/testdata/sf0.001"
# Tables rendered with planted cases are larger; the smallest folder still holds some of each.


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, con, key):
    df = queries()[key](spark, FOLDER)
    cursor = con.execute(ORACLES[key])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_query_covers_its_table(spark, con, key):
    name, column = {"op7": ("pages", "page_id"), "op12": ("conversations", "DISTINCT conv_id")}.get(key.split("_")[0], ("documents", "doc_id"))
    got = sorted(r[column.split()[-1]] for r in queries()[key](spark, FOLDER).collect())
    assert got == sorted(r[0] for r in con.execute(f"SELECT {column} FROM {name}").fetchall())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, tables = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        tables[name] = (docs, out)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
            docs = out
    before, after = tables["quality classifier"]
    scores = quality.scored(before, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert after.count() == scores.where("predicted = 1").count() <= before.count()
    before, after = tables["n-gram Jaccard join"]
    assert after.count() == jaccard.linked_components(before).select("component_id").distinct().count()
    before, after = tables["benchmark decontamination"]
    flagged = contamination.contaminated(before, spark.read.parquet(f"{FOLDER}/benchmark.parquet"))
    assert after.count() == flagged.where("NOT contaminated").count()
    before, after = tables["secret scans"]
    assert before.count() == after.count()
    before, after = tables["mixing sources to target weights"]
    assert before.count() == after.count()


def test_pipeline_runs_as_a_query(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 50

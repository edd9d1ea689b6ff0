"""The upserted listing table: results, the base's plan, versions, restarts."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from garimpo.operators import dedup, report
from garimpo.sources.listing_table import ListingTable
from garimpo.streaming import jobs

SCHEMA = "id string, titulo string, preco string, seq long"


def rows(spark, spans, seq):
    return spark.createDataFrame([(f"k{i}", f"t{seq}", None if i % 3 else str(seq), seq) for i in spans], SCHEMA)


def content(df):
    return sorted(map(tuple, df.select("id", "titulo", "preco", "seq").collect()))


def test_versions_and_compaction(spark, fresh_dir):
    table = ListingTable(spark, f"{fresh_dir}/t", ["seq"]).create(rows(spark, range(50), 1), buckets=4)
    whole = rows(spark, range(50), 1)
    opened = table.rows()
    for seq, span in ((3, range(40, 70)), (2, range(30, 60)), (3, range(5))):
        delta = rows(spark, span, seq)
        table.add(delta)
        whole = whole.unionByName(delta)
        assert content(table.rows()) == content(dedup.last_by(whole, ["id"], ["seq"]))
    before = content(table.rows())
    table.compact(buckets=3)
    live = table.manifest()
    assert live["deltas"] == [] and live["buckets"] == 3 and content(table.rows()) == before
    assert content(opened) == content(rows(spark, range(50), 1))  # what was opened before stays readable
    table.compact()
    assert table.manifest() == live


def test_base_is_scanned_once_and_not_shuffled(spark, fresh_dir):
    table = ListingTable(spark, f"{fresh_dir}/t", ["seq"]).create(rows(spark, range(300), 1), buckets=6)
    table.add(rows(spark, range(290, 310), 2))
    merged = table.rows()
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    initial = merged._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"FileScan parquet \S*listing_", initial)) == 1
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan
    side = plan[: plan.index("FileScan parquet spark_catalog")].rsplit("SortMergeJoin", 1)[1]
    assert "Exchange" not in side


def test_a_later_delta_wins_a_tie(spark, fresh_dir):
    table = ListingTable(spark, f"{fresh_dir}/t", ["seq"]).create(rows(spark, [1], 1), buckets=2)
    for titulo in ("b", "c"):
        table.add(spark.createDataFrame([("k1", titulo, None, 1)], SCHEMA))
    assert content(table.rows()) == [("k1", "c", None, 1)]


def test_a_delta_added_again_counts_once_and_writers_do_not_overwrite(spark, fresh_dir):
    table = ListingTable(spark, f"{fresh_dir}/t", ["seq"]).create(rows(spark, range(3), 1), buckets=2)
    for _ in range(2):
        table.add(rows(spark, [2, 3], 5), name="run-0")
    live = table.manifest()
    assert live["version"] == 1 and live["deltas"] == ["delta-run-0"]
    with pytest.raises(AnalysisException):
        table._publish(1, live["base"], 2, rows(spark, [], 1).schema, [])


def test_empty_tables(spark, fresh_dir):
    table = ListingTable(spark, f"{fresh_dir}/t", ["seq"])
    assert table.manifest() is None
    table.create(rows(spark, [], 1), buckets=2)
    table.add(rows(spark, [], 1))
    table.compact()
    assert table.rows().count() == 0


def test_stream_into_a_table(spark, fresh_dir):
    df = spark.createDataFrame(
        [(f"k{i % 9}" if i % 11 else None, f"t{i}" if i % 4 else None, None, i) for i in range(90)], SCHEMA
    )
    df.repartition(6).write.parquet(f"{fresh_dir}/in")
    table = ListingTable(spark, f"{fresh_dir}/t", ["seq"])
    for _ in range(2):  # started again with its checkpoint, it has nothing to do
        stream = jobs.file_stream(spark, f"{fresh_dir}/in", df.schema, files_per_batch=1)
        jobs.upsert_table(stream, table, f"{fresh_dir}/cp", f"{fresh_dir}/rejects", compact_after=3).awaitTermination()
    taken = df.where("titulo IS NOT NULL AND id IS NOT NULL")
    assert content(table.rows()) == content(dedup.last_by(taken, ["id"], ["seq"]))
    assert len(table.manifest()["deltas"]) < 3
    assert jobs.stored_batches(spark, f"{fresh_dir}/rejects", df.schema).count() == df.count() - taken.count()
    # Another checkpoint brings the same rows again: the table stays as it is.
    stream = jobs.file_stream(spark, f"{fresh_dir}/in", df.schema)
    jobs.upsert_table(stream, table, f"{fresh_dir}/cp2", f"{fresh_dir}/rejects2").awaitTermination()
    assert content(table.rows()) == content(dedup.last_by(taken, ["id"], ["seq"]))
    assert table.rows().where(F.col("id").isNull()).count() == 0


def test_a_load_is_counted_by_the_jobs_that_write_it(spark, fresh_dir):
    """Before, added and rejected equal counts of the tables, and nothing is scanned for them."""
    stored = rows(spark, range(100), 1)
    incoming = rows(spark, [*range(90, 130), 95, 129], 2).withColumn("titulo", F.when(F.expr("id NOT IN ('k91', 'k120', 'k129')"), F.col("titulo")))
    table = ListingTable(spark, f"{fresh_dir}/t", ["seq"]).create(stored, buckets=4)
    jobs_before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    assert table.add(incoming, required="titulo") == {"recebidos": 42, "rejeitados": 4}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - jobs_before <= 4  # the write, and the manifest's
    counts = table.compact()
    want = report.load_delta(stored, dedup.accepted(incoming)).first().asDict()
    assert counts == want == {"antes": 100, "depois": 128, "adicionados": 28}
    assert table.rows().columns == stored.columns and table.rows().count() == 128
    assert table.compact() is None


def test_loads_without_rows_are_counted_too(spark, fresh_dir):
    table = ListingTable(spark, f"{fresh_dir}/t", ["seq"]).create(rows(spark, range(5), 1), buckets=2)
    none = rows(spark, range(3), 2)
    assert table.add(none.limit(0), required="titulo") == {"recebidos": 0, "rejeitados": 0}
    assert table.add(none.filter("false")) == {"recebidos": 0, "rejeitados": 0}
    assert table.add(none.withColumn("titulo", F.lit(None).cast("string")), required="titulo") == {"recebidos": 3, "rejeitados": 3}
    assert table.compact() == {"antes": 5, "depois": 5, "adicionados": 0}

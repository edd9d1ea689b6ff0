"""The history of seen links: filters that miss nothing, and few files read."""

from pyspark.sql import functions as F

from garimpo.streaming import jobs, membership

LINK = "id string, url string, domain string"


def links(spark, first, last):
    return spark.range(first, last).select(F.md5(F.col("id").cast("string")).alias("id"), F.lit("u").alias("url"), F.lit("d").alias("domain"))


def stored(spark, folder, parts):
    for i, rows in enumerate(parts):
        membership.add(rows, rows.count(), f"{folder}/out", f"{folder}/out-filter", f"run_id=r/batch_id={i}")
    return spark.read.schema(membership.FILTER_SCHEMA).parquet(f"{folder}/out-filter")


def test_filters_miss_nothing_and_few_files_are_read(spark, fresh_dir, monkeypatch):
    """A batch of 1 % of the links, mostly new, reads under 5 % of the history's files."""
    monkeypatch.setattr(membership, "PER_FILE", 100)
    filters = stored(spark, fresh_dir, [links(spark, 5000 * i, 5000 * (i + 1)) for i in range(4)])
    out = f"{fresh_dir}/out"
    files = len(spark.read.parquet(out).inputFiles())
    assert files == 4 * 64
    batch = links(spark, 3, 11).unionByName(links(spark, 100_000, 100_192))
    paths = membership.folders(filters, batch, out)
    seen = membership.history(spark, out, paths)
    assert 0 < len(seen.inputFiles()) < 0.05 * files
    assert {r.id for r in batch.join(seen, "id", "left_semi").collect()} == {r.id for r in links(spark, 3, 11).collect()}
    # Every stored link finds its file.
    assert len(membership.folders(filters, links(spark, 0, 20_000), out)) == files


def test_filter_words_tell_links_apart(spark):
    known, other = links(spark, 0, membership.PER_FILE), links(spark, 100_000, 140_000)
    filters = membership.filter_words(known, membership.PER_FILE)
    found = filters.join(membership.asked(other), ["shard", "word"]).where(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
    assert found.count() < 0.005 * 40_000


def test_a_filter_without_links_costs_nothing(spark, fresh_dir):
    """A batch that failed after its filter was written is as if it had not been there."""
    rows = links(spark, 0, 50)
    membership.filter_words(rows, 50).write.parquet(f"{fresh_dir}/out-filter/run_id=r/batch_id=0")
    rows.limit(0).write.parquet(f"{fresh_dir}/out")
    filters = spark.read.schema(membership.FILTER_SCHEMA).parquet(f"{fresh_dir}/out-filter")
    paths = membership.folders(filters, rows, f"{fresh_dir}/out")
    assert paths and membership.history(spark, f"{fresh_dir}/out", paths).count() == 0


def test_many_runs_give_each_link_once(spark, fresh_dir):
    """Runs with their own checkpoints, whose links overlap, over tables of several batches."""
    for run in range(3):
        links(spark, 300 * run, 300 * run + 600).repartition(3).write.parquet(f"{fresh_dir}/in{run}")
        stream = jobs.file_stream(spark, f"{fresh_dir}/in{run}", spark.read.parquet(f"{fresh_dir}/in{run}").schema, files_per_batch=1)
        jobs.first_seen_links(stream, f"{fresh_dir}/out", f"{fresh_dir}/cp{run}").awaitTermination()
        got = [r.id for r in spark.read.schema(jobs.SEEN_SCHEMA).parquet(f"{fresh_dir}/out").collect()]
        assert sorted(got) == sorted(r.id for r in links(spark, 0, 300 * run + 600).collect())


def test_empty_batches(spark, fresh_dir):
    filters = stored(spark, fresh_dir, [links(spark, 0, 0), links(spark, 0, 1)])
    assert membership.folders(filters, links(spark, 5, 5), f"{fresh_dir}/out") == []
    assert len(membership.folders(filters, links(spark, 0, 1), f"{fresh_dir}/out")) == 1

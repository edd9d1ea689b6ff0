from pyspark.sql import functions as F

from garimpo.operators import captures as cap
from garimpo.operators import dedup
from garimpo.streaming import jobs


def test_capture_ingest_resumes_and_equals_batch(spark, fresh_dir):
    schema = "entry_id long, url string, status int, text string"

    def drop(first, last):
        rows = [(i, "u", 200 if i % 4 else 403, '[{"list_id":%d,"price":"R$ 1"},{"cut' % i) for i in range(first, last)]
        spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(f"{fresh_dir}/in")

    def run():
        stream = jobs.file_stream(spark, f"{fresh_dir}/in", spark.read.parquet(f"{fresh_dir}/in").schema, 1)
        jobs.ingest_captures(stream, f"{fresh_dir}/out", f"{fresh_dir}/cp").awaitTermination()

    drop(0, 10)
    run()
    run()
    drop(10, 15)
    run()
    got = spark.read.parquet(f"{fresh_dir}/out")
    want = cap.salvaged_ads(cap.answered(spark.read.parquet(f"{fresh_dir}/in")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_first_seen_over_batches_with_a_hot_link(spark, fresh_dir):
    rows = [("hot" if i % 3 == 0 else f"l{i % 40}", "u", "d") for i in range(600)]
    spark.createDataFrame(rows, "id string, url string, domain string").repartition(6).write.parquet(f"{fresh_dir}/in")
    schema = spark.read.parquet(f"{fresh_dir}/in").schema
    stream = jobs.file_stream(spark, f"{fresh_dir}/in", schema, files_per_batch=1)
    jobs.first_seen_links(stream, f"{fresh_dir}/out", f"{fresh_dir}/cp").awaitTermination()
    got = spark.read.parquet(f"{fresh_dir}/out")
    assert sorted(r.id for r in got.collect()) == sorted({r[0] for r in rows})


def test_upsert_stream_equals_batch(spark, fresh_dir):
    rows = [(f"k{i % 9}", f"t{i}" if i % 4 else None, i) for i in range(90)]
    df = spark.createDataFrame(rows, "id string, titulo string, seq long")
    df.repartition(5).write.parquet(f"{fresh_dir}/in")
    stream = jobs.file_stream(spark, f"{fresh_dir}/in", df.schema, files_per_batch=1)
    jobs.upsert_listings(stream, f"{fresh_dir}/log", f"{fresh_dir}/cp", ["seq"]).awaitTermination()
    got = jobs.latest_listings(spark.read.parquet(f"{fresh_dir}/log"), ["seq"]).select("id", "titulo", "seq")
    want = dedup.last_by(dedup.accepted(df), ["id"], ["seq"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    rejects = jobs.stored_batches(spark, f"{fresh_dir}/log-rejects", df.schema)
    assert rejects.count() == sum(r[1] is None for r in rows)


def test_progress_counts_links_by_latest_status(spark, fresh_dir):
    rows = [("a", 1, 1, "pending"), ("a", 3, 3, "done"), ("a", 2, 2, "error"), ("b", 1, 4, "error"), ("c", 1, 5, "pending")]
    df = spark.createDataFrame(rows, "id string, s long, event_id long, status string")
    df = df.select("id", F.timestamp_seconds("s").alias("ts"), "event_id", "status")
    df.repartition(3).write.parquet(f"{fresh_dir}/in")
    for run in range(2):  # the second run adds the same events again and changes nothing
        stream = jobs.file_stream(spark, f"{fresh_dir}/in", df.schema, files_per_batch=1)
        jobs.status_log(stream, f"{fresh_dir}/out", f"{fresh_dir}/cp{run}").awaitTermination()
    log = jobs.stored_batches(spark, f"{fresh_dir}/out", jobs.PROGRESS_SCHEMA)
    assert {tuple(r) for r in jobs.status_progress(log).collect()} == {("done", 1), ("error", 1), ("pending", 1)}


def test_a_new_checkpoint_keeps_what_was_stored(spark, fresh_dir):
    for run, ids in enumerate((["a", "b"], ["b", "c"])):
        df = spark.createDataFrame([(i, "u", "d") for i in ids], "id string, url string, domain string")
        df.write.parquet(f"{fresh_dir}/in{run}")
        stream = jobs.file_stream(spark, f"{fresh_dir}/in{run}", df.schema)
        jobs.first_seen_links(stream, f"{fresh_dir}/out", f"{fresh_dir}/cp{run}").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{fresh_dir}/out").collect()) == ["a", "b", "c"]


def test_first_seen_within_a_horizon(spark, fresh_dir):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "id string, s long").select("id", F.timestamp_seconds("s").alias("ts"))
    df.write.parquet(f"{fresh_dir}/in")
    once = jobs.first_seen_within(jobs.file_stream(spark, f"{fresh_dir}/in", df.schema), "1 hour")
    query = (
        once.writeStream.format("parquet").option("checkpointLocation", f"{fresh_dir}/cp").trigger(availableNow=True).start(f"{fresh_dir}/out")
    )
    query.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{fresh_dir}/out").collect()) == ["a", "b"]


def test_status_counts_equal_the_batch_answer_after_every_run(spark, fresh_dir):
    """Events out of order, repeated, and spread over restarts of one checkpoint."""
    import random

    rng = random.Random(5)
    rows = [(f"l{rng.randrange(20)}", rng.randrange(40), i, rng.choice(["pending", "done", "error", None])) for i in range(120)]
    rows += rows[:10] + [(None, 1, 999, "done")]
    schema = "id string, s long, event_id long, status string"
    for run in range(3):
        part = spark.createDataFrame(rows[run::3], schema).select("id", F.timestamp_seconds("s").alias("ts"), "event_id", "status")
        part.repartition(2).write.mode("append").parquet(f"{fresh_dir}/in")
        stream = jobs.file_stream(spark, f"{fresh_dir}/in", part.schema, files_per_batch=1)
        jobs.status_counts(stream, f"{fresh_dir}/out", f"{fresh_dir}/cp").awaitTermination()
        events = spark.read.parquet(f"{fresh_dir}/in").where("id IS NOT NULL")
        want = {tuple(r) for r in jobs.status_progress(events).collect()}
        assert {tuple(r) for r in jobs.status_totals(spark, f"{fresh_dir}/out").collect()} == want
    assert jobs.stored_batches(spark, f"{fresh_dir}/out", jobs.CHANGE_SCHEMA).select("run_id").distinct().count() == 1


def test_status_counts_with_a_time_to_live(spark, fresh_dir):
    """A link without events for an hour is forgotten: its next event counts it once more."""
    schema = "id string, s long, event_id long, status string"
    for run, rows in enumerate([[("a", 1, 1, "pending"), ("a", 2, 2, "done")], [("b", 20_000, 3, "pending")], [("a", 20_001, 4, "error"), ("b", 20_002, 5, "done")]]):
        df = spark.createDataFrame(rows, schema).select("id", F.timestamp_seconds("s").alias("ts"), "event_id", "status")
        df.coalesce(1).write.parquet(f"{fresh_dir}/in/{run}")
        stream = jobs.file_stream(spark, f"{fresh_dir}/in/*", df.schema)
        jobs.status_counts(stream, f"{fresh_dir}/out", f"{fresh_dir}/cp", ttl_ms=3_600_000).awaitTermination(60)
    assert {tuple(r) for r in jobs.status_totals(spark, f"{fresh_dir}/out").collect()} == {("done", 2), ("error", 1)}

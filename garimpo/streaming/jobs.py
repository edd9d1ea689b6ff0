"""Incremental versions of capture ingest, first-seen links, upsert and progress.

Each job reads new files once and resumes from its checkpoint. Output is written
per micro-batch under ``run_id`` and ``batch_id``. The run id is kept in the
checkpoint: a batch that is run again after a failure overwrites its own folder,
so every input row counts once, and a job started with a new checkpoint adds to
what earlier runs stored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from garimpo.operators import captures as cap
from garimpo.operators import dedup, queue
from garimpo.session import exists
from garimpo.sources.listing_table import ListingTable
from garimpo.streaming import membership
from garimpo.streaming.membership import BATCH_SCHEMA, FILTER_SCHEMA, SEEN_SCHEMA

def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """New parquet files of a folder or glob as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(stream: DataFrame, job: str, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there now in micro-batches, then stop."""
    return (
        stream.writeStream.queryName(job)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def _run_id(batch: DataFrame) -> str:
    """The id of the running query, which its checkpoint keeps over restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _batch_name(batch: DataFrame, batch_id: int) -> str:
    return f"run_id={_run_id(batch)}/batch_id={batch_id}"


def _batch_folder(path: str, batch: DataFrame, batch_id: int) -> str:
    return f"{path}/{_batch_name(batch, batch_id)}"


def _opened(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Make sure the folder can be read, whether or not an earlier run wrote to it."""
    if exists(spark, path):
        return
    spark.createDataFrame([], schema).write.mode("append").partitionBy("run_id", "batch_id").parquet(path)


def ingest_captures(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Ads of newly arrived captures, appended by the file sink exactly once."""
    return (
        cap.salvaged_ads(cap.answered(stream))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )


def first_seen_links(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Links not seen in any earlier batch, of this run or another.

    The seen links are a table, not operator state: a batch is first reduced to
    one row per link where it is read, then anti-joined, so neither a hot link
    nor years of history has to fit in one task's state store. Of the table only
    the files are read that a filter says may hold one of the links
    (``membership``); the filters lie beside it, in ``<out>-filter``.
    """
    spark, filters = stream.sparkSession, f"{out}-filter"
    _opened(spark, out, SEEN_SCHEMA)

    def write(batch: DataFrame, batch_id: int) -> None:
        own = (F.col("run_id") == _run_id(batch)) & (F.col("batch_id") == batch_id)
        found = batch.groupBy("id").agg(F.min("url").alias("url"), F.min("domain").alias("domain")).persist()
        paths = []
        if exists(spark, filters):
            earlier = batch.sparkSession.read.schema(FILTER_SCHEMA).parquet(filters).where(~own)
            paths = membership.folders(earlier, found, out)
        seen = membership.history(batch.sparkSession, out, paths)
        new = queue.insert_ignore(seen, found).persist()
        membership.add(new, new.count(), out, filters, _batch_name(batch, batch_id))
        new.unpersist()
        found.unpersist()

    return run_available(stream, "first_seen_links", write, checkpoint)


def first_seen_within(stream: DataFrame, delay: str) -> DataFrame:
    """Bounded-state variant: one row per link within the watermark delay."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["id"])


def upsert_listings(
    stream: DataFrame, log: str, checkpoint: str, order: list[str], rejects: str | None = None
) -> StreamingQuery:
    """Append each batch's newest version per id to the listing log.

    Rows the table does not take go to ``rejects`` (by default beside the log),
    where they can be counted.
    """
    side = rejects or f"{log}-rejects"
    schema = T.StructType([*stream.schema.fields, *BATCH_SCHEMA])
    for path in (log, side):
        _opened(stream.sparkSession, path, schema)

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = dedup.last_by(dedup.accepted(batch), ["id"], order)
        newest.write.mode("overwrite").parquet(_batch_folder(log, batch, batch_id))
        dedup.rejected(batch).write.mode("overwrite").parquet(_batch_folder(side, batch, batch_id))

    return run_available(stream, "upsert_listings", write, checkpoint)


def upsert_table(
    stream: DataFrame, table: ListingTable, checkpoint: str, rejects: str, compact_after: int = 16
) -> StreamingQuery:
    """Add each batch's newest versions to a listing table as a delta.

    The table is made with the first batch, and compacted whenever ``compact_after``
    deltas have gathered, so a read merges a bounded number of them. A batch run again
    replaces its delta; once that is in the base, adding it again changes nothing.
    Rows the table does not take, for want of a title or a key, go to ``rejects``.
    """
    _opened(stream.sparkSession, rejects, T.StructType([*stream.schema.fields, *BATCH_SCHEMA]))
    taken = F.col(table.key).isNotNull() & F.col("titulo").isNotNull()

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.where(~taken).write.mode("overwrite").parquet(_batch_folder(rejects, batch, batch_id))
        live = table.manifest()
        if live is None:
            table.create(batch.where(taken))
            return
        table.add(batch.where(taken), f"{_run_id(batch)}-{batch_id}")
        if len(live["deltas"]) + 1 >= compact_after:
            table.compact()

    return run_available(stream, "upsert_table", write, checkpoint)


def stored_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What all runs of a job have stored, with ``run_id`` and ``batch_id``."""
    return spark.read.schema(T.StructType([*schema.fields, *BATCH_SCHEMA])).parquet(path)


def latest_listings(log: DataFrame, order: list[str]) -> DataFrame:
    """The listing table: newest version per id over the log's batches."""
    return dedup.last_by(log, ["id"], [*order, "batch_id"])


def status_log(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append each batch's events, one row per link with its latest status and failed attempts."""
    _opened(stream.sparkSession, out, T.StructType([*PROGRESS_SCHEMA.fields, *BATCH_SCHEMA]))

    def write(batch: DataFrame, batch_id: int) -> None:
        latest = queue.batch_status(batch.select("id", "ts", "event_id", "status"))
        latest.write.mode("overwrite").parquet(_batch_folder(out, batch, batch_id))

    return run_available(stream, "status_log", write, checkpoint)


PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("tentativas", T.LongType()),
    ]
)


CHANGE_SCHEMA = T.StructType([T.StructField("status", T.StringType()), T.StructField("n", T.LongType())])
_STATE_SCHEMA = T.StructType(
    [T.StructField("at", T.LongType()), T.StructField("event_id", T.LongType()), T.StructField("status", T.StringType())]
)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _latest_status(ttl_ms: int | None) -> Callable:
    """Keeps each link's latest event, and tells by -1 and +1 when its status changes."""

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        before = now = state.get if state.exists else None
        for part in parts:
            # Order is by time, then event; within a batch as between batches.
            for at, event_id, status in zip(part["at"], part["event_id"], part["status"], strict=True):
                if now is None or (at, event_id) > (now[0], now[1]):
                    now = (int(at), int(event_id), status)
        if now is not before:
            state.update(now)
            if before is None or before[2] != now[2]:
                gone = [] if before is None else [(before[2], -1)]
                yield pd.DataFrame([*gone, (now[2], 1)], columns=["status", "n"])
        if ttl_ms:
            state.setTimeoutTimestamp(max(now[0] // 1000 + ttl_ms, state.getCurrentWatermarkMs() + 1))

    return run


def status_counts(stream: DataFrame, out: str, checkpoint: str, ttl_ms: int | None = None) -> StreamingQuery:
    """Links per latest status, kept up to date by the changes of each batch.

    The latest event of each link is keyed state in RocksDB, in the checkpoint; a
    batch adds a row per status to ``out``, the sum of its changes, and nothing that
    was stored is read again. ``status_totals`` has the answer.

    ``ttl_ms`` forgets a link when events that much later than its last one have
    come, and leaves it counted under its last status; events older than that are
    late and no longer read. None keeps all. Events without an id are of no link.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    _opened(spark, out, T.StructType([*CHANGE_SCHEMA.fields, *BATCH_SCHEMA]))
    events = stream.where("id IS NOT NULL").withColumn("ts", F.col("ts").cast("timestamp"))
    events = events.withWatermark("ts", f"{ttl_ms} milliseconds") if ttl_ms else events
    timeout = GroupStateTimeout.EventTimeTimeout if ttl_ms else GroupStateTimeout.NoTimeout
    rows = events.select("id", "ts", F.unix_micros("ts").alias("at"), "event_id", "status").groupBy("id")
    changes = rows.applyInPandasWithState(_latest_status(ttl_ms), CHANGE_SCHEMA, _STATE_SCHEMA, "update", timeout)

    def write(batch: DataFrame, batch_id: int) -> None:
        sums = batch.groupBy("status").agg(F.sum("n").alias("n")).coalesce(1)
        sums.write.mode("overwrite").parquet(_batch_folder(out, batch, batch_id))

    return run_available(changes, "status_counts", write, checkpoint, mode="update")


def status_totals(spark: SparkSession, out: str) -> DataFrame:
    """Links per latest status: the changes of all batches added up, a few rows a batch."""
    changes = stored_batches(spark, out, CHANGE_SCHEMA)
    return changes.groupBy("status").agg(F.sum("n").alias("n")).where("n <> 0")


def status_progress(log: DataFrame) -> DataFrame:
    """Links per latest status, over all batches stored so far."""
    latest = log.groupBy("id").agg(F.max_by("status", F.struct("ts", "event_id")).alias("status"))
    return latest.groupBy("status").agg(F.count("*").alias("n"))

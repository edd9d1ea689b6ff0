"""Sinks. Every writer writes a new folder in parallel and returns its path."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.operators.dedup import last_by
from garimpo.sources.readers import CSV_OPTIONS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_FILE = 500_000  # quoted line breaks keep a CSV file from being split when it is read again


def _csv(df: DataFrame, path: str) -> str:
    df.write.option("maxRecordsPerFile", ROWS_PER_FILE).options(**{k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}).option(
        "emptyValue", ""
    ).csv(path)
    return path


def _with_export_columns(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
            for c in C.EXPORT_COLUMNS
        ]
    )


def rejects(df: DataFrame, path: str) -> str:
    """Append rows a table did not take to its side table."""
    df.write.mode("append").parquet(path)
    return path


def export_json(df: DataFrame, path: str) -> str:
    """Listings as JSON lines, nulls left out."""
    df.write.json(path)
    return path


def _bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's records as the lines of one array: all but the last with a comma. No records, no lines."""

    def lines(values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([values], names=["value"])

    last = None
    for batch in batches:
        texts = batch.column(0).cast(pa.string())
        if not len(texts):
            continue
        yield lines(pa.array(["["] if last is None else [last + ","]))
        yield lines(pc.binary_join_element_wise(texts[:-1], ",", ""))
        last = texts[-1].as_py()
    if last is not None:
        yield lines(pa.array([last, "]"]))


def export_array(df: DataFrame, folder: str, prefix: str = "imoveis", indent: int = 2) -> str | None:
    """Listings as indented JSON arrays, one a task, in a new folder named by prefix and time.

    Nulls are written. Without rows nothing is left behind and None is returned; the rows
    are counted in the job that writes them. Files come and go by the committer of Spark's writer, so a job that
    fails leaves none, and a task that runs twice writes one.
    """
    path = f"{folder.rstrip('/')}/{prefix}_{datetime.now():%Y%m%d_%H%M%S_%f}"
    pad = " " * indent
    record = F.to_json(F.struct(*(df[c] for c in df.columns)), {"pretty": "true", "ignoreNullFields": "false"})
    # Line breaks within strings are escaped, so each that is left begins a line of the record.
    indented = F.concat(F.lit(pad), F.replace(record, F.lit("\n"), F.lit("\n" + pad)))
    seen = Observation()
    counted = df.select(indented.alias("value")).observe(seen, F.count("*").alias("n"))
    # A limit on rows would cut an array in two.
    counted.mapInArrow(_bracketed, "value string").write.option("maxRecordsPerFile", 0).text(path)
    written = seen.get["n"] > 0
    _remove_empty(df, path, whole=not written)
    return path if written else None


def _remove_empty(df: DataFrame, path: str, whole: bool) -> None:
    """The file without bytes that Spark's first task leaves if it has no rows, or the ``whole`` folder if none has."""
    at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    if whole:
        store.delete(at, True)
        return
    for file in store.listStatus(at):
        if file.getLen() == 0 and file.getPath().getName().startswith("part-00000"):
            store.delete(file.getPath(), False)


def export_csv(df: DataFrame, path: str) -> str:
    """Fifteen export columns with a header; null is written empty."""
    return _csv(_with_export_columns(df), path)


def export_csv_by(df: DataFrame, column: str, path: str) -> str:
    """The export as one folder of files for each value of a column; a value of many rows is split over tasks."""
    wanted = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in C.EXPORT_COLUMNS]
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}
    rows = df.select(*wanted, column).hint("rebalance", column)
    rows.write.option("maxRecordsPerFile", ROWS_PER_FILE).options(**options).option("emptyValue", "").partitionBy(column).csv(path)
    return path


def export_csv_localized(df: DataFrame, path: str) -> str:
    """Export with display headings, newest first across the part files."""
    ordered = _with_export_columns(df).orderBy(F.desc_nulls_last("data_coleta"), F.asc("id"))
    return _csv(ordered.withColumnsRenamed(C.CSV_HEADINGS), path)


def consolidated_csv(df: DataFrame, path: str) -> str:
    """A consolidated table as CSV, in its own order."""
    return _csv(df.select(*[c for c in df.columns if c != "coletado_em"]), path)


def listing_log(df: DataFrame, path: str) -> str:
    """Append versions to the listing log, partitioned by source for pruning.

    Rebalancing keeps the files per source few, and splits a source that holds
    a large part of the rows.
    """
    df.hint("rebalance", "fonte").write.mode("append").partitionBy("fonte").parquet(path)
    return path


def compacted_log(log: DataFrame, path: str, order: list[str]) -> str:
    """Rewrite a listing log to a new folder with one row per id."""
    return listing_log(last_by(log, ["id"], order), path)


def status_events(df: DataFrame, path: str) -> str:
    """Append status events; updates are new rows, never rewrites."""
    df.write.mode("append").parquet(path)
    return path

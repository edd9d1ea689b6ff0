"""Files of one indented JSON array: split over tasks, cut off, in other layouts, written and read again."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.sources import readers, writers

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])


def records(n, seed=1):
    """Records whose strings and inner objects look like record borders."""
    rng = random.Random(seed)
    return [{"id": i, "t": "é" * rng.randint(0, 60) + '},\n  {"\\', "deep": {"a": [{"b": i}, {}, {"c": {}}]}} for i in range(n)]


def rows_of(df):
    return sorted((r.id, r.t) for r in df.collect())


def expected(items):
    return sorted((r["id"], r["t"]) for r in items)


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, v) for k, v in zip(old, (size, 1))]
    for key, value in old.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize(("indent", "size"), [(2, 501), (2, 1777), (2, 64_000), (4, 700), (1, 900)])
def test_records_of_a_split_file(spark, fresh_dir, small_splits, indent, size):
    items = records(200)
    (Path(fresh_dir) / "a.json").write_text(json.dumps(items, indent=indent, ensure_ascii=False))
    small_splits(size)
    rows = readers.json_array(spark, fresh_dir, SCHEMA, indent)
    assert rows_of(rows) == expected(items)
    assert rows_of(readers.json_array(spark, fresh_dir, SCHEMA, indent, whole_files=True)) == expected(items)
    assert readers.json_array_rejects(spark, fresh_dir, indent).count() == 0 == readers.cut_files(spark, fresh_dir, indent).count()


def test_large_array_is_read_by_many_tasks(spark, fresh_dir, small_splits):
    """24 MB with splits of 2 MB, as 200 MB and more have under the defaults."""
    with open(f"{fresh_dir}/big.json", "w") as out:
        json.dump([{"id": i, "t": "x" * 1000} for i in range(24_000)], out, indent=2)
    small_splits(2 * 1024**2)
    rows = readers.json_array(spark, fresh_dir, SCHEMA)
    used = rows.select("id", F.spark_partition_id().alias("task")).groupBy("task").agg(F.count("*").alias("n"))
    assert used.count() >= 8
    assert rows.agg(F.count("*"), F.countDistinct("id"), F.sum(F.length("t"))).first()[:] == (24_000, 24_000, 24_000_000)


def test_every_cut_off_length_keeps_whole_records_only(spark, fresh_dir):
    text = json.dumps(records(3), indent=2)
    for end in range(0, len(text), 7):
        (Path(fresh_dir) / f"{end:05d}.json").write_text(text[:end])
    (Path(fresh_dir) / f"{len(text):05d}.json").write_text(text)
    ends = [text.index('\n  }', text.index(f'"id": {i}')) + 4 for i in range(3)]
    want = {f"{n:05d}": sum(n >= e for e in ends) for n in [*range(0, len(text), 7), len(text)]}
    name = F.regexp_extract("arquivo", r"(\d+)\.json$", 1).alias("n")
    pieces = readers._array_pieces(spark, fresh_dir, 2).select(name, F.explode("registros").alias("r"))
    got = {r["n"]: r["count"] for r in pieces.groupBy("n").count().collect()}
    assert {k: v for k, v in want.items() if v} == got
    whole = {r["n"] for r in readers.cut_files(spark, fresh_dir).select(name).collect()}
    assert set(want) - whole == {f"{len(text):05d}", "00000"}  # an empty file has nothing to reject
    assert rows_of(readers.json_array(spark, fresh_dir, SCHEMA, whole_files=True)) == expected(records(3))


def test_other_layouts_and_bad_records(spark, fresh_dir):
    items = records(5)
    texts = {
        "line": json.dumps(items),
        "other_indent": json.dumps(items, indent=8),
        "crlf": json.dumps(items, indent=2).replace("\n", "\r\n"),
        "bom": "﻿" + json.dumps(items, indent=2),
        "none": "[]",
        "none_open": "[\n]\n",
        "empty": "",
        "blank": " \n",
        "empty_record": json.dumps([{}, {"id": 1, "t": "a"}, {}], indent=2),
        "mixed": json.dumps([{"id": 1, "t": "a"}, 7, None, "x", {"id": 2, "t": None}], indent=2),
        "no_json": "this is no JSON",
        "after": json.dumps(items, indent=2) + " and more",
        "commas": json.dumps(items, indent=2).replace("\n  },\n  {", "\n  },,\n  {", 1),
        "one": json.dumps({"id": 1, "t": "a"}, indent=2),
    }
    rows, bad, cut = {}, {}, set()
    for name, text in texts.items():
        folder = Path(fresh_dir) / name
        folder.mkdir()
        (folder / "f.json").write_bytes(text.encode())
        rows[name] = [tuple(r) for r in readers.json_array(spark, str(folder), SCHEMA).collect()]
        bad[name] = readers.json_array_rejects(spark, str(folder)).count()
        cut |= {name} if readers.cut_files(spark, str(folder)).count() else set()
    for name in ("line", "other_indent", "crlf", "bom"):
        assert sorted(rows[name]) == expected(items), name
    assert not any(rows[n] for n in ("none", "none_open", "empty", "blank", "no_json", "one"))
    assert rows["empty_record"] == [(None, None), (1, "a"), (None, None)]
    assert rows["mixed"] == [(1, "a"), (2, None)] and bad["mixed"] == 3
    assert len(rows["after"]) == 4 and bad["after"] == 1
    assert sorted(rows["commas"]) == expected(items)
    assert {n: b for n, b in bad.items() if b} == {"mixed": 3, "after": 1, "no_json": 1, "one": 1}
    assert cut == {"commas", "no_json", "after", "one", "blank"}


def test_written_arrays_are_whole_and_come_back(spark, fresh_dir):
    rows = [(str(i), 'a "b"\n},\n  {' if i % 2 else None) + (None,) * (len(readers.EXPORT_SCHEMA) - 2) for i in range(500)]
    df = spark.createDataFrame(rows, readers.EXPORT_SCHEMA).repartition(5)
    path = writers.export_array(df, fresh_dir)
    assert Path(path).name.startswith("imoveis_2")
    files = sorted(Path(path).glob("part-*"))
    stored = [json.loads(f.read_text()) for f in files]
    assert len(files) == 5 and sorted(int(r["id"]) for part in stored for r in part) == list(range(500))
    assert all(f.read_text().startswith('[\n  {\n    "id"') and f.read_text().endswith("\n  }\n]\n") for f in files)
    assert list(stored[0][0]) == readers.EXPORT_SCHEMA.names
    back = readers.json_array(spark, path, readers.EXPORT_SCHEMA, whole_files=True)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_nothing_is_written_for_no_rows_nor_by_a_failed_job(spark, fresh_dir):
    none = spark.createDataFrame([], readers.EXPORT_SCHEMA)
    assert all(writers.export_array(df, fresh_dir) is None for df in (none, none.limit(0), spark.range(9).filter("false"))) and not list(Path(fresh_dir).iterdir())
    # The first task has no rows: its file without bytes is no array.
    late = spark.range(100, numPartitions=4).filter("id >= 60").select(F.col("id").cast("string").alias("id"))
    files = [f.read_text() for f in Path(writers.export_array(late, fresh_dir)).glob("part-*")]
    assert sum(len(json.loads(f)) for f in files) == 40
    fails = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("stop"))).otherwise("x").alias("id"))
    with pytest.raises(Exception, match="stop"):
        writers.export_array(fails, f"{fresh_dir}/failed")
    assert not list(Path(fresh_dir).glob("failed/**/part-*"))

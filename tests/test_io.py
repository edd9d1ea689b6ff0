import json
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.session import scratch_path, shared_dir
from garimpo.sources import readers, writers


@pytest.fixture
def listings(spark):
    rows = [
        tuple(["1", 'Casa "boa", nova'] + [None] * 4 + ['linha 1\nlinha "2"', "Rua Ç"] + [None] * 5 + ["OLX", "2025-01-01"]),
        tuple(["2", "Apto"] + [""] * 11 + [None, "2025-01-02"]),
    ]
    return spark.createDataFrame(rows, readers.EXPORT_SCHEMA)


def test_csv_round_trip_keeps_newlines_and_quotes(spark, listings, fresh_dir):
    back = readers.export_csv(spark, writers.export_csv(listings, f"{fresh_dir}/csv"))
    rows = {r.id: r for r in back.collect()}
    assert rows["1"].descricao == 'linha 1\nlinha "2"' and rows["1"].titulo == 'Casa "boa", nova'
    assert rows["2"].preco is None and rows["2"].fonte is None


def test_localized_csv_is_newest_first(spark, listings, fresh_dir):
    path = writers.export_csv_localized(listings.coalesce(1), f"{fresh_dir}/pt")
    parts = sorted(Path(path).glob("part-*.csv"))
    lines = "".join(p.read_text() for p in parts[:1])
    assert lines.startswith(",".join(C.CSV_HEADINGS.values()))
    shown = spark.read.options(**readers.CSV_OPTIONS).csv(path)
    assert shown.columns == list(C.CSV_HEADINGS.values()) and shown.count() == 2


def test_json_round_trip(spark, listings, fresh_dir):
    back = readers.export_json(spark, writers.export_json(listings, f"{fresh_dir}/json"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, listings.collect()))


def test_capture_files_unreadable_one_is_empty(spark, fresh_dir):
    folder = Path(fresh_dir)
    (folder / "a.json").write_text(json.dumps([{"type": "fetch", "url": "u", "status": 200, "text": "t"}, {"status": 403}], indent=2))
    (folder / "b.json").write_text("this is no JSON")
    rows = readers.capture_json(spark, str(folder)).collect()
    assert sorted((r.status, r.text) for r in rows) == [(200, "t"), (403, None)]
    rejects = readers.capture_rejects(spark, str(folder))
    assert rejects.count() == 1 and rejects.first().arquivo.endswith("b.json")


def test_latest_file_and_glob(spark, listings, fresh_dir):
    folder = Path(fresh_dir)
    header = ",".join(C.EXPORT_COLUMNS)
    for name, n in [("imoveis_20250101.csv", 1), ("imoveis_20250301.csv", 2)]:
        (folder / name).write_text(header + "\n" + "".join(f"{name}-{i}" + "," * 14 + "\n" for i in range(n)))
    rows = readers.export_csv(spark, f"{folder}/imoveis_*.csv")
    assert rows.count() == 3
    newest = readers.latest_file(spark, str(folder), "imoveis_*.csv")
    assert [r.id for r in readers.export_csv(spark, newest).orderBy("id").collect()] == [f"imoveis_20250301.csv-{i}" for i in range(2)]
    assert readers.latest_file(spark, str(folder), "nothing*") is None
    (folder / "imoveis_20250401.csv").write_text(header + "\n")
    empty = readers.files_without_rows(spark, str(folder), readers.export_csv(spark, f"{folder}/imoveis_*.csv")).collect()
    assert [r.arquivo.rsplit("/", 1)[1] for r in empty] == ["imoveis_20250401.csv"]


def test_latest_batch_has_all_its_files(spark, fresh_dir, monkeypatch):
    """127 rows in files of 50: the newest batch is read whole."""
    monkeypatch.setattr(writers, "ROWS_PER_FILE", 50)
    rows = spark.range(200).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") < 73, "1").otherwise("2").alias("lote"))
    writers.export_csv_by(rows, "lote", f"{fresh_dir}/out")
    newest = readers.latest_batch(spark, f"{fresh_dir}/out", "*.csv")
    assert newest.endswith("lote=2") and readers.export_csv(spark, newest).count() == 127
    assert readers.latest_batch(spark, f"{fresh_dir}/out", "*.json") is None


def test_page_files(spark, fresh_dir):
    for name in ("a", "b"):
        (Path(fresh_dir) / f"{name}.html").write_text(f"<title>{name}</title>\n<p>x")
    rows = readers.page_files(spark, f"{fresh_dir}/*.html").orderBy("url").collect()
    assert [r.html for r in rows] == ["<title>a</title>\n<p>x", "<title>b</title>\n<p>x"]
    assert len({r.page_id for r in rows}) == 2 and rows[0].url.endswith("a.html")


def test_keyword_lines(spark, fresh_dir):
    path = Path(fresh_dir) / "k.txt"
    path.write_text("  casa curitiba \n\n \t\napto\n")
    assert [r.keyword for r in readers.keyword_lines(spark, str(path)).collect()] == ["casa curitiba", "apto"]


def test_listing_log_and_scratch(spark, listings):
    log = scratch_path(spark, "log")
    assert log.startswith(shared_dir(spark)) and log != scratch_path(spark, "log")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    writers.listing_log(listings, log)
    writers.listing_log(listings, log)
    assert spark.read.parquet(log).count() == 4
    assert spark.read.parquet(log).filter("fonte = 'OLX'").count() == 2
    small = writers.compacted_log(spark.read.parquet(log), scratch_path(spark, "log"), ["data_coleta"])
    assert sorted(r.id for r in spark.read.parquet(small).collect()) == ["1", "2"]

"""Sketches per load against exact distinct counts."""

import pytest
from pyspark.sql import functions as F

from garimpo.operators import report, sketches

COLUMNS = ["cidade", "fonte", "vazia"]


@pytest.fixture(scope="module")
def loads(spark):
    """Five loads that share most cities: 40,000 to 60,000 each, 80,000 in all."""
    def load(i):
        ids = spark.range(i * 10_000, i * 10_000 + 40_000, numPartitions=4)
        city = F.when(F.col("id") % 10 == 0, None).otherwise(F.concat(F.lit("cidade "), F.col("id")))
        return ids.select(city.alias("cidade"), F.when(F.col("id") % 2 == 0, "OLX").otherwise("VIVA").alias("fonte"), F.lit(None).cast("string").alias("vazia"))

    return [load(i) for i in range(5)]


@pytest.fixture(scope="module")
def table(spark, loads, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("run-sketches"))
    for i, rows in enumerate(loads):
        sketches.store(rows, COLUMNS, path, f"2025-01-0{i + 1}")
    return path


def test_merged_sketches_are_near_the_exact_counts(spark, loads, table):
    whole = loads[0]
    for rows in loads[1:]:
        whole = whole.unionByName(rows)
    merged = {r.campo: r for r in sketches.distinct_by_column(sketches.stored(spark, table)).collect()}
    for column in COLUMNS:
        exact, row = report.distinct_count(whole, column).first()["n"], merged[column]
        assert abs(row.distintos - exact) <= 0.02 * exact, column
        assert row.cargas == 5 and row.linhas == 200_000
        assert row.preenchidos == whole.filter(F.col(column).isNotNull()).count()
    assert merged["fonte"].distintos == 2 and merged["vazia"].distintos == 0


def test_a_load_is_a_row_a_column_and_replaces_itself(spark, loads, table):
    before = sketches.stored(spark, table).count()
    sketches.store(loads[2], COLUMNS, table, "2025-01-03")
    rows = sketches.stored(spark, table)
    assert rows.count() == before == 5 * len(COLUMNS)
    assert rows.agg(F.max(F.length("esboco"))).first()[0] < 20_000


def test_new_values_by_load(spark, table):
    rows = {(r.campo, r.carga): r for r in sketches.new_by_load(sketches.stored(spark, table)).collect()}
    assert len(rows) == 5 * len(COLUMNS)
    first = rows["cidade", "2025-01-01"]
    assert first.novos == first.distintos and abs(first.distintos - 36_000) < 720
    for day in range(2, 6):
        assert abs(rows["cidade", f"2025-01-0{day}"].novos - 9_000) < 1_500
        assert rows["fonte", f"2025-01-0{day}"].novos == 0 == rows["vazia", f"2025-01-0{day}"].novos


def test_tables_without_rows(spark, loads, fresh_dir):
    sketches.store(loads[0].limit(0), COLUMNS, fresh_dir, "a")
    got = [tuple(r) for r in sketches.distinct_by_column(sketches.stored(spark, fresh_dir)).collect()]
    assert sorted(got) == [(c, 1, 0, 0, 0) for c in sorted(COLUMNS)]
    none = sketches.stored(spark, fresh_dir).filter("false")
    assert sketches.distinct_by_column(none).count() == 0 == sketches.new_by_load(none).count()

"""The gazetteer look-up against a search of every name in every text."""

import random

import pytest

from garimpo.functions.text import FOLD_FROM, FOLD_TO
from garimpo.operators import discover, places

FOLD = str.maketrans(FOLD_FROM, FOLD_TO)
PLACE = "ordem int, nome string, uf string"


def first_named(text, gazetteer):
    """Brute force: the first place whose folded name lies in the folded text."""
    if text is None:
        return None
    folded = text.lower().translate(FOLD)
    hits = [p for p in gazetteer if p[1] and p[1].lower().translate(FOLD) in folded]
    return min(hits) if hits else None


def looked_up(spark, texts, gazetteer):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "place_no int, t string")
    found = places.first_places(rows, "t", spark.createDataFrame(gazetteer, PLACE))
    return found, {r.place_no: tuple(r.place) if r.place else None for r in found.collect()}


@pytest.fixture(scope="module")
def gazetteer():
    """5,000 places of shared syllables, some a part of others."""
    rng = random.Random(5)
    parts = ["são ", "santa ", "rio ", "nova ", "porto ", "belo ", "vila ", ""]
    rooms = ["cam", "pos", "hori", "zon", "te", "ju", "iz", "ara", "ca", "ju", "mar", "ingá", "bê", "lém", "gu", "ç"]
    names = set()
    while len(names) < 5000:
        names.add(rng.choice(parts) + "".join(rng.choices(rooms, k=rng.randint(1, 5))))
    return [(i, n, "UF"[: 1 + i % 2]) for i, n in enumerate(sorted(names, key=lambda n: (rng.random(), n)))]


def test_large_gazetteer_equals_search_of_all_names(spark, gazetteer):
    rng = random.Random(6)
    texts = [f"{rng.choice(['Casa', 'apto'])} em {rng.choice(gazetteer)[1].upper()} {rng.choice(['', 'centro', gazetteer[9][1]])}" for _ in range(300)]
    texts += ["", None, "zzz", "ç", "x" * 20_000 + gazetteer[77][1]]
    found, got = looked_up(spark, texts, gazetteer)
    assert got == {i: first_named(t, gazetteer) for i, t in enumerate(texts)}
    assert sum(v is not None for v in got.values()) > 290
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_short_names_order_ties_and_repeats(spark):
    gazetteer = [(2, "Rio", "RJ"), (1, "rio preto", "SP"), (3, "Itá", "SC"), (3, "Itá", "SC"), (3, "Ita", "AA"), (0, "", "XX"), (0, None, "YY"), (None, "só", "ZZ")]
    texts = ["criolo", "Rio Preto", "ITÁ", "so", "rio", "rio", None, "   ", "r"]
    usable = [p for p in gazetteer if p[0] is not None]
    _, got = looked_up(spark, texts, gazetteer)
    want = {i: first_named(t, usable) for i, t in enumerate(texts)} | {3: (None, "só", "ZZ")}
    assert got == want


def test_empty_gazetteer_and_texts_and_a_hot_text(spark):
    none = spark.createDataFrame([], PLACE)
    words = spark.createDataFrame([("casa em recife", 1, "p")] * 500 + [(None, 2, "p")], "keyword string, n int, place string")
    assert places.first_places(words, "keyword", none, "found").filter("found is null").count() == 501
    placed = discover.keyword_places(words)
    assert placed.columns == ["keyword", "n", "place", "cidade", "estado", "tipo"]
    assert {tuple(r) for r in placed.collect()} == {
        ("casa em recife", 1, "p", "recife", "PE", "casa"),
        (None, 2, "p", "curitiba", "PR", "apartamento"),
    }
    assert placed.count() == 501 and discover.keyword_places(words.limit(0)).count() == 0


def test_texts_are_never_broadcast(spark, fresh_dir):
    """Texts of a small file become many pieces; only the gazetteer may be sent to the driver."""
    rows = [(f"Casa em {('Recife', 'São Paulo', 'centro')[i % 3]} {i}",) for i in range(300)] + [(None,)]
    spark.createDataFrame(rows, "keyword string").write.parquet(f"{fresh_dir}/words")
    placed = discover.keyword_places(spark.read.parquet(f"{fresh_dir}/words"))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    broadcast = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert broadcast and all("[piece" in line and "BuildRight" in line for line in broadcast)
    assert "LeftOuter" in broadcast[0] and plan.count("SortMergeJoin") == 2
    cities = [r.cidade for r in placed.collect()]
    assert {c: cities.count(c) for c in set(cities)} == {"recife": 100, "sao paulo": 100, "curitiba": 101}

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from garimpo.llm import jaccard as J
from garimpo.llm.components import components


def plain(rows, size, percent):
    """Component by row number, over all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()})
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return [(rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))]


def near_copies(seed, n):
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(60)]
    rows, bases = [], [[rng.choice(words) for _ in range(rng.choice([3, 12, 40, 90]))] for _ in range(6)]
    for i in range(n):
        own = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            own[rng.randrange(len(own))] = f"u{rng.randrange(9)}"
        if rng.random() < 0.2:
            bases.append(own)
        rows.append((i + 1, " ".join(own)))
    return rows


@pytest.mark.parametrize(("seed", "size", "percent"), [(1, 3, 90), (2, 3, 70), (3, 5, 80), (4, 1, 60), (5, 2, 50)])
def test_equals_brute_force(documents, seed, size, percent):
    rows = near_copies(seed, 160) + [(900, None), (901, " \n"), (902, ""), (903, "one two"), (904, "ONE two")]
    got = J.linked_components(documents(rows), size=size, percent=percent).drop("tid").collect()
    assert sorted(map(tuple, got)) == sorted(plain(rows, size, percent))


def test_repeated_and_null_ids(documents):
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(None, text), (4, text), (4, text), (4, "other words here now"), (None, "alone with none"), (2, text + " b"), (None, None)]
    got = J.linked_components(documents(rows), size=3, percent=80).drop("tid").collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(rows, 3, 80), key=str)


def test_one_of_each_keeps_columns(documents):
    text = " ".join(f"a{i}" for i in range(40))
    rows = [(3, text), (2, text + " x"), (9, None), (8, ""), (5, "quite another text of more than five words"), (5, "quite another text of more than five words")]
    docs = documents(rows).withColumnRenamed("lang", "component_id").withColumnRenamed("source", "G_ID")
    kept = J.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 5, 8, 9]
    assert J.one_of_each(documents([])).count() == 0


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (None, 3), (200, 199), (199, 198)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {v for k, v in found.items() if k <= 40} == {0}
    assert {v for k, v in found.items() if 100 <= k < 130} == {100}
    assert found[200] == found[199] == found[198] == 198
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_prefix_join_is_not_a_cross_join(documents):
    found = J.linked_components(documents(near_copies(9, 40)))
    plan = found.select(F.count("*"))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan

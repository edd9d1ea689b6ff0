import hashlib
import math
from collections import defaultdict

import pytest

from garimpo.llm import mixing as M


def plain(rows, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by repeated resharing, selection by one sorted list a source."""
    sized = [(i, s, len((t or "").split()), t or "") for i, s, t in rows]
    sizes = defaultdict(int)
    for _, s, n, _ in sized:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if most * sizes[s] <= level * weight[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: float(most * sizes[s]) for s in full}
        open_ -= full
    out = []
    for s in order:
        def key(r):
            u = (int(hashlib.md5(str(r[0] if r[0] is not None else "").encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            marks = sum(c in M.MARKS for c in r[3])
            return (-math.log(u) / ((r[2] + 1) / (r[2] + 1 + marks)), r[0] is None, r[0] or 0, r[2])

        epochs = math.floor(target[s] / sizes[s]) if sizes[s] else 0
        left = math.floor(target[s]) - epochs * sizes[s]
        for r in sorted((r for r in sized if r[1] == s), key=key):
            part = max(0, min(r[2], left))
            left -= r[2]
            out.append((r[0], r[1], r[2], sizes[s], target[s], epochs * r[2] + part))
    return out


ROWS = (
    [(i, f"s{i % 3}", "w " * (i % 17)) for i in range(80)]
    + [(i, "hot", "word| word*! " * (i % 9 + 1)) for i in range(100, 300)]
    + [(400 + i, None, "a\tb\nc") for i in range(5)]
    + [(500, "blank", None), (501, "blank", " \n"), (502, "é", "one"), (503, "Z", "one two"), (7, "s1", "same id"), (None, "s0", "no id here")]
)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)


@pytest.mark.parametrize(("weights", "share", "most"), [((3.0, 1.0, 2.0), 1.5, 2), ((1.0,), 0.5, 2), ((1.0, 5.0), 2.5, 3)])
def test_equals_plain_selection(spark, weights, share, most):
    got = M.mixed(frame(spark, ROWS), weights=weights, share=share, most=most)
    rows = [(r["doc_id"], r["source"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in got.collect()]
    expected = [(*e[:4], round(e[4], 6), e[5]) for e in plain(ROWS, weights, share, most)]
    assert sorted(rows, key=str) == sorted(expected, key=str)


def test_sources_meet_their_targets(spark):
    taken, target = defaultdict(int), {}
    for r in M.mixed(frame(spark, ROWS)).collect():
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - t) < 1 for s, t in target.items())
    assert abs(sum(target.values()) - 1.5 * sum(len((t or "").split()) for *_, t in ROWS)) < 1e-6


def test_quality_raises_the_chance(spark):
    rows = [(i, "a", "w w w w") for i in range(400)]
    df = frame(spark, rows)
    got = M.mixed(df, share=0.3, quality=(df["doc_id"] % 2) * 9.0 + 1).collect()
    good, bad = (sum(r["taken"] for r in got if r["doc_id"] % 2 == x) for x in (1, 0))
    assert good > 2 * bad > 0


def test_empty_tables_and_reruns(spark):
    assert M.mixed(frame(spark, [])).count() == 0
    assert [(r["target"], r["taken"]) for r in M.mixed(frame(spark, [(1, "a", None)])).collect()] == [(0.0, 0)]
    one, other = (sorted(map(str, M.mixed(frame(spark, ROWS).repartition(n)).collect())) for n in (1, 7))
    assert one == other

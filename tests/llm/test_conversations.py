"""Conversation repair against a plain search, whole and in pieces."""

import hashlib
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from garimpo.llm import conversations as C

NAMES = ["conv_id", *C.NUMBERS, "audit", "repaired_sha256"]


def brute(rows):
    """The result of one conversation's (turn, role, text) rows, in order, from the rules."""
    faults, seen = [], set()
    for _, role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1] not in ".!?":
            faults.append("truncated")
        else:
            faults.append("")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, audit_state):
        """(cost, audit, lines) from row i on; states are '', s, u, a."""
        q, inserts = audit_state
        found = [(0, "", ())] if i == len(rows) and q in ("", "a") else []
        to = "a" if q == "u" else "u"
        if inserts < 3:
            c, a, lines = best(i, (to, inserts + 1))
            found.append((c + 2, "I" + a, ({"u": "user:", "a": "assistant:"}[to], *lines)))
        if i < len(rows):
            _, role, text = rows[i]
            c, a, lines = best(i + 1, (q, 0))
            found.append((c + 3, "D" + a, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                c, a, lines = best(i + 1, (to, 0))
                found.append((c + 2 + more, "R" + a, ({"u": "user", "a": "assistant"}[to] + ":" + text, *lines)))
                if (role[:1] == "s" and q == "") or (role[:1] in ("u", "a") and role[:1] == to):
                    c, a, lines = best(i + 1, (role[:1], 0))
                    found.append((c + more, "K" + a, (f"{role}:{text}", *lines)))
        return min(found, default=(10**9, "", ()))

    for i in range(len(rows), -1, -1):  # from behind, so that no call goes deep
        for q in ("", "s", "u", "a"):
            best(i, (q, 0))
    cost, audit, lines = best(0, ("", 0))
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    pairs = [(a[1][:1] + b[1][:1]) for a, b in zip(rows, rows[1:], strict=False)]
    return (
        gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def expected(rows):
    """From damaged (conv, turn, role, text, copies) rows that have no ties of turn."""
    out = {}
    for conv, turn, role, text, copies in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        out.setdefault(conv, []).extend([(turn, " " if role is None else role, " " if text is None else text)] * copies)
    return sorted(((conv, *brute(x)) for conv, x in out.items()), key=str)


SCHEMA = "conv_id long, turn long, role string, text string, copies int"


def got(spark, rows):
    found = C.report(spark.createDataFrame(rows, SCHEMA).repartition(3))
    return sorted((tuple(r[c] for c in NAMES) for r in found.collect()), key=str)


def some_rows(seed, conversations, longest, roles=("system", "user", "assistant", "tool", None)):
    rng = np.random.default_rng(seed)
    texts = ["Yes.", "No", "no \n", "", " ", " ", "What? ", "long text!", None]
    rows = []
    for conv in [None, *range(conversations)]:
        turns = rng.choice(3 * longest, size=rng.integers(1, longest + 1), replace=False).tolist()
        for turn in turns if rng.random() > 0.1 else [None]:
            role = roles[rng.choice(len(roles), p=[0.1, 0.4, 0.35, 0.1, 0.05])]
            rows.append((conv, turn, role, str(texts[rng.integers(9)] or "") + (f"{turn}." if rng.random() < 0.5 else ""), int(rng.integers(0, 3))))
    return rows


def test_whole_conversations(spark):
    rows = some_rows(1, 60, 9)
    assert got(spark, rows) == expected(rows)


def test_conversations_in_pieces(spark, monkeypatch):
    """Many pieces: a conversation of most rows, small slices, small batches."""
    rows = some_rows(2, 12, 6)
    rng = np.random.default_rng(3)
    for turn in range(400):
        role = ["user", "assistant", "system", "tool"][rng.choice(4, p=[0.45, 0.4, 0.05, 0.1])]
        rows.append((99, turn if turn > 3 else None if turn == 3 else turn, role, f"text {turn % 150}" + "." * int(rng.integers(0, 2)), int(rng.integers(0, 3))))
    monkeypatch.setattr(C, "PIECE", 20)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        assert got(spark, rows) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "x", ""]), st.sampled_from(["a.", "b", " ", "c!"])), max_size=7), st.randoms())
def test_least_paths(rows, random):
    import pyarrow as pa

    rows = [(i, r, t) for i, (r, t) in enumerate(rows)]
    table = pa.table(
        {
            "conv": pa.array([1] * max(1, len(rows))), "turn": pa.array([t for t, _, _ in rows] or [0]), "role": pa.array([r for _, r, _ in rows] or [""]),
            "text": pa.array([t for _, _, t in rows] or [""]), "copies": pa.array([1] * len(rows) or [0], pa.int32()),
        }
    )
    found = C.repaired(table).to_pylist()[0]
    assert tuple(found[c] for c in NAMES[1:]) == brute(tuple(rows))


def test_damage(spark):
    rows = [(c, t, "assistant", "Hm. Yes! No?") for c in (*range(30), None) for t in (*range(3), None)]
    rows += [(77, 1, None, None)]
    damaged = C.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    seen = set()
    for r in damaged:
        luck = zlib.crc32(f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}".encode()) % 20
        if r.conv_id == 77:
            assert r.role in (" ", "user") and r.text.strip() == ""
            continue
        assert r.copies == {0: 0, 3: 2}.get(luck, 1)
        assert r.text == {1: "", 2: "Hm Yes No"}.get(luck, "Hm. Yes! No?")
        assert r.role == ("user" if luck == 4 else "assistant")
        seen.add(luck)
    assert {0, 1, 2, 3, 4} <= seen


def test_empty_table_and_lost_conversations(spark):
    assert got(spark, []) == []
    nothing = hashlib.sha256(b"").hexdigest()
    assert got(spark, [(1, 1, "user", "x", 0), (1, 2, "user", "x", 0)]) == [(1, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_ties_repeated_rows_and_other_columns(spark):
    """Equal rows are duplicates wherever they come from; columns named like results are not read."""
    rows = [(1, 5, "user", "Hi.", "x"), (1, 5, "user", "Hi.", "y"), (1, 5, "assistant", "Yo.", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string")
    found = C.report(df).collect()
    assert len(found) == 1
    assert tuple(found[0])[1:] == brute([(5, "assistant", "Yo."), (5, "user", "Hi."), (5, "user", "Hi.")])


@pytest.mark.parametrize("text,cut", [("x" * 200_000 + ".", 0), ("y " * 100_000, 1)])
def test_long_text(spark, text, cut):
    rows = [(1, 0, "user", text, 1), (1, 1, "assistant", "Fine.", 1)]
    assert got(spark, rows) == expected(rows) and expected(rows)[0][4] == cut

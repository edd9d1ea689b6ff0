import hashlib

import numpy as np
import pyarrow as pa

from garimpo.llm import fingerprint as fp

WORDS = [f"w{i}" for i in range(400)]


def plain_report(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        new = text[: len(text) - third] + after[:third]
        own, mark, nxt = fp.sketches(pa.array([text, new, after]))
        out[doc_id] = (
            len(text), hashlib.sha256(new.encode()).hexdigest(), fp.written(own), fp.written(mark),
            fp.likeness(own, mark), fp.likeness(own, nxt),
        )
    return out


def test_report_equals_plain_python(documents):
    rows = [(i * 3, " ".join(WORDS[i : i + 5 + i % 40])) for i in range(150)] + [(1, None), (2, ""), (4, "é 💡 x"), (5, "one")]
    got = {r["doc_id"]: tuple(r)[1:] for r in fp.edit_report(documents(rows)).collect()}
    assert got == plain_report(rows)


def test_single_and_empty_table(documents):
    (row,) = fp.edit_report(documents([(7, "a b c d e f")])).collect()
    assert row["near_next"] == 1.0
    assert row["edited_sha256"] == hashlib.sha256(b"a b c d " + b"a b").hexdigest()
    assert fp.edit_report(documents([])).count() == 0


def test_repeated_and_null_ids(documents):
    rows = [(5, "a b c d e f g")] * 3 + [(None, "x y z"), (None, None), (9, "q")]
    got = fp.edit_report(documents(rows)).collect()
    assert len(got) == 6
    assert len({r["fingerprint"] for r in got if r["doc_id"] == 5}) == 1


def test_sketch_merges_and_estimates():
    one, other, both = fp.sketches(pa.array([" ".join(WORDS[:300]), " ".join(WORDS[150:]), "a b"]), scale=2)
    ones = fp.sketches(pa.array([" ".join(WORDS)]), scale=2)[0]
    merged = fp.merge(one, other, scale=2)
    assert np.isin(merged, ones).all()
    assert abs(fp.likeness(one, other) - 146 / 396) < 0.12
    assert abs(fp.containment(other, one) - 146 / 246) < 0.15
    assert len(both) == 1 and fp.read(fp.written(one)).tolist() == one.tolist()


def test_column_forms_agree(spark, documents):
    df = fp.fingerprints(documents([(1, "A b c d e f g h"), (2, "a b c d e f g h"), (3, None)]), scale=1)
    pairs = df.crossJoin(df.select("fingerprint").withColumnRenamed("fingerprint", "other")).select(
        "fingerprint", "other", fp.similar("fingerprint", "other").alias("s")
    )
    for r in pairs.collect():
        assert r["s"] == fp.likeness(fp.read(r["fingerprint"]), fp.read(r["other"]))

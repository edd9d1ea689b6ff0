import re

import pytest

from garimpo.llm import contamination as C

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = " ".join(f"q{i}" for i in range(20))


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items):
    own, hit, ids = words(text), set(), set()
    for item, t in items:
        w = words(t)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for j in range(len(own) - n + 1):
                if own[j : j + n] == w[i : i + n]:
                    hit |= set(range(j, j + n))
                    ids.add(str(item))
    return len(own), len(hit), sorted(ids)


DOCS = [
    (1, "before " + ITEM.upper().replace(" ", ", ") + "! after"), (2, None), (3, ""), (4, "short É item, twice short É item"),
    (5, "xshort É item"), (6, " ".join(f"q{i}" for i in range(12))), (7, "z " * 300 + " ".join(f"q{i}" for i in range(3, 17))),
    (1, "repeated id"), (8, "💡💡 Short É\nitem 💡"),
]
ITEMS = [(10, ITEM), (11, "short É item"), (12, None), (13, "?!"), (14, "Short É item."), (None, "z z"), (9, ITEM)]


@pytest.mark.parametrize("shard_chars", [C.SHARD_CHARS, 150])
def test_equals_brute_force(spark, documents, shard_chars):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = C.contaminated(documents(DOCS), items, shard_chars=shard_chars).collect()
    assert len(found) == len(DOCS)
    usable = [(i, t) for i, t in ITEMS if i is not None]
    for row in found:
        n, hit, ids = plain(row["text"], usable)
        assert (row["n_words"], row["n_hit"], row["items"]) == (n, hit, ids)
        assert row["contaminated"] == (hit > 0 and 20 * hit >= n)
        # Spans point into the original text.
        cut = [words(row["text"][s["begin"] : s["end"]]) for s in row["spans"]]
        assert sum(map(len, cut)) == hit


def test_no_items_and_clashing_columns(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents(DOCS).withColumnsRenamed({"lang": "n_hit", "source": "Contaminated"})
    kept = C.clean(docs, none)
    assert kept.columns == docs.columns and sorted(kept.collect(), key=str) == sorted(docs.collect(), key=str)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert {r["doc_id"] for r in C.clean(docs, items).collect()} == {1, 2, 3, 5, 6, 7}
    assert C.clean(documents([]), items).count() == 0

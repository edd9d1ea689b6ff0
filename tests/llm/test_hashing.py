import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from garimpo.llm import hashing as H

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\t\n 💡", max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 5))
def test_words_and_shingles_equal_plain_python(texts, size):
    words = H.Words(pa.array(texts, pa.string()), lower=True)
    plain = [(t or "").encode().lower().split() for t in texts]
    assert words.counts().tolist() == [len(p) for p in plain]
    spans = [bytes(words.data[a:b]).lower() for a, b in zip(words.starts, words.ends, strict=True)]
    assert spans == [w for p in plain for w in p]
    seen = {}
    for own, shingles in zip(plain, H.shingle_sets(words, size), strict=True):
        expected = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if len(own) >= size else {tuple(own)} - {()}
        assert len(expected) == len(shingles)
        for s in expected:
            seen.setdefault(s, set()).update(shingles.tolist())
    # Equal shingles have equal hashes wherever they stand.
    alone = {s: next(iter(H.shingle_sets(H.Words(pa.array([b" ".join(s).decode()]), lower=True), size))).tolist() for s in seen}
    assert all(set(h) <= seen[s] for s, h in alone.items())


def test_sliced_column_and_long_word():
    column = pa.array(["x y", None, "a b c", "w" * (H.PIECE + 5) + " a b c"])
    whole, part = H.Words(column, lower=False), H.Words(column.slice(2, 2), lower=False)
    assert part.counts().tolist() == [3, 4]
    assert part.hashes.tolist() == whole.hashes[2:].tolist()
    assert whole.hashes[2:5].tolist() == whole.hashes[6:9].tolist()


def test_grams_are_by_content():
    words = H.Words(pa.array(["a b c d a b c d e f g"]), lower=False).hashes
    for size in (1, 2, 3, 4):
        grams = H.grams(words, size)
        assert len(grams) == 12 - size and grams[0] == grams[4]
    assert len(H.grams(words, 12)) == 0


def test_slices_bound_the_text():
    batch = pa.RecordBatch.from_arrays([pa.array(["aa", None, "bbbb", "c" * 50, "d"])], names=["text"])
    parts = [p.column(0).to_pylist() for p in H.slices(iter([batch, batch.slice(0, 0)]), "text", 6)]
    assert parts == [["aa", None, "bbbb"], ["c" * 50], ["d"]]

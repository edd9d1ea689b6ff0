import hashlib
import random
from collections import Counter

import pytest

from garimpo.llm import substrings as S


def plain(rows, window):
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    seen = Counter(tuple(w[i : i + window]) for _, w in texts for i in range(len(w) - window + 1))
    out = []
    for doc_id, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), sum(gone), kept.decode(), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def mosaic(seed):
    """Random text, repetitive text, and passages cut from earlier texts."""
    rng = random.Random(seed)
    rows, texts = [], [[f"x{rng.randrange(40)}" for _ in range(90)]]
    for i in range(120):
        kind = rng.random()
        if kind < 0.2:
            own = [rng.choice("ab") for _ in range(rng.randrange(70))]
        elif kind < 0.35:
            own = ["abc"[j % rng.choice([1, 2, 3])] for j in range(rng.randrange(70))]
        elif kind < 0.45:
            part = [f"z{rng.randrange(40)}" for _ in range(rng.randrange(30, 60))]
            cut = rng.randrange(10)
            own = part + ["m", "n"][: rng.randrange(3)] + part + part[cut : cut + 45] + part[5:]
        else:
            base = rng.choice(texts)
            cut = rng.randrange(len(base) + 1)
            own = [f"x{rng.randrange(40)}" for _ in range(rng.randrange(20))] + base[cut : cut + rng.randrange(70)] + [f"y{rng.randrange(40)}" for _ in range(10)]
            texts.append(own)
        rows.append((rng.choice([i, i // 2, None]), " \n".join(own) if rng.random() < 0.9 else None))
    return rows


@pytest.mark.parametrize(("window", "gram"), [(35, 11), (35, 3), (20, 7), (10, 4), (5, 5), (2, 1), (1, 1)])
def test_equals_brute_force(documents, window, gram):
    rows = mosaic(window) + [(500, ""), (501, "é É é")]
    got = S.without_repeats(documents(rows), window=window, gram=gram).collect()
    assert Counter(map(tuple, got)) == plain(rows, window)


def test_empty_table_and_bad_sizes(documents):
    assert S.without_repeats(documents([])).count() == 0
    with pytest.raises(ValueError):
        S.without_repeats(documents([]), window=3, gram=4)

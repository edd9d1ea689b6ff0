"""Phrase mining against plain counting."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from garimpo.llm import phrases as P


def brute(rows, least, first):
    counts, total = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, 6):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        found = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < least:
                continue
            inside = any(
                f[longer] >= a and any(longer[i : i + len(phrase)] == phrase for i in range(len(longer) - len(phrase) + 1))
                for longer in f if len(longer) > len(phrase)
            )
            if inside:
                continue
            cuts = [(1000 * a * total[lang] // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "são", "paulo", "a", "b", "c", "x.y", "été", " ", "end!", "one,two"]
    rows = [(rng.choice(["en", "pt", "und", None]), rng.choice([" ", "  ", "\t", " \t"]).join(rng.choices(words, k=rng.randint(0, 40)))) for _ in range(n)]
    rows += [("en", "new york city hall is big"), ("en", "a a a a a a a a"), (None, None), ("pt", ""), ("pt", " .,\n"), ("en", "\x0bnew\x0cyork\r")] * 5
    rows += [("en", "new york city hall. " * 3_000)]
    return rows


@pytest.mark.parametrize("least,first", [(3, 25), (8, 2000)])
def test_collocations(spark, least, first):
    rows = texts(1, 120)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    found = P.collocations(df, least=least, first=first)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, least, first)


def test_small_containers_and_slices(spark, monkeypatch):
    """Runs burst, tasks spill often, prefixes are folded: the same result."""
    for name, value in {"HELD": 50, "BURST": 3, "SLICE": 200, "FOLD": 10, "BITS": 6}.items():
        monkeypatch.setattr(P, name, value)
    rows = texts(2, 60)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    assert sorted(tuple(r) for r in P.collocations(df, least=4).collect()) == brute(rows, 4, 2000)


def test_empty_table(spark):
    assert P.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert P.collocations(spark.createDataFrame([(None, None)], "lang string, text string")).collect() == []


def test_large_numbers_are_exact(spark):
    a, n, left, right = 10**9 + 7, 10**13 + 1, 10**10 + 3, 10**11 + 9
    found = spark.createDataFrame([("en", "x y", a), ("en", "x", left), ("en", "y", right)], "lang string, phrase string, f long")
    row = P.scored(found, spark.createDataFrame([("en", n)], "lang string, n long")).first()
    assert row.score == 1000 * a * n // (left * right)


def test_hashes_of_phrases_and_places_agree():
    trie = P.Trie(3, 5, {2: np.zeros(1 << (P.BITS - 3), np.uint8)}, 4)
    lang, words = trie.langs.of(pa.array(["en"])), trie.words.of(pa.array(["new", "york", "é"]))
    told = P.longer_hash(trie.langs.hashes[lang], trie.words.hashes[words[:1]])
    told = P.longer_hash(told, trie.words.hashes[words[1:2]])
    assert told.astype(np.int64)[0] == P.phrase_hash("en", "new york") != P.phrase_hash("en", "york new")
    assert trie.words.of(pa.array(["york", "x", "new"])).tolist() == [1, 3, 0] and len(trie.words.hashes) == 4


def test_pieces():
    words, rows, left = P.pieces(pa.array(["A b, c", None, "", "d\te.", " f"]))
    assert words.to_pylist() == ["a", "b", "c", "d", "e", "f"]
    assert rows.tolist() == [0, 0, 0, 3, 3, 4] and left.tolist() == [2, 1, 1, 2, 1, 1]

"""Phrase collocation mining: n-grams counted in tries of word ids, whose subtrees are spilled as sorted runs.

A-Z are lower-cased, texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those
into words ``[^\\x20\\x09]+``. Phrases of 2 to 5 words inside one piece are counted
with their overlaps, for each language by itself.

Counting is one scan for each of three lengths (words, pairs, longer phrases):

1. A task numbers the words it meets and makes a trie of the ids: the nodes of a level
   are (node above, word id) pairs in an Arrow hash table, which numbers and counts them.
2. Counted phrases are held in containers, one for each prefix: a hash of the language
   and of the first ``DEPTH`` words, so that a subtree is in one container.
3. After ``HELD`` phrases, and at the end, containers leave the task whole, as sorted and
   compressed runs; one that outgrew ``BURST`` phrases bursts into runs of neighbouring
   subtrees. Runs meet by prefix in the shuffle and are added up prefix after prefix, so
   a task holds the phrases of one prefix at a time.

All parts of a phrase are at least as frequent as the phrase, so each scan leaves out
phrases with a part that the scan before found too rare. Frequent parts are told by
``BITS`` bits, a table of fixed size at any corpus size; a part wrongly told frequent
costs a count and changes nothing.

A candidate is a phrase with ``a >= least``. Cut after ``k`` words it has
``floor(1000 * a * n / (l * r))`` (in 38 digits; n: all words of the language, l and r:
counts of the parts); its score is the least of them, of the smallest such ``k``.
Candidates inside a longer one with the same count are dropped: it is enough to look
at phrases of one word more, whose counts lie between the two.

Results for odd rows: null and blank texts have no words, a null language is ``und``,
repeated rows count again, texts of any length are counted whole (a text is one
slice), ties are ranked by count and by phrase. Empty tables give no rows. Other
columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from garimpo.llm import hashing
from garimpo.llm.frames import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONGEST = 5
LEAST = 100
FIRST = 2000
BITS = 25
HELD = 1 << 20  # phrases a task holds before it spills
BURST = 1 << 14  # phrases of a run
DEPTH = 3
SLICE = 8 << 20  # bytes of text a trie is made of
FOLD = 1 << 20  # phrases read of one prefix before equal ones are added up
_RUN = pa.schema([("prefix", pa.int32()), ("lang", pa.string()), ("phrases", pa.int64()), ("bytes", pa.int64()), ("run", pa.binary())])
_RUN_SQL = "prefix int, lang string, phrases bigint, bytes bigint, run binary"
_COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64()), ("h", pa.int64())])
_COUNTED_SQL = "lang string, phrase string, f bigint, h bigint"

U64 = np.uint64
_BLANK = np.isin(np.arange(256), [32, 9])
_BREAK = np.isin(np.arange(256), [*b".,;:!?", 10, 11, 12, 13])
_LOWER = np.arange(256, dtype=np.uint8) + 32 * ((np.arange(256) >= 65) & (np.arange(256) <= 90)).astype(np.uint8)


def pieces(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of a text column, the row of each, and how many words of its piece begin with it."""
    column = column.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
    data, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
    cut = _BREAK[data]
    solid = ~(_BLANK[data] | cut)
    starts, ends = solid.copy(), solid.copy()
    starts[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    edge = bounds[(bounds > 0) & (bounds < len(data))]
    starts[edge] = solid[edge]
    ends[edge - 1] = solid[edge - 1]
    at, to = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    offsets = np.concatenate([[0], np.cumsum(to - at)])
    kept = np.ascontiguousarray(_LOWER[data[solid]])
    words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(kept))
    rows = np.searchsorted(bounds, at, side="right") - 1
    cuts = np.concatenate([[0], np.cumsum(cut)])
    last = np.ones(len(at), dtype=bool)
    if len(at) > 1:
        last[:-1] = (cuts[at[1:]] > cuts[to[:-1]]) | (rows[1:] != rows[:-1])
    stop = np.flatnonzero(last)
    left = stop[np.searchsorted(stop, np.arange(len(at)))] - np.arange(len(at)) + 1 if len(at) else np.empty(0, np.int64)
    return words, rows, left


def text_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode())


def longer_hash(above: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from those of its first words and of its last; that of no words is its language's."""
    return hashing.mix(above * U64(hashing.WORD_BASE) + word)


def phrase_hash(lang: str, phrase: str) -> int:
    words = np.array([text_hash(w) for w in phrase.split(" ")], dtype=U64)
    told = np.array([text_hash(lang)], dtype=U64)
    for word in words:
        told = longer_hash(told, word)
    return int(told[0].astype(np.int64))


class Numbers:
    """Ids of the texts a task has met, in the order met, and their hashes."""

    def __init__(self) -> None:
        self.ids: dict[str, int] = {}
        self.hashes = np.empty(0, dtype=U64)

    def of(self, texts: pa.Array) -> np.ndarray:
        ids, known = self.ids, len(self.ids)
        out = np.fromiter((ids.setdefault(t, len(ids)) for t in texts.to_pylist()), dtype=np.int64, count=len(texts))
        fresh = list(ids)[known:] if len(ids) > known else []
        self.hashes = np.append(self.hashes, np.array([text_hash(t) for t in fresh], dtype=U64))
        return out

    def names(self) -> pa.Array:
        return pa.array(list(self.ids), pa.string())


class Trie:
    """Counts of the phrases of ``low`` to ``high`` words that a task has met.

    ``frequent`` has bits of the frequent phrases of some sizes below ``low``.
    """

    def __init__(self, low: int, high: int, frequent: dict[int, np.ndarray], prefixes: int):
        self.low, self.high, self.frequent, self.prefixes = low, high, frequent, prefixes
        self.clear()

    def clear(self) -> None:
        self.words, self.langs = Numbers(), Numbers()
        self.held: dict[int, list[pa.Table]] = {}
        self.size = 0

    def add(self, langs: pa.Array, texts: pa.Array) -> None:
        words, rows, left = pieces(texts)
        if not len(words):
            return
        lang, word = langs.fill_null("und").dictionary_encode(), words.dictionary_encode()
        of_lang = self.langs.of(lang.dictionary)[np.asarray(lang.indices)][rows]
        of_word = self.words.of(word.dictionary)[np.asarray(word.indices)]
        # Places where a phrase of ``low`` words may begin, and then those where a longer one may.
        usable, part = self._usable(of_lang, of_word, left)
        may = left >= self.low
        for i in range(self.low - part + 1):
            may[: len(may) - i] &= usable[i:]
        at = np.flatnonzero(may)
        wide = len(self.words.ids)
        keys, nodes, columns = None, of_lang[at], []
        for level in range(1, self.high + 1):
            if level > self.low:
                go = left[at] >= level
                go[go] = usable[at[go] + level - part]
                at, nodes = at[go], nodes[go]
            if not len(at):
                return
            node = pa.array(nodes * wide + of_word[at + level - 1]).dictionary_encode()
            nodes, keys = np.asarray(node.indices).astype(np.int64), np.asarray(node.dictionary)
            above = keys // wide
            columns = [c[above] for c in columns] or [above.astype(np.int32)]
            columns.append((keys % wide).astype(np.int32))
            if level >= self.low:
                names = ["lang", *(f"w{i}" for i in range(level))]
                self.held.setdefault(level, []).append(
                    pa.table({**dict(zip(names, columns, strict=True)), "f": np.bincount(nodes, minlength=len(keys))})
                )
                self.size += len(keys)

    def _usable(self, of_lang: np.ndarray, of_word: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, int]:
        """Places of phrases told frequent, of the greatest size that bits are given for, and that size."""
        if not self.frequent:
            return np.ones(len(of_word), dtype=bool), 1
        size = max(self.frequent)
        told, word = self.langs.hashes[of_lang], self.words.hashes[of_word]
        for i in range(size):
            told = longer_hash(told[: len(word) - i], word[i:])
        bit = (told & U64((1 << BITS) - 1)).astype(np.int64)
        good = np.zeros(len(of_word), dtype=bool)
        good[: len(bit)] = (self.frequent[size][bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
        return good & (left >= size), size

    def runs(self) -> Iterator[pa.RecordBatch]:
        """Whole containers as sorted runs; the trie is empty afterwards."""
        words, langs = self.words.names(), self.langs.names()
        for level, tables in sorted(self.held.items()):
            keys = ["lang", *(f"w{i}" for i in range(level))]
            table = added(tables, keys).combine_chunks()
            columns = [np.asarray(table[c]) for c in keys]
            told = self.langs.hashes[columns[0]]
            for column in columns[1 : DEPTH + 1]:
                told = longer_hash(told, self.words.hashes[column])
            prefix = (told % U64(self.prefixes)).astype(np.int32)
            order = np.lexsort((*reversed(columns[1:]), columns[0], prefix))
            parts = [words.take(pa.array(c[order])) for c in columns[1:]]
            text = pc.binary_join_element_wise(*parts, " ") if level > 1 else parts[0]
            yield from _packed(prefix[order], columns[0][order], langs, text, np.asarray(table["f"])[order].astype("<i8"))
        self.clear()


def added(tables: list[pa.Table], keys: list[str]) -> pa.Table:
    """Equal phrases added up."""
    one = pa.concat_tables(tables)
    return one.group_by(keys, use_threads=False).aggregate([("f", "sum")]).rename_columns([*keys, "f"])


def _packed(prefix: np.ndarray, lang: np.ndarray, langs: pa.Array, phrase: pa.Array, f: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted phrases as a compressed run for each prefix and language, ``BURST`` phrases at most."""
    change = (np.flatnonzero((prefix[1:] != prefix[:-1]) | (lang[1:] != lang[:-1])) + 1).tolist()
    begins = np.concatenate([np.arange(a, b, BURST) for a, b in zip([0, *change], [*change, len(prefix)], strict=True)])
    ends = np.append(begins[1:], len(prefix))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(begins, len(prefix)), pa.int32()), phrase), "\n")
    for some in range(0, len(begins), 4096):
        begin, end = begins[some : some + 4096], ends[some : some + 4096]
        raw = [f[a:b].tobytes() + joined[some + i].as_buffer().to_pybytes() for i, (a, b) in enumerate(zip(begin, end, strict=True))]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(prefix[begin], pa.int32()), langs.take(pa.array(lang[begin])), pa.array(end - begin, pa.int64()),
                pa.array([len(x) for x in raw], pa.int64()), pa.array([pa.compress(x, "zstd", asbytes=True) for x in raw], pa.binary()),
            ],
            schema=_RUN,
        )


def _count(low: int, high: int, frequent: dict, prefixes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(low, high, {size: np.frombuffer(table.value, np.uint8) for size, table in frequent.items()}, prefixes)
        for batch in hashing.slices(batches, "text", SLICE):
            trie.add(batch.column("lang").cast(pa.string()), batch.column("text"))
            if trie.size > HELD:
                yield from trie.runs()
        yield from trie.runs()

    return run


def _merge(least: int, totals: bool):
    """Adds up the runs of one prefix after another; the frequent phrases, and words in all with a null phrase."""

    def flushed(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        table = added(held, ["lang", "phrase"])
        kept = [table.filter(pc.greater_equal(table["f"], least))]
        if totals:
            every = added([table.select(["lang", "f"])], ["lang"])
            kept.append(every.append_column("phrase", pa.nulls(len(every), pa.string())))
        for part in kept:
            told = [None if p is None else phrase_hash(x, p) for x, p in zip(part["lang"].to_pylist(), part["phrase"].to_pylist(), strict=True)]
            part = part.append_column("h", pa.array(told, pa.int64()))
            yield from part.select(["lang", "phrase", "f", "h"]).cast(_COUNTED).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size, now = 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["prefix"] != now and held:
                    yield from flushed(held)
                    held, size = [], 0
                now = row["prefix"]
                raw = pa.decompress(row["run"], row["bytes"], "zstd", asbytes=True)
                n = row["phrases"]
                phrases = pc.split_pattern(pa.array([raw[8 * n :].decode()], pa.string()), "\n").flatten()
                held.append(pa.table({"lang": pa.array([row["lang"]] * n, pa.string()), "phrase": phrases, "f": np.frombuffer(raw, "<i8", n)}))
                size += n
                if size > FOLD and len(held) > 1:
                    held = [added(held, ["lang", "phrase"])]
                    size = len(held[0]) // 2  # so that folding is paid by what is read in between
        if held:
            yield from flushed(held)

    return run


def _counted(docs: DataFrame, low: int, high: int, frequent: dict, least: int) -> DataFrame:
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = docs.select("lang", "text").mapInArrow(_count(low, high, frequent, parts), _RUN_SQL)
    met = found.repartition(parts, "prefix").sortWithinPartitions("prefix")
    return stored(met.mapInArrow(_merge(least, low == 1), _COUNTED_SQL), "phrases")


def _bits(counted: DataFrame):
    """The bits of all phrases, at most ``2 ** BITS``, as a broadcast variable."""
    bit = F.col("h").bitwiseAND((1 << BITS) - 1)
    words = counted.where("phrase IS NOT NULL").select(
        F.shiftright(bit, 6).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int")).alias("bit")
    )
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (BITS - 6), dtype=np.int64)
    table[np.asarray(rows["word"])] = np.asarray(rows["bits"])
    return counted.sparkSession.sparkContext.broadcast(table.astype("<i8").tobytes())


def counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, f)`` of phrases with ``f >= least``, and ``(lang, n)``: all words of each language."""
    words = _counted(docs, 1, 1, {}, least)
    totals = words.where("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    found, frequent = [words.where("phrase IS NOT NULL")], {}
    for low, high in ((2, 2), (3, longest)):
        if low > longest:
            break
        frequent[low - 1] = _bits(found[-1])
        found.append(_counted(docs, low, high, frequent, least))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.drop("h"), totals


def scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, n, score)`` of all candidates, by their lowest cut."""
    word = F.split("phrase", " ")
    whole = found.where("instr(phrase, ' ') > 0").select("lang", "phrase", F.col("f").alias("a"), word.alias("w"))
    cuts = whole.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("tail"),
    )
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    cuts = cuts.join(totals, "lang")
    exact = {c: F.col(c).cast("decimal(18,0)").cast("decimal(38,0)") for c in "alrn"}
    # All numbers are whole and below 10^38; a quotient of whole numbers is its whole part.
    cuts = cuts.withColumn("above", F.lit(1000).cast("decimal(38,0)") * exact["a"] * exact["n"]).withColumn("below", exact["l"] * exact["r"])
    cuts = cuts.withColumn("score", F.expr("above div below"))
    least = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a", "n").agg(least).select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )


def contained(found: DataFrame) -> DataFrame:
    """``(lang, phrase, f)``: parts of phrases one word longer, with the longer one's count."""
    longer = found.where("instr(phrase, ' ') > 0")
    less = F.array(F.expr("left(phrase, length(phrase) - instr(reverse(phrase), ' '))"), F.expr("substr(phrase, instr(phrase, ' ') + 1)"))
    return longer.select("lang", F.explode(less).alias("phrase"), F.col("f").alias("a")).distinct()


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST, longest: int = LONGEST) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``first`` phrases of each language of ``(lang, text)`` rows."""
    found, totals = counts(docs, least, longest)
    kept = scored(found, totals).join(contained(found), ["lang", "phrase", "a"], "left_anti")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_UPPER, _LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = rf"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p
  FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWERED}') AS t FROM documents)
),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
counted AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, range(1, {LONGEST + 1}) s(m) WHERE len(w) >= m)
  GROUP BY ALL HAVING count(*) >= {LEAST}
),
cuts AS (
  SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS w
  FROM (SELECT *, unnest(range(1, m)) AS k FROM counted WHERE m > 1)
),
scores AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, t.n,
    (CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM cuts c JOIN total t ON t.lang = c.lang
  JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')
),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM scores),
kept AS (
  SELECT * FROM lowest x WHERE cut = 1 AND NOT EXISTS (
    SELECT 1 FROM counted y WHERE y.lang = x.lang AND len(y.phrase) > len(x.phrase)
    AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ') AND 100 * y.f >= 100 * x.a)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= {FIRST}
"""

"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

A text is normalised by lower-casing A-Z and keeping words
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, joined by single spaces. A window is 13
consecutive words of an item, or a whole shorter item. The automaton holds every
distinct window once; a text is scanned once, and the end of each hit is mapped
back to word numbers and to code points of the original.

* null texts have no words: no hits, ``contaminated`` false, no spans;
* items without words or with a null id never match; items of equal text all
  count; an item id that occurs twice counts once;
* repeated document rows each get their own result row; other columns pass through.

The automaton is broadcast only while the items' texts together have at most
``SHARD_CHARS`` characters, which is measured first. Larger item tables are
split by item id into as many automata as needed, one scan each, and the hits of
a row are united, so no item is left out and no task holds more than one shard.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm import hashing
from garimpo.llm.frames import set_aside, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 13
SHARD_CHARS = 16_000_000
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_AUTOMATA: dict[str, ahocorasick.Automaton] = {}


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def window_table(items: list[tuple[str, str]], size: int = WINDOW) -> dict[str, tuple[int, set[str]]]:
    """Each distinct window, as padded Latin-1 text, with its number of words and its item ids."""
    table: dict[str, tuple[int, set[str]]] = {}
    for item, text in items:
        words = normal_words(text)
        width = min(size, len(words))
        for i in range(len(words) - width + 1 if width else 0):
            # Bytes read as Latin-1 keep one character per byte; the spaces around pin word borders.
            key = b" %s " % b" ".join(words[i : i + width])
            table.setdefault(key.decode("latin-1"), (width, set()))[1].add(item)
    return table


def automaton(items: list[tuple[str, str]], size: int = WINDOW) -> ahocorasick.Automaton:
    """Values are (words, item ids); one instance per worker process and item list."""
    key = hashlib.sha256(repr((size, items)).encode("utf-8", "surrogatepass")).hexdigest()
    if key not in _AUTOMATA:
        built = ahocorasick.Automaton()
        for window, value in window_table(items, size).items():
            built.add_word(window, value)
        built.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[key] = built
    return _AUTOMATA[key]


def scan(text: str | None, machine: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, merged ranges [from, to) of words hit, and the items found."""
    words = normal_words(text)
    if not words or not len(machine):
        return len(words), [], set()
    joined = b" %s " % b" ".join(words)
    found = list(machine.iter(joined.decode("latin-1")))
    if not found:
        return len(words), [], set()
    # The hit's last space is the one behind its last word: its rank among spaces is the word's number.
    spaces = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    lasts = np.searchsorted(spaces, [end for end, _ in found])
    ranges: list[tuple[int, int]] = []
    for last, (_, (width, _)) in sorted(zip(lasts.tolist(), found, strict=True), key=lambda x: x[0] - x[1][1][0]):
        begin = last - width
        if ranges and begin <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], max(ranges[-1][1], last))
        else:
            ranges.append((begin, last))
    return len(words), ranges, set().union(*(ids for _, (_, ids) in found))


def word_spans(text: str) -> list[tuple[int, int]]:
    """Code point spans of the normalised words in the original text."""
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw.translate(_FOLD), dtype=np.uint8)
    solid = np.concatenate([[False], data != 32, [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    # Bytes that continue a character add no code point.
    heads = np.concatenate([[0], np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)])
    points = heads[edges]
    return list(zip(points[::2].tolist(), points[1::2].tolist(), strict=True))


RESULT = [
    ("n_words", pa.int64()),
    ("n_hit", pa.int64()),
    ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
    ("word_ranges", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
]
RESULT_SQL = (
    "n_words bigint, n_hit bigint, items array<string>, "
    "spans array<struct<begin:bigint,end:bigint>>, word_ranges array<struct<begin:bigint,end:bigint>>"
)


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def _scanner(text: str, items, size: int, kept: list[str], earlier: bool):
    """Scan batches; ``earlier`` rows carry the hits of shards scanned before."""

    def result(row: str | None, before: dict | None, machine) -> tuple:
        n, ranges, ids = scan(row, machine)
        if before:
            ranges = merge(ranges + [(r["begin"], r["end"]) for r in before["word_ranges"]])
            ids = ids | set(before["items"])
        points = word_spans(row) if ranges else []
        return (
            n,
            sum(end - begin for begin, end in ranges),
            sorted(ids),
            [{"begin": points[b][0], "end": points[e - 1][1]} for b, e in ranges],
            [{"begin": b, "end": e} for b, e in ranges],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(items.value, size)
        for batch in hashing.slices(batches, text):
            column = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            before = [None] * batch.num_rows
            if earlier:
                pairs = zip(column["word_ranges"].to_pylist(), column["items"].to_pylist(), strict=True)
                before = [{"word_ranges": r, "items": i} for r, i in pairs]
            rows = [result(t, b, machine) for t, b in zip(column[text].to_pylist(), before, strict=True)]
            made = [pa.array([r[i] for r in rows], type=t) for i, (_, t) in enumerate(RESULT)]
            yield pa.RecordBatch.from_arrays([*(column[n] for n in kept), *made], names=[*kept, *(n for n, _ in RESULT)])

    return run


def scan_table(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    size: int = WINDOW, shard_chars: int = SHARD_CHARS, keep_text: bool = True,
) -> DataFrame:
    """``docs`` with the columns of ``RESULT``; columns of those names are replaced.

    ``items`` are the sorted ids (as strings) of items with occurring windows,
    ``spans`` the hit passages as code points of the original text (end exclusive),
    ``word_ranges`` the same in words. Without ``keep_text`` the text stays behind.
    """
    spark = docs.sparkSession
    found = docs.drop(*(n for n, _ in RESULT))
    wanted = benchmark.select(F.col(item).cast("string").alias("i"), F.col(item_text).alias("t")).dropna()
    chars = wanted.agg(F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-chars // shard_chars))
    fields = list(found.schema)
    for shard in range(shards):
        part = wanted if shards == 1 else wanted.where(F.pmod(F.xxhash64("i"), F.lit(shards)) == shard)
        items = spark.sparkContext.broadcast(sorted((r["i"], r["t"]) for r in part.toLocalIterator()))
        last = shard == shards - 1
        kept = [f for f in fields if keep_text or not last or f.name != text]
        schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [RESULT_SQL])
        found = found.mapInArrow(_scanner(text, items, size, [f.name for f in kept], shard > 0), schema)
        if not last:
            found = stored(found, "shard")
    return found


def is_contaminated() -> F.Column:
    """At least one word hit, and at least one in twenty."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` with the scan's columns, ``n_items`` and ``contaminated``."""
    found = scan_table(docs, benchmark, **options)
    return found.withColumn("n_items", F.size("items").cast("long")).withColumn("contaminated", is_contaminated())


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the columns of ``docs``."""
    inner, back = set_aside(docs, [*(n for n, _ in RESULT), "n_items", "contaminated"], [text])
    found = contaminated(inner, benchmark, text=text, **options)
    return back(found.where(~F.col("contaminated")))

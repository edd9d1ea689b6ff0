"""Substring dedup by relative factoring: texts are factored against indexed blocks of all texts.

A window is ``window`` consecutive words ``[^\\x20\\x09-\\x0D]+`` of one text; a
word goes if a window covering it has the same word sequence as a window that
starts anywhere else, in another text or the same. Windows are judged on the
input. The parse is exact and no window is compared with every other:

1. Index. Every window is named by the smallest hash of its ``GRAM``-word runs,
   which depends on its words alone. Consecutive windows of one name form a block
   (about one block for 13 words); equal windows lie in blocks of equal name. The
   index holds a row a block: its name and the hash of all its words.
2. Factors. A name found once has no equal window anywhere. Blocks with equal
   words, two or more, are whole factors: each of their words is covered.
   Adjoining factors make one long span, read off without looking at words again.
3. Boundaries. A block whose words are found once, though not its name, is where a
   shared passage begins or ends. Only its windows are hashed and counted, against
   those of one block of each kind that has the name. Where all blocks of a name
   lie in one text (repetitive text), the windows are counted in that text.

Windows are told apart by two 64-bit hashes (name and words). Null and blank
texts have no words; texts shorter than a window lose nothing. Rows repeated or
with equal ids are separate occurrences, and each gets a result row.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm import hashing
from garimpo.llm.frames import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 35
GRAM = 11
BROADCAST_ROWS = 500_000  # of ids to fetch; two numbers a row

_BLOCK = pa.schema(
    [
        ("doc_id", pa.int64()), ("tid", pa.int64()), ("name", pa.int64()), ("body", pa.int64()),
        ("low", pa.int32()), ("high", pa.int32()), ("recurs", pa.int32()),
    ]
)
_BLOCK_SQL = "doc_id bigint, tid bigint, name bigint, body bigint, low int, high int, recurs int"


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[: len(x) - done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :])


def blocks(words: np.ndarray, first: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Row, name, body hash, first and last window start (as words of the row), and whether word runs recur.

    ``words`` are the word hashes of all rows, row ``i`` from ``first[i]`` to ``first[i + 1]``.
    """
    counts = np.diff(first)
    usable = np.maximum(counts - window + 1, 0)
    row = np.repeat(np.arange(len(counts)), usable)
    if not len(row):
        return tuple(np.empty(0, dtype=t) for t in (np.int64, hashing.U64, hashing.U64, np.int64, np.int64, bool))
    # Window starts of all rows; runs of words over a row's end belong to no start.
    start = np.arange(len(row)) - np.repeat(np.cumsum(usable) - usable, usable) + first[row]
    grams = hashing.grams(words, gram)
    span = window - gram + 1
    names = sliding_min(grams, span)[start]
    new = np.concatenate([[True], (names[1:] != names[:-1]) | (row[1:] != row[:-1])])
    at = np.flatnonzero(new)
    low, high = start[at], start[np.append(at[1:], len(start)) - 1]
    # Equal windows of one block, or neighbours in it, bring back a run within ``span`` words.
    again = np.zeros(len(grams) + 1, dtype=bool)
    for gap in range(1, min(span, len(grams) - 1) + 1):
        again[gap + 1 :] |= grams[gap:] == grams[:-gap]
    total = np.cumsum(again)
    recurs = total[high + span] > total[low]
    # Word hashes at consecutive powers; a block's hash is a difference of sums brought back to power zero.
    sums = np.zeros(len(words) + 1, dtype=hashing.U64)
    np.cumsum(words * _powers(len(words))[: len(words)], out=sums[1:])
    body = (sums[high + window] - sums[low]) * _powers(len(words), inverse=True)[low]
    body = hashing.mix(body + (high - low).astype(hashing.U64))
    rows = row[at]
    return rows, names[at], body, low - first[rows], high - first[rows], recurs


_POWERS: dict[bool, np.ndarray] = {}


def _powers(n: int, inverse: bool = False) -> np.ndarray:
    if len(_POWERS.get(inverse, ())) < n:
        base = pow(hashing.WORD_BASE, -1, 1 << 64) if inverse else hashing.WORD_BASE
        _POWERS[inverse] = hashing.powers(base, max(n, 1 << 16))
    return _POWERS[inverse]


def _index(window: int, gram: int, with_row: bool = False):
    """A row for each block; ``with_row`` gives only what tells how often and in how many rows a name occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in hashing.slices(batches, "text"):
            column = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            words = hashing.Words(column["text"], lower=False)
            row, name, body, low, high, recurs = blocks(words.hashes, words.first, window, gram)
            at = pa.array(row)
            if with_row:
                parts = [pa.array(hashing.signed(name)), pa.array(recurs.astype(np.int32)), column["row"].take(at)]
                yield pa.RecordBatch.from_arrays(parts, names=["name", "recurs", "row"])
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    column["doc_id"].take(at), column["tid"].take(at),
                    pa.array(hashing.signed(name)), pa.array(hashing.signed(body)),
                    pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)), pa.array(recurs.astype(np.int32)),
                ],
                schema=_BLOCK,
            )

    return run


_PARSED = pa.schema(
    [
        ("doc_id", pa.int64()), ("tid", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
        ("kept", pa.string()), ("kept_sha256", pa.string()), ("text", pa.string()), ("covered", pa.list_(pa.int32())),
        ("starts", pa.list_(pa.int32())), ("weights", pa.list_(pa.int32())),
        ("names", pa.list_(pa.int64())), ("windows", pa.list_(pa.int64())),
    ]
)
_PARSED_SQL = (
    "doc_id bigint, tid bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string, text string, "
    "covered array<int>, starts array<int>, weights array<int>, names array<bigint>, windows array<bigint>"
)


def cover(n: int, lows: list[int], ends: list[int]) -> np.ndarray:
    """Which of ``n`` words lie in a span [low, end)."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, lows, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(text: str, lows: list[int], ends: list[int], whole: bool) -> tuple[int, int, str | None, str]:
    """Words, words removed, the kept text (if asked for) and its digest."""
    words = text.encode("utf-8", "surrogatepass").split()
    gone = cover(len(words), lows, ends) if lows else None
    kept = b" ".join(words if gone is None else [w for w, g in zip(words, gone.tolist(), strict=True) if not g])
    removed = 0 if gone is None else int(gone.sum())
    return len(words), removed, kept.decode("utf-8", "surrogatepass") if whole else None, hashlib.sha256(kept).hexdigest()


def _starts(spans: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """The window starts of blocks, and the name of each."""
    starts = [np.arange(s["low"], s["high"] + 1, dtype=np.int32) for s in spans]
    names = [np.full(s["high"] - s["low"] + 1, s["name"], dtype=np.int64) for s in spans]
    return np.concatenate([*starts, np.empty(0, np.int32)]), np.concatenate([*names, np.empty(0, np.int64)])


def _parse(window: int, whole: bool):
    """Finish texts whose factors are all known; list the windows at factor boundaries."""

    def one(doc_id, tid, text, spans, hashes) -> tuple:
        sure = [s for s in spans if s["kind"] in ("factor", "sample")]
        lows, ends = [s["low"] for s in sure], [s["high"] + window for s in sure]
        if len(sure) < len(spans) or any(s["kind"] == "sample" for s in sure):
            every = hashing.signed(hashing.grams(hashes, window))
        inner = {s["name"] for s in spans if s["kind"] == "inner"}
        own, names = _starts([s for s in spans if s["name"] in inner])
        if len(own):
            pairs = np.stack([names, every[own]])
            _, back, counts = np.unique(pairs, axis=1, return_inverse=True, return_counts=True)
            twice = own[counts[back.reshape(-1)] > 1].tolist()
            lows, ends = lows + twice, ends + [s + window for s in twice]
        asked, asked_names = _starts([s for s in spans if s["kind"] == "open"])
        shown, shown_names = _starts([s for s in spans if s["kind"] == "sample"])
        listed = [None] * 4
        if len(asked) or len(shown):
            at = np.concatenate([asked, shown])
            listed = [
                # A sample stands for two or more equal blocks, and asks nothing for itself.
                np.concatenate([asked, np.full(len(shown), -1, dtype=np.int32)]),
                np.concatenate([np.ones(len(asked), dtype=np.int32), np.full(len(shown), 2, dtype=np.int32)]),
                np.concatenate([asked_names, shown_names]), every[at],
            ]
        if len(asked):
            flat = [x for pair in zip(lows, ends, strict=True) for x in pair]
            return (doc_id, tid, None, None, None, None, text, flat, *listed)
        return (doc_id, tid, *_cut(text, lows, ends, whole), None, None, *listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in hashing.slices(batches, "text"):
            column = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            words = hashing.Words(column["text"], lower=False)
            lists = (column[n].to_pylist() for n in ("doc_id", "tid", "text", "spans"))
            rows = [
                one(doc_id, tid, text, spans or [], words.hashes[words.first[i] : words.first[i + 1]])
                for i, (doc_id, tid, text, spans) in enumerate(zip(*lists, strict=True))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(_PARSED)], schema=_PARSED
            )

    return run


def _finish(window: int, whole: bool):
    names = ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in hashing.slices(batches, "text"):
            column = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            rows = []
            for doc_id, text, flat, found in zip(
                *(column[n].to_pylist() for n in ("doc_id", "text", "covered", "found")), strict=True
            ):
                lows, ends = flat[::2] + (found or []), flat[1::2] + [s + window for s in found or []]
                rows.append((doc_id, *_cut(text, lows, ends, whole)))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=t) for i, t in enumerate(types)], names=names)

    return run


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, whole: bool = True
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept, kept_sha256)`` for every row.

    ``kept`` holds the words that stay, joined by one space (null without
    ``whole``), ``kept_sha256`` is its lowercase hex digest.
    """
    if not 1 <= gram <= window:
        raise ValueError("gram must lie between 1 and window")
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).select("doc_id", F.xxhash64("text").alias("tid"), "text")
    index = source.mapInArrow(_index(window, gram), _BLOCK_SQL)
    # Numbers of rows, only to tell whether a name has more than one row; they pack well.
    row = F.col("row")
    numbered = source.withColumn("row", F.monotonically_increasing_id())
    # Combined before the shuffle, so a passage of many texts is a few rows.
    found = (
        numbered.mapInArrow(_index(window, gram, with_row=True), "name bigint, recurs int, row bigint").groupBy("name")
        .agg(F.count("*").alias("c"), F.max("recurs").alias("recurs"), F.min(row).alias("r1"), F.max(row).alias("r2"))
        .where("c > 1 OR recurs > 0")
        .select("name", (F.col("r1") == F.col("r2")).alias("inside"))
    )
    hits = stored(index.drop("recurs").join(found, "name"), "blocks")
    first = F.min(F.struct("doc_id", "tid", "low")).alias("first")
    kinds = hits.groupBy("name", "body", "inside").agg(F.count("*").alias("n"), first)
    unclear = kinds.where("n = 1 AND NOT inside").select("name").distinct().withColumn("unclear", F.lit(True))
    kinds = kinds.join(unclear, "name", "left").drop("inside")
    here = F.struct("doc_id", "tid", "low").eqNullSafe(F.col("first"))
    kind = (
        F.when((F.col("n") > 1) & F.col("unclear") & here, "sample").when(F.col("n") > 1, "factor")
        .when(F.col("inside"), "inner").otherwise("open")
    )
    marked = hits.join(kinds, ["name", "body"]).select("doc_id", "tid", F.struct("low", "high", "name", kind.alias("kind")).alias("span"))
    spans = marked.groupBy("doc_id", "tid").agg(F.collect_set("span").alias("spans"))
    spans = stored(spans, "spans")
    same = F.col("s.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("s.tid") == F.col("f.tid"))
    texts, found = source.alias("s"), spans.alias("f")
    columns = ["s.doc_id", "s.tid", "s.text", "f.spans"]
    if spans.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        # Ids of a counted, bounded number tell which texts have spans; only those move.
        ids = F.broadcast(spans.select("doc_id", "tid")).alias("f")
        plain = texts.join(ids, same, "left_anti").withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
        joined = texts.join(ids, same, "left_semi").alias("s").join(found, same).select(*columns).unionByName(plain)
    else:
        joined = texts.join(found, same, "left").select(*columns)
    parsed = stored(joined.mapInArrow(_parse(window, whole), _PARSED_SQL), "parsed")

    result = ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"]
    done = parsed.where("text IS NULL").select(*result)
    unsure = parsed.where("text IS NOT NULL")
    zipped = F.arrays_zip("starts", "weights", "names", "windows")
    listed = parsed.where("starts IS NOT NULL").select("doc_id", "tid", F.inline(zipped))
    # Written, so that the join below deals its rows anew and a window of many texts can be split.
    again = stored(listed.groupBy("names", "windows").agg(F.sum("weights").alias("n")).where("n > 1").drop("n"), "again")
    asked = listed.where("starts >= 0").drop("weights").join(again, ["names", "windows"])
    starts = asked.groupBy("doc_id", "tid").agg(F.collect_set("starts").alias("found"))
    same = F.col("u.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("u.tid") == F.col("f.tid"))
    rest = unsure.alias("u").join(starts.alias("f"), same, "left").select("u.doc_id", "u.text", "u.covered", "f.found")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string"
    return done.unionByName(rest.mapInArrow(_finish(window, whole), schema))

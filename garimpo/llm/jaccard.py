"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

A text's set holds its distinct n-word shingles (``hashing``; A-Z lower-cased;
fewer words than ``size`` are one shingle). Two texts link when
``100 * |intersection| >= percent * |union|``; the result is each document's
component under these links.

How links are found without emitting all pairs of a group:

1. Equal sets are one node, so exact copies cost one row each.
2. Shingles are ordered rare first. Rarity comes from document counts of all
   texts, kept in ``COUNTERS`` hashed counters; that table has a fixed size, so
   it may be broadcast at any corpus size. Ties go by hash. Any common order
   gives right results, a rare-first one gives few candidates.
3. Linked sets share a shingle of their prefixes, the first
   ``n - ceil(percent / 100 * n) + 1``. Prefix shingles are joined; those of one
   node only are dropped by an aggregate before.
4. Under each prefix shingle, only the node that has it earliest (nearest to
   what the group has in common) is paired with the others. A pair has to pass
   the length filter and a suffix filter (a bound on the overlap from how many
   shingles of each set fall into each of ``RANGES`` hash ranges), and is then
   verified once on the texts themselves.
5. Pairs left are those under a common prefix shingle whose nodes are still in
   different components. They pass the length, positional and suffix filters, are
   verified, and complete the components. Only nodes outside the shingle's
   largest component are paired, since inside one there is nothing left to link.

Sets are compared by 64-bit shingle hashes, nodes are known by a 64-bit hash of
their set. Null and blank texts have an empty set, size 0, and are linked with
nothing: their component is their own id. Rows repeated, or with equal ids, each
get a result row; null ids are kept and never name a component with other ids.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm import hashing
from garimpo.llm.components import components
from garimpo.llm.frames import set_aside, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COUNTER_BITS = 20
COUNTERS = 1 << COUNTER_BITS
BLOCK = 4096
RANGES = 64
BROADCAST_ROWS = 500_000  # of ids to fetch; three numbers a row
SHINGLE = 5
PERCENT = 80

_SETS = pa.schema(
    [
        ("doc_id", pa.int64()), ("tid", pa.int64()), ("n", pa.int64()), ("node", pa.int64()),
        ("ranges", pa.list_(pa.int32())), ("block", pa.int32()), ("counts", pa.binary()),
    ]
)
_SETS_SQL = "doc_id bigint, tid bigint, n bigint, node bigint, ranges array<int>, block int, counts binary"
_PREFIX = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])


def node_id(shingles: np.ndarray) -> int:
    """A hash of the set: sums of element hashes do not depend on order."""
    if not len(shingles):
        return 0
    total = hashing.mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(hashing.mix(np.array([total]))[0].astype(np.int64))


def counter_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def range_counts(shingles: np.ndarray) -> np.ndarray:
    return np.bincount((shingles & np.uint64(RANGES - 1)).astype(np.int64), minlength=RANGES)


def least_common(n: int, percent: int) -> int:
    """Shingles a set of ``n`` has to share with any set it links with."""
    return -(-percent * n // 100)


def rare_first(shingles: np.ndarray, levels: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` rarest shingles in the common order."""
    key = (levels[counter_of(shingles)].astype(np.uint64) << np.uint64(56)) | (shingles >> np.uint64(8))
    at = np.argpartition(key, most - 1)[:most] if most < len(key) else np.arange(len(key))
    return shingles[at[np.argsort(key[at], kind="stable")]]


def _scan_sets(size: int):
    """One row a text, and at the end of each task its counters as compressed blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.int64)
        for batch in hashing.slices(batches, "text"):
            column = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            sets = list(hashing.shingle_sets(hashing.Words(column["text"], lower=True), size))
            counts += np.bincount(counter_of(np.concatenate(sets)), minlength=COUNTERS)
            yield pa.RecordBatch.from_arrays(
                [
                    column["doc_id"],
                    column["tid"],
                    pa.array([len(s) for s in sets], type=pa.int64()),
                    pa.array([node_id(s) for s in sets], type=pa.int64()),
                    pa.array([range_counts(s).tolist() for s in sets], type=pa.list_(pa.int32())),
                    pa.nulls(len(sets), pa.int32()),
                    pa.nulls(len(sets), pa.binary()),
                ],
                schema=_SETS,
            )
        blocks = counts.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        packed = [zlib.compress(blocks[b].tobytes(), 1) for b in used]
        nothing = [pa.nulls(len(used), f.type) for f in _SETS][:5]
        yield pa.RecordBatch.from_arrays(
            [*nothing, pa.array(used, type=pa.int32()), pa.array(packed, type=pa.binary())], schema=_SETS
        )

    return run


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum counter blocks; a task holds at most one array for each block it was dealt."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(zlib.decompress(packed), dtype=np.int64)
            sums[block] = sums[block] + part if block in sums else part
    # An eighth of a binary power is as fine as the order needs to be.
    levels = [np.minimum(255, 8 * np.log2(s + 1)).astype(np.uint8).tobytes() for s in sums.values()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), type=pa.int32()), pa.array(levels, type=pa.binary())], names=["block", "levels"]
    )


def _levels(found: DataFrame) -> np.ndarray:
    """The rarity level of every counter: ``COUNTERS`` bytes, whatever the corpus."""
    spark = found.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = found.where("block IS NOT NULL").select("block", "counts").repartition(partitions, "block")
    out = np.zeros((COUNTERS // BLOCK, BLOCK), dtype=np.uint8)
    for row in blocks.mapInArrow(_add_blocks, "block int, levels binary").toLocalIterator():
        out[row["block"]] = np.frombuffer(row["levels"], dtype=np.uint8)
    return out.reshape(-1)


def _scan_prefixes(size: int, percent: int, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in hashing.slices(batches, "text"):
            column = batch.column(batch.schema.get_field_index("text"))
            tokens, nodes, sizes, places = [], [], [], []
            for shingles in hashing.shingle_sets(hashing.Words(column, lower=True), size):
                n = len(shingles)
                node = node_id(shingles)
                if not n or node in seen:
                    continue
                seen.add(node)
                prefix = rare_first(shingles, levels.value, n - least_common(n, percent) + 1)
                tokens.append(prefix)
                nodes.append(np.full(len(prefix), node, dtype=np.int64))
                sizes.append(np.full(len(prefix), n, dtype=np.int32))
                places.append(np.arange(len(prefix), dtype=np.int32))
            if tokens:
                parts = [hashing.signed(np.concatenate(tokens)), *map(np.concatenate, (nodes, sizes, places))]
                yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], schema=_PREFIX)

    return run


def _verify(size: int, percent: int):
    """Keep the pairs whose texts link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, np.ndarray] | None = None
        for batch in hashing.slices(batches, "text_a"):
            column = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            ones = hashing.shingle_sets(hashing.Words(column["text_a"], lower=True), size)
            others = hashing.shingle_sets(hashing.Words(column["text_b"], lower=True), size)
            linked = []
            for one, other in zip(ones, others, strict=True):
                both = len(np.intersect1d(one, other, assume_unique=True))
                linked.append(bool(both) and 100 * both >= percent * (len(one) + len(other) - both))
            keep = pa.array(linked, type=pa.bool_())
            yield pa.RecordBatch.from_arrays([column["a"].filter(keep), column["b"].filter(keep)], names=["a", "b"])

    return run


def _overlap_filter(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Length and suffix filters on pairs ``(a, b)`` of node ids."""
    side = nodes.select(F.col("node"), "n", "ranges")
    both = pairs.join(side.toDF("a", "n_a", "ranges_a"), "a").join(side.toDF("b", "n_b", "ranges_b"), "b")
    # What the ranges cannot share is not in the intersection.
    shared = F.aggregate(F.zip_with("ranges_a", "ranges_b", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    enough = 100 * shared >= percent * (F.col("n_a") + F.col("n_b") - shared)
    long_enough = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return both.where(long_enough).where(enough).select("a", "b")


def _linked(pairs: DataFrame, nodes: DataFrame, source: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose texts link. Only texts in some pair leave the scan."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stored(nodes.join(ends, "node").select("node", "one.doc_id", "one.tid"), "wanted")
    same = F.col("w.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("w.tid") == F.col("s.tid"))
    found = source.alias("s").join(_handed(wanted).alias("w"), same)
    texts = stored(found.select("node", F.col("s.text").alias("text")).dropDuplicates(["node"]), "texts")
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify(size, percent), "a bigint, b bigint")


def _ordered(one: str, other: str) -> list[F.Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def linked_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, tid)`` for every row; ``tid`` is Spark's ``xxhash64`` of the text."""
    spark = docs.sparkSession
    # The text's hash goes along with the id, so rows of equal ids but other texts are told apart.
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).select("doc_id", F.xxhash64("text").alias("tid"), "text")
    found = stored(source.mapInArrow(_scan_sets(size), _SETS_SQL), "sets")
    rows = found.where("block IS NULL")
    levels = spark.sparkContext.broadcast(_levels(found))
    schema = "token bigint, node bigint, n int, pos int"
    prefixes = source.select("text").mapInArrow(_scan_prefixes(size, percent, levels), schema)
    shared = prefixes.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    post = stored(prefixes.join(shared.select("token"), "token").distinct(), "prefixes")

    members = post.select("node").distinct()
    nodes = stored(
        rows.groupBy("node", "n").agg(F.min(F.struct("doc_id", "tid")).alias("one"), F.first("ranges").alias("ranges"))
        .join(members, "node"), "nodes",
    )
    # The earliest place of a token marks the node with the fewest rarer shingles.
    pivots = post.groupBy("token").agg(F.min(F.struct("pos", "node")).alias("first")).select("token", "first.node")
    near = post.join(pivots.withColumnRenamed("node", "pivot"), "token").where("node <> pivot")
    tested = stored(_overlap_filter(near.select(*_ordered("node", "pivot")).distinct(), nodes, percent), "pairs")
    edges = stored(_linked(tested, nodes, source, size, percent), "links")

    labels = components(edges).toDF("node", "label")
    labelled = stored(
        post.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled"
    )
    sizes = labelled.groupBy("token", "label").agg(F.count("*").alias("c"))
    major = sizes.groupBy("token").agg(F.max(F.struct("c", "label")).alias("top"), F.count("*").alias("k"))
    split = labelled.join(major.where("k > 1").select("token", F.col("top.label").alias("major")), "token")
    one, other = split.where("label <> major").alias("x"), split.alias("y")
    need = F.ceil((F.col("x.n") + F.col("y.n")) * percent / (100 + percent))
    fits = (
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.label") != F.col("y.label"))
        & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
        # Positional filter: what can still be shared from this token on, at the first common one.
        & (F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) >= need)
    )
    cross = one.join(other, fits).select(*_ordered("x.node", "y.node")).distinct()
    cross = cross.join(tested, ["a", "b"], "left_anti")
    open_pairs = stored(_overlap_filter(cross, nodes, percent), "pairs")
    if open_pairs.limit(1).count():
        more = stored(_linked(open_pairs, nodes, source, size, percent), "links")
        labels = components(edges.unionByName(more)).toDF("node", "label")

    # Names: the smallest id over each component, then back to nodes, then to rows.
    owners = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("own"))
    owners = owners.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = owners.groupBy("label").agg(F.min("own").alias("component_id"))
    names = owners.join(named, "label").select("node", "component_id")
    out = rows.select("doc_id", "n", "node", "tid").join(names, "node", "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "tid",
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest id, then text hash; columns stay.

    Null ids come last. A row repeated as a whole stays once.
    """
    inner, back = set_aside(docs, ["g_id", "g_tid"], [doc_id, text])
    found = linked_components(inner, doc_id, text, **options)
    # Texts without words are a component each, named by id and text.
    group = [F.col("component_id"), F.when(F.col("n_shingles") == 0, F.col("doc_id")), F.when(F.col("n_shingles") == 0, F.col("tid"))]
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tid")
    first = found.groupBy(*[g.alias(f"k{i}") for i, g in enumerate(group)]).agg(F.min(order).alias("one"))
    kept = first.select("one.doc_id", "one.tid", F.lit(True).alias("stays"))
    counted = found.groupBy("doc_id", "tid").agg(F.count("*").alias("n")).alias("c")
    same = F.col("c.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("c.tid") == F.col("k.tid"))
    keys = stored(counted.join(kept.alias("k"), same, "left").select("c.doc_id", "c.tid", "n", "stays"), "kept")
    same = F.col(doc_id).eqNullSafe(F.col("g_id")) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("g_tid"))
    gone, more = (
        _handed(keys.where(rule).select(F.col("doc_id").alias("g_id"), F.col("tid").alias("g_tid")))
        for rule in ("stays IS NULL", "stays AND n > 1")
    )
    left = inner.join(gone, same, "left_anti")
    once = left.join(more, same, "left_semi").dropDuplicates([doc_id, text])
    return back(left.join(more, same, "left_anti").unionByName(once))


def _handed(ids: DataFrame) -> DataFrame:
    """Ids to be joined with texts: handed to them if a count shows that they are few."""
    return F.broadcast(ids) if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else ids

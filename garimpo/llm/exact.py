"""Exact dedup: rows grouped by a 128-bit content hash, whose groups are then compared byte by byte.

Two texts are equal when they are the same after each run of ``[\\x20\\x09-\\x0D]``
is replaced by one space; nothing is trimmed. The row with the smallest id stays.

1. Each text is normalised and hashed (the first 128 bits of its SHA-256); only the
   ids and hashes are written and shuffled.
2. Hashes are counted, combined on the map side, so a text that a third of all rows
   share sends one row from each task.
3. Texts of repeated hashes are compared: grouped by hash *and* text, which compares
   the bytes of all that share a hash. A fixed number of bits (``BITS``) tells most
   unrepeated texts, which stay where they are; equal texts meet on the map side.
   A hash with several texts is a collision; its rows are numbered by text instead.
4. Rows find their group in a join on the hash. Hashes of more than one row in
   ``HOT`` are at most ``HOT`` in number, so they are broadcast; all others are small.

Results for odd rows: a null text is the empty text, and equals other empty texts,
not a text of spaces. Null ids never stay while the group has another id; if it has
none, one of its rows stays and ``keep_id`` is null. Of rows equal in id and text one
stays. Texts of any length are handled whole. An empty table gives no rows. Columns
of the input that are named like a result are kept by ``deduplicated`` and left out
by ``marked``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.llm.frames import set_aside, stored

HOT = 1000
BITS = 24
# Single spaces stay as they are, so most texts are not copied.
SPACES = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def content_hash(digest: Column) -> Column:
    """128 bits of a SHA-256 digest given as 32 bytes."""
    return F.substring(digest, 1, 16)


def _bit(key: Column) -> tuple[Column, Column]:
    """Which of ``2 ** (BITS - 6)`` words, and which bit of it, stands for a hash."""
    bit = F.xxhash64(key).bitwiseAND((1 << BITS) - 1)
    return F.shiftright(bit, 6), F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int"))


def _suspects(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """``texts`` whose hash may be repeated: all that are, and few others.

    One row a 64-bit word of the bits is broadcast, ``2 ** (BITS - 6)`` rows at most.
    """
    word, bit = _bit(F.col("h"))
    words = groups.where("size > 1").select(word.alias("word"), bit.alias("bit"))
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    marked = texts.withColumns({"word": word, "bit": bit}).join(F.broadcast(words), "word")
    return marked.where(F.col("bits").bitwiseAND(F.col("bit")) != 0).drop("word", "bit", "bits")


def _groups(keyed: DataFrame) -> DataFrame:
    """Of each hash the smallest id, the number of rows, and the row that stays."""
    stays = F.coalesce(F.min_by("rid", "id"), F.min("rid"))
    return keyed.groupBy("h").agg(F.min("id").alias("keep_id"), F.count("*").alias("size"), stays.alias("keep_rid"))


def _told_apart(keyed: DataFrame, texts: DataFrame, groups: DataFrame) -> DataFrame | None:
    """``keyed`` with an own key for each text of a collided hash; none where no hash collides."""
    found = _suspects(texts, groups).groupBy("h", "body").agg(F.count("*").alias("rows"))
    several = found.groupBy("h").agg(F.count("*").alias("texts")).where("texts > 1").select("h")
    several = stored(several, "collisions")
    if several.isEmpty():
        return None
    parted = texts.join(several, "h", "left_semi")
    own = parted.groupBy("h", "body").agg(F.count("*").alias("rows"))
    own = stored(own.select("h", "body", F.monotonically_increasing_id().alias("part")), "collided")
    parted = parted.join(own, ["h", "body"]).withColumn("h", F.concat("h", F.unhex(F.lpad(F.hex("part"), 16, "0"))))
    return keyed.join(several, "h", "left_anti").unionByName(parted.select(*keyed.columns))


def _marked(rows: DataFrame, key: Callable[[Column], Column]) -> DataFrame:
    """``(rid, id, keep_id, group_size, kept, text_sha256)`` of rows ``(rid, id, text)``."""
    texts = rows.select("rid", "id", normalised(F.col("text")).alias("body"))
    texts = texts.withColumn("digest", F.unhex(F.sha2("body", 256))).withColumn("h", key(F.col("digest")))
    keyed = stored(texts.select("rid", "id", "digest", "h"), "keyed")
    groups = stored(_groups(keyed), "groups")
    apart = _told_apart(keyed, texts, groups)
    if apart is not None:
        keyed = stored(apart, "keyed")
        groups = stored(_groups(keyed), "groups")
    total = keyed.count()
    hot = groups.where(F.col("size") * HOT > total)
    found = keyed.join(F.broadcast(hot), "h")
    rest = keyed.join(F.broadcast(hot.select("h")), "h", "left_anti").join(groups, "h")
    return found.unionByName(rest).select(
        "rid", "id", "keep_id", F.col("size").alias("group_size"), (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def marked(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", key: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """``(id_column, keep_id, group_size, kept, text_sha256)``: a row for each row of ``docs``.

    ``key`` makes the hash of a digest; any other may be given, as equal hashes of
    different texts are told apart.
    """
    number = F.monotonically_increasing_id().alias("rid")
    rows = docs.select(number, F.col(id_column).alias("id"), F.col(text).alias("text"))
    return _marked(rows, key).withColumnRenamed("id", id_column).drop("rid")


def deduplicated(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", key: Callable[[Column], Column] = content_hash
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; they are written once with a number each."""
    aside, restore = set_aside(docs, ["rid"])
    names = dict(zip(docs.columns, aside.columns, strict=True))
    rows = stored(aside.withColumn("rid", F.monotonically_increasing_id()), "numbered")
    read = rows.select("rid", F.col(f"`{names[id_column]}`").alias("id"), F.col(f"`{names[text]}`").alias("text"))
    return restore(rows.join(_marked(read, key).where("kept").select("rid"), "rid", "left_semi"))


ORACLE = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
  row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST, rid) = 1 AS kept, sha256(body) AS text_sha256
FROM texts
"""

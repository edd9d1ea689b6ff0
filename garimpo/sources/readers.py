"""Stored inputs: tables, exports, captures, keyword files.

Schemas are given, never inferred, so reading needs no extra pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo import constants as C
from garimpo.functions import jsons, text
from garimpo.functions.steps import computed

EXPORT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in C.EXPORT_COLUMNS])
CAPTURE_SCHEMA = T.StructType(
    [
        T.StructField("entry_id", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("text", T.StringType()),
    ]
)
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """Stored pages, ``page_id, url, html``; the session's split size deals them out."""
    return table(spark, folder, "pages")


def page_files(spark: SparkSession, path: str) -> DataFrame:
    """Saved page files, one page per file, with the file as URL."""
    url = F.col("_metadata.file_path")
    return spark.read.text(path, wholetext=True).select(
        F.xxhash64(url).alias("page_id"), url.alias("url"), F.col("value").alias("html")
    )


CORRUPT = "_corrupt_record"


def _capture_files(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    schema = T.StructType([*CAPTURE_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).json(path).withColumn("arquivo", F.col("_metadata.file_path"))


def capture_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Network logs as JSON, one array a file, or one a line without ``multi_line``.

    What is no JSON gives no rows here; ``capture_rejects`` has it.
    """
    return _capture_files(spark, path, multi_line).filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "arquivo")


def capture_rejects(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``(arquivo, texto)`` of each file, or line, that is no JSON: the side of ``capture_json`` to count."""
    # Spark refuses to read the corrupt column alone, so the condition looks at a field too.
    fields = F.size(F.array_compact(F.array("url", "text")))
    broken = _capture_files(spark, path, multi_line).filter(F.col(CORRUPT).isNotNull() & (fields >= 0))
    return broken.select("arquivo", F.col(CORRUPT).alias("texto"))


def _array_pieces(spark: SparkSession, path: str | list[str], indent: int) -> DataFrame:
    """``arquivo, texto, aberto, fechado, registros`` of files of one indented JSON array each.

    Files are cut where a record begins on a line of its own, at ``indent``: neither a string nor
    an inner object can hold that, so the text reader splits a file of any size over tasks. What is
    between two cuts is made an array again; ``registros`` are its elements as JSON, null where
    it is none, as the piece that a cut-off file ends with.
    """
    lines = spark.read.option("lineSep", ",\n" + " " * indent + "{").text(path)
    named = lines.select(F.col("_metadata.file_path").alias("arquivo"), F.trim("value", F.lit(" \t\r\n\ufeff")).alias("texto"))
    opened, closed = F.col("texto").startswith("["), F.col("texto").endswith("]")
    begun = F.concat(F.when(opened, F.lit("")).otherwise(F.lit("[{")), "texto")
    # A file may be cut off behind the comma of a whole record.
    array = F.concat(F.regexp_replace(begun, ",$", ""), F.when(closed, F.lit("")).otherwise(F.lit("]")))
    # Within one more array the parser does not pass over what follows the piece's own.
    parsed = F.from_json(F.concat(F.lit("["), array, F.lit("]")), "array<array<string>>", jsons.STRICT)
    read = computed(named, ["arquivo", "texto", opened.alias("aberto"), closed.alias("fechado")], {"lidos": parsed})
    return read.select("arquivo", "texto", "aberto", "fechado", F.when(F.size("lidos") == 1, F.col("lidos")[0]).alias("registros"))


def json_array(
    spark: SparkSession, path: str | list[str], schema: T.StructType, indent: int = 2, whole_files: bool = False
) -> DataFrame:
    """Records of files that hold one indented JSON array each; a file of any size is read by many tasks.

    Records that cannot be read are left out, and ``json_array_rejects`` has them; with ``whole_files``,
    files that are no whole array are left out, which takes a second scan. A file in another layout, as one line,
    gives the same rows but is read by one task. Empty files and arrays have no records.
    """
    pieces = _array_pieces(spark, path, indent)
    if whole_files:
        pieces = pieces.join(cut_files(spark, path, indent), "arquivo", "left_anti")
    records = pieces.select(F.explode("registros").alias("registro")).filter(F.col("registro").startswith("{"))
    return records.select(F.from_json("registro", schema, jsons.STRICT).alias("r")).select("r.*")


def json_array_rejects(spark: SparkSession, path: str | list[str], indent: int = 2) -> DataFrame:
    """``(arquivo, texto)`` of what is no record in such files: pieces that are no JSON, elements that are no objects."""
    pieces = _array_pieces(spark, path, indent).filter(F.length("texto") > 0)
    listed = pieces.select("arquivo", F.explode(F.coalesce("registros", F.array("texto"))).alias("texto"), F.col("registros").isNull().alias("solto"))
    return listed.filter(F.col("solto") | F.coalesce(~F.col("texto").startswith("{"), F.lit(True))).select("arquivo", "texto")


def cut_files(spark: SparkSession, path: str | list[str], indent: int = 2) -> DataFrame:
    """``arquivo`` of files that are no whole array: not opened, not closed, or with a piece that is no JSON."""
    sound = F.col("registros").isNotNull() & ~F.col("texto").endswith(",")
    shape = _array_pieces(spark, path, indent).groupBy("arquivo").agg(
        (F.bool_or("aberto") & F.bool_or("fechado") & F.every(sound)).alias("inteiro")
    )
    return shape.filter("NOT inteiro").select("arquivo")


def export_csv(spark: SparkSession, path: str | list[str], skip_corrupt_files: bool = False) -> DataFrame:
    """Listing exports by folder or glob, with file metadata at hand.

    A file that cannot be read fails the job unless asked otherwise; with
    ``skip_corrupt_files``, ``files_without_rows`` names those left out.
    """
    return (
        spark.read.schema(EXPORT_SCHEMA)
        .options(**CSV_OPTIONS)
        .option("ignoreCorruptFiles", skip_corrupt_files)
        .csv(path)
    )


def file_names(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(arquivo, bytes)`` of the files below a folder or glob, without reading them."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return found.select(F.col("path").alias("arquivo"), F.col("length").alias("bytes"))


def files_without_rows(spark: SparkSession, path: str, rows: DataFrame, pattern: str = "*.csv") -> DataFrame:
    """Files below ``path`` that gave no row of ``rows``: empty or skipped as unreadable."""
    seen = rows.select(F.col("_metadata.file_path").alias("arquivo")).distinct()
    plain = F.regexp_replace("arquivo", "^file:/+", "/")
    return file_names(spark, path, pattern).withColumn("k", plain).join(seen.select(plain.alias("k")), "k", "left_anti").drop("k")


def export_json(spark: SparkSession, path: str, schema: T.StructType = EXPORT_SCHEMA) -> DataFrame:
    """Listing exports as JSON lines."""
    return spark.read.schema(schema).json(path)


def latest_file(spark: SparkSession, path: str, pattern: str = "*") -> str | None:
    """The file with the greatest name below a folder or glob, found by listing; None without files."""
    return file_names(spark, path, pattern).agg(F.max("arquivo").alias("a")).first()["a"]


def latest_batch(spark: SparkSession, path: str, pattern: str = "*") -> str | None:
    """The folder with the greatest name that holds files, found by listing: a batch of any number of files."""
    folder = F.regexp_replace("arquivo", "/[^/]*$", "")
    return file_names(spark, path, pattern).agg(F.max(folder).alias("a")).first()["a"]


def keyword_lines(spark: SparkSession, path: str) -> DataFrame:
    """Keywords, one per line, trimmed, blank lines dropped."""
    lines = spark.read.text(path).select(text.strip(F.col("value")).alias("keyword"))
    return lines.filter(F.length("keyword") > 0)


def listing_scan(listings: DataFrame, limit: int | None = None) -> DataFrame:
    """Export columns of the listing table, optionally the first ``limit`` by id."""
    rows = listings.select(*C.EXPORT_COLUMNS)
    return rows if limit is None else rows.orderBy("id").limit(limit)

"""The registered queries of this package: one per operator, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garimpo.llm import (
    contamination, conversations, exact, fingerprint, html_text, jaccard, licences, mixing, oracles, phrases, pii, quality, secrets,
    substrings,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op1_licences": licences.oracle(),
    "op3_contamination": oracles.CONTAMINATION,
    "op5_jaccard_components": oracles.JACCARD,
    "op8_substring_dedup": oracles.SUBSTRINGS,
    "op10_source_mixture": oracles.MIXTURE,
    "op11_exact_copies": exact.ORACLE,
    "op13_collocations": phrases.ORACLE,
}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Known licences that every document is, or has as a line."""
    return licences.scanned(table(spark, folder, "documents"))


@query
def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Threshold-scaled sketch of every text, of its edited text, and their likeness."""
    return fingerprint.edit_report(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op3_contamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside benchmark windows."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = contamination.contaminated(docs, table(spark, folder, "benchmark"), keep_text=False)
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


@query
def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document, told by a random forest."""
    return secrets.report(table(spark, folder, "documents"))


@query
def op5_jaccard_components(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents under links of 3-word shingle sets at 90 %."""
    found = jaccard.linked_components(table(spark, folder, "documents"), size=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = quality.scored(docs, table(spark, folder, "labels"))
    return found.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query
def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.extracted(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document left after passages found elsewhere are removed."""
    found = substrings.without_repeats(table(spark, folder, "documents"), whole=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document, and the words that give it away."""
    return pii.report(table(spark, folder, "documents"))


@query
def op10_source_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Words taken of every document by a mix of all sources."""
    found = mixing.mixed(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query
def op11_exact_copies(spark: SparkSession, folder: str) -> DataFrame:
    """The group of equal texts of every document, and which row of it stays."""
    return exact.marked(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of every damaged conversation, and its cheapest repair."""
    return conversations.report(conversations.damaged(table(spark, folder, "conversations")))


@query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """Strongest phrases of every language."""
    return phrases.collocations(table(spark, folder, "documents").select("lang", "text"))

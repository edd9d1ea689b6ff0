"""PII: base patterns and information-theoretic sanitisation, in DataFrame operations only.

Base spans are e-mail addresses, IP numbers, card numbers and phone numbers. Each
found value is a protected entity. Words within ``AROUND`` code points of it are
terms that may reveal it, and the corpus says how strongly: with n(t) uses of a
term in all texts, n(t, e) of them next to entity e, n(e) words next to e and N
words in all, a term discloses the entity if

* the share n(t, e) / n(t) is at least ``SHARE``: seeing the term gives the entity away,
* the pointwise mutual information log2(N n(t, e) / (n(t) n(e))) is at least ``BITS``
  after n(t, e) is discounted by k / (k + 1), where k different texts have the term
  next to the entity: one text costs a bit, many cost nothing.

A term used once, next to its only entity, is so the strongest disclosure and no exception.

Its uses next to that entity become spans of kind ``term``, unless they overlap a
base span. Counts cover all texts; they are aggregates combined before the shuffle.

Patterns are possessive and anchored at the first character a match can have, so
long runs of letters or digits are read once; they find what the plain patterns
find. Null and blank texts have no spans. Rows repeated or with equal ids get
their own result rows; copies of a text count once in k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.llm import spans
from garimpo.llm.frames import stored

# \G also lets a match begin where the one before it ended.
PATTERNS = [
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]
KINDS = [kind for kind, _ in PATTERNS]
# What every text with a match has; most texts have none of it and are searched for nothing else.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
TERM = r"\p{L}{3,}+"
AROUND = 48
SHARE = 0.5
BITS = 8.0
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right; digits are numbered from the last one."""
    places = F.sequence(F.lit(1), F.length(digits))

    def worth(i: Column) -> Column:
        one = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(one > 4, 2 * one - 9).otherwise(2 * one)
        return F.when(i % 2 == 0, twice).otherwise(one)

    return F.aggregate(F.transform(places, worth), F.lit(0), lambda s, x: s + x) % 10 == 0


def is_valid() -> Column:
    """Whether a match of a base pattern counts."""
    value, digits = F.col("value"), _digits(F.col("value"))
    n = F.length(digits)
    return (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
        .when(F.col("kind") == "card", F.when(n.between(12, 19), luhn(digits)).otherwise(False))
        .when(F.col("kind") == "phone", n.between(9, 15))
        .otherwise(False)
    )


def base_spans(docs: DataFrame, text: str = "text", around: int = AROUND) -> DataFrame:
    """``spans.exploded`` of the base kinds; matches that do not count have null ``kind``."""
    found = spans.exploded(docs, text, PATTERNS, around, NEEDS)
    ok = is_valid()
    return found.withColumn("kind", F.when(ok, F.col("kind")))


def context_terms(found: DataFrame) -> DataFrame:
    """``(rid, tid, entity, term, begin, end)``: the words next to each base span."""
    left = spans.short_matches(F.col("left"), TERM)
    right = spans.short_matches(F.col("right"), TERM)
    # A word cut by the end of the context is not a term.
    whole_left = F.filter(left, lambda w: (w["begin"] > 0) | (F.length("left") < AROUND))
    whole_right = F.filter(right, lambda w: (w["end"] < F.length("right")) | (F.length("right") < AROUND))
    moved = F.concat(
        F.transform(whole_left, lambda w: F.struct(
            w["value"].alias("value"), (w["begin"] + F.col("begin") - F.length("left")).alias("begin"),
            (w["end"] + F.col("begin") - F.length("left")).alias("end"))),
        F.transform(whole_right, lambda w: F.struct(
            w["value"].alias("value"), (w["begin"] + F.col("end")).alias("begin"), (w["end"] + F.col("end")).alias("end"))),
    )
    entity = F.concat_ws(":", "kind", F.lower("value"))
    rows = found.where("kind IS NOT NULL").select("rid", "tid", entity.alias("entity"), F.explode(moved).alias("w"))
    return rows.select("rid", "tid", "entity", F.lower("w.value").alias("term"), "w.begin", "w.end").distinct()


def disclosing(
    docs: DataFrame, terms: DataFrame, text: str = "text", share: float = SHARE, bits: float = BITS
) -> DataFrame:
    """``(entity, term, share, bits)`` of terms that give an entity away."""
    pairs = terms.groupBy("entity", "term").agg(F.count("*").alias("n_te"), F.countDistinct("tid").alias("texts"))
    entities = terms.groupBy("entity").agg(F.count("*").alias("n_e"))
    # Every word of every text is counted, by task first.
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(TERM), 0)).alias("term"))
    uses = stored(words.groupBy("term").agg(F.count("*").alias("n_t")), "uses")
    total = uses.agg(F.coalesce(F.sum("n_t"), F.lit(0)).alias("n")).first()["n"]
    rated = pairs.join(uses, "term").join(entities, "entity")
    part = F.least(F.col("n_te") / F.col("n_t"), F.lit(1.0))
    sure = F.col("n_te") * F.col("texts") / (F.col("texts") + 1)
    pmi = F.log2(F.lit(float(max(total, 1))) * sure / (F.col("n_t").cast("double") * F.col("n_e")))
    rated = rated.select("entity", "term", part.alias("share"), pmi.alias("bits"))
    return rated.where((F.col("share") >= share) & (F.col("bits") >= bits))


def found_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **thresholds) -> DataFrame:
    """A row for each input row: ``(doc_id, tid, spans)``, spans as structs of begin, rank, kind, end."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("tid"), F.col(text).alias("text"))
    found = stored(base_spans(source), "base")
    terms = stored(context_terms(found), "terms")
    told = disclosing(source, terms, **thresholds).select("entity", "term")
    extra = terms.join(told, ["entity", "term"]).select("rid", "begin", "end").distinct()
    extra = extra.select("rid", "begin", F.lit(len(KINDS)).alias("rank"), F.lit("term").alias("kind"), "end")
    columns = ["begin", "rank", "kind", "end"]
    base = found.select("rid", "doc_id", "tid", *columns)
    none = extra.select("rid", F.lit(None).cast(base.schema["doc_id"].dataType).alias("doc_id"), F.lit(None).cast("long").alias("tid"), *columns)
    one = F.when(F.col("kind").isNotNull(), F.struct(*columns))
    rows = base.unionByName(none).groupBy("rid").agg(
        # Only base rows carry the id; there is at least one for each input row.
        F.max("doc_id").alias("doc_id"), F.max("tid").alias("tid"), F.collect_list(one).alias("all"),
    )
    plain = F.filter("all", lambda s: s["kind"] != "term")
    free = F.filter("all", lambda t: (t["kind"] == "term") & ~F.exists("plain", lambda b: (b["begin"] < t["end"]) & (t["begin"] < b["end"])))
    rows = rows.withColumn("plain", plain).withColumn("free", free)
    return rows.select("doc_id", "tid", F.array_sort(F.concat("plain", "free")).alias("spans"))


def sanitised(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **thresholds) -> DataFrame:
    """``docs`` with column ``sanitised``: each span, overlapping ones together, generalised to its kind in brackets."""
    found = found_spans(docs, doc_id, text, **thresholds).where(F.size("spans") > 0).dropDuplicates(["doc_id", "tid"])

    def grow(state: Column, s: Column) -> Column:
        # The state is the text so far, and how far it reaches in the original.
        gap = F.substring("f_text", (state["at"] + 1).cast("int"), F.greatest(s["begin"] - state["at"], F.lit(0)).cast("int"))
        fresh = s["begin"] >= state["at"]
        mark = F.when(fresh, F.concat(gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")
        return F.struct(F.concat(state["out"], mark).alias("out"), F.greatest(state["at"], s["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    rebuilt = F.aggregate(
        "f_spans", start, grow,
        lambda state: F.concat(state["out"], F.substring("f_text", (state["at"] + 1).cast("int"), F.length("f_text"))),
    )
    same = F.col(doc_id).eqNullSafe(F.col("f_id")) & (F.xxhash64(text) == F.col("f_tid"))
    joined = docs.join(found.toDF("f_id", "f_tid", "f_spans"), same, "left").withColumn("f_text", F.col(text))
    out = F.when(F.col("f_spans").isNull(), F.col(text)).otherwise(rebuilt)
    return joined.withColumn("sanitised", out).drop("f_id", "f_tid", "f_spans", "f_text")


def _equals(kind: str):
    return lambda name: name == kind


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **thresholds) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text, for every row."""
    found = found_spans(docs, doc_id, text, **thresholds)
    base = F.filter("spans", lambda s: s["kind"] != "term")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _equals(kind))).cast("long").alias(f"n_{kind}") for kind in [*KINDS, "term"]]
    return found.select(
        "doc_id", *counts, F.sha2(spans.listed(base), 256).alias("base_sha256"), spans.listed(F.col("spans")).alias("spans")
    )

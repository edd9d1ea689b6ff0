"""Secret scans: a random forest tells secrets from other long tokens, in DataFrame operations only.

Candidates are, first match first,

* what stands after a credential name, of any length and any characters but spaces:
  up to the closing quote, the next parameter of a URL or ``;name=``, without
  closing punctuation where it is not quoted;
* the user and the password in a URL's user part;
* runs of ``LEAST`` or more characters of ``[A-Za-z0-9+/_-]`` that hold a digit,
  with up to two ``=`` at their end, unless they end in an assigned credential name.

Each is described by its length, its character transitions (changes of character
class, repeats), how much of it dictionary words cover, its path, and its
neighbouring words; a random forest over labelled findings removes the false
positives.

* ``findings`` are labelled rows ``(value, left, right, path, label)``. Without any
  of your own, ``seeded_findings`` makes them from a bounded sample, the first ``HEAD``
  characters of ``SEEDS`` documents: digests, random keys, short passwords and passphrases given to credential names or
  in URLs, against digests of commits and checksums, identifiers, numbers, paths,
  words, variables and placeholders.
* The dictionary holds the ``WORDS`` most frequent words of all texts.
* Null and blank texts have no candidates. Rows repeated or with equal ids each
  get a result row; text and neighbours decide, so equal rows get equal results.
* With labels of one class only, that class is the answer for every candidate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.llm import spans
from garimpo.llm.frames import set_aside, small_hash, stored

LEAST = 12
AROUND = 40
WORDS = 300
SEEDS = 1500
HEAD = 400
TREES = 30
DEPTH = 7
CUT = 0.5
# Names that credentials, and that other digests and numbers, are given.
SECRET_NAMES = (
    "token", "secret", "password", "passwd", "pwd", "passphrase", "credential", "credentials", "auth", "bearer",
    "apikey", "api_key", "access_key", "private_key", "client_secret", "key",
)
OTHER_NAMES = (
    "commit", "checksum", "sha1", "sha256", "md5", "digest", "hash", "etag", "revision", "uuid", "isbn", "order",
    "invoice", "version", "build", "file", "path", "page",
)
_ANY_NAME = "|".join(SECRET_NAMES)
_NAME = rf"(?<![A-Za-z0-9])(?i:{_ANY_NAME})"
# A short look behind comes before each long one, which is costly.
# What may stand between a name and its value; Java looks behind only as far as a pattern is bounded.
_GAP = r"[\"'`]?(?:\s{0,16}(?::=|=>|==|[:=])\s{0,16}|\s{1,16}is\s{1,16}|\s{1,16})"
_END = r"[^\s.,;)\]}>\"'`]"
NAMED = (
    r"(?<=[\s:=>\"'`])(?:"
    rf"(?<==)(?<=[?&](?i:{_ANY_NAME})=)[^\s&#\"'<>]++"
    + "".join(rf"|(?<={q})(?<={_NAME}{_GAP}{q})[^\s{q}]++" for q in "\"'`")
    + rf"|(?![:=>\"'`]|is\s)(?<={_NAME}{_GAP})(?:(?!\S*?;[A-Za-z][A-Za-z _-]{{0,40}}=)\S*{_END}|[^\s;]*[^\s.,;)\]}}>\"'`]))"
)
IN_URL = r"(?<=://)[^\s/?#@:]++(?=@|:[^\s/?#]*@)|(?<=:)(?<=://[^\s/?#@:]{0,200}:)[^\s/?#]+(?=@)"
RUN = (
    rf"(?<![A-Za-z0-9+/_-])(?!(?<=:)//[^\s/?#]*@)(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{{{LEAST},}}+"
    rf"(?!(?<={_NAME})[\"'`]?\s{{0,16}}[:=])(?:={{1,2}}+(?![A-Za-z0-9+/_=-]))?+"
)
CANDIDATE = f"{NAMED}|{IN_URL}|{RUN}"
# What every text with a candidate has.
NEEDS = rf"[0-9]|://|(?i:{_ANY_NAME})[\"'`]?[\s:=]"
HOLDER = (
    r"^(?:[$%]?[{(<\[].*|\$[a-z_]+|%[a-z_]+%|[*x.#?_-]+|none|null|nil|true|false|undefined|changeme|redacted|required|optional"
    r"|string|str|value|placeholder|your[_-].*|[a-z_.]+[(\[].*)$"
)
_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
FEATURES = [
    "length", "transitions", "repeats", "distinct", "digits", "uppers", "marks", "hex_only", "digits_only", "covered",
    "path_test", "path_depth", "slashes", "named_secret", "named_other", "assigned", "quoted", "digit_near", "left_words",
    "symbols", "letters_only", "holder", "in_url", "a_name",
]


def dictionary(docs: DataFrame, text: str = "text", most: int = WORDS) -> list[str]:
    """The most frequent words of three letters or more, over all texts; ``most`` strings reach the driver."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit("[a-z]{3,}+"), 0)).alias("w"))
    top = words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(most)
    return [r["w"] for r in top.toLocalIterator()]


def _named(column: str, names: tuple[str, ...]) -> Column:
    """Whether one of the names ends the text before, up to an assignment and a quote."""
    return F.lower(F.col(column)).rlike(rf"(?<![a-z0-9])(?:{'|'.join(names)})[\"']?\s*(?::=|=>|==|[:=]|is)?\s*[\"'`]?$")


def described(found: DataFrame, words: list[str]) -> DataFrame:
    """``found`` (``value, left, right, path``) with the columns of ``FEATURES``."""
    value = F.col("value")
    n = F.greatest(F.length(value), F.lit(1)).cast("double")
    classes = F.translate(value, _LOWER + _UPPER + _DIGIT + "+/=_-", "l" * 26 + "u" * 26 + "d" * 10 + "m" * 5)
    classes = F.regexp_replace(classes, "[^ludm]", "s")
    path = F.coalesce(F.col("path").cast("string"), F.lit(""))
    left, right = F.coalesce("left", F.lit("")), F.coalesce("right", F.lit(""))
    longest_first = sorted(words, key=lambda w: (-len(w), w))
    uncovered = F.regexp_replace(F.lower(value), "|".join(longest_first), "") if words else F.lower(value)

    def share(kept: str) -> Column:
        return F.length(F.regexp_replace(classes, f"[^{kept}]", "")) / n

    return found.withColumns({
        "length": n,
        "transitions": F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) / n,
        "repeats": 1 - F.length(F.regexp_replace(value, r"(.)\1+", "$1")) / n,
        "distinct": F.size(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.substring(value, i, F.lit(1))))) / n,
        "digits": share("d"),
        "uppers": share("u"),
        "marks": share("m"),
        "hex_only": (value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")).cast("double"),
        "digits_only": value.rlike("^[0-9]+$").cast("double"),
        "covered": 1 - F.length(uncovered) / n,
        "path_test": F.lower(path).rlike("test|example|sample|mock|fixture|doc").cast("double"),
        "path_depth": F.size(F.split(path, "/")).cast("double"),
        "slashes": F.length(F.regexp_replace(value, "[^/]", "")).cast("double"),
        "named_secret": _named("left", SECRET_NAMES).cast("double"),
        "named_other": _named("left", OTHER_NAMES).cast("double"),
        "assigned": left.rlike(r"(?:[:=]|=>)\s*[\"'`]?$").cast("double"),
        "quoted": (left.rlike("[\"'`]$") & F.col("right").rlike("^[\"'`]")).cast("double"),
        "digit_near": left.rlike(r"[0-9]\s?$").cast("double"),
        "left_words": F.size(F.regexp_extract_all(left, F.lit(r"\p{L}{2,}+"), 0)).cast("double"),
        "symbols": share("s"),
        "letters_only": value.rlike(r"^\p{L}+$").cast("double"),
        "holder": F.lower(value).rlike(HOLDER).cast("double"),
        # The user before has been a match of its own.
        "in_url": (left.rlike(r"(?:^|://[^\s/?#@:]*):$") & right.rlike("^@")).cast("double"),
        "a_name": right.rlike(r"^[\"'`]?\s?[:=]").cast("double"),
    })


def seeded_findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = SEEDS) -> DataFrame:
    """Labelled findings made from the ``rows`` documents with the smallest hash of their id.

    Neighbours are words of those documents; values are digests of their ids in
    the forms keys, identifiers and file names have.
    """
    base = docs.where(F.col(doc_id).isNotNull() & (F.length(F.trim(F.col(text))) > 0))
    base = base.select(F.col(doc_id).cast("string").alias("id"), F.substring(F.col(text), 1, HEAD).alias("head"))
    # Rows of small hashes only, some more than needed, so that the sort sees a bounded number of them.
    total = base.select("id").count()
    base = base.where(small_hash(F.col("id"), rows, total))
    base = base.groupBy("id").agg(F.min("head").alias("head")).orderBy(F.xxhash64("id"), "id").limit(rows)
    base = stored(base, "seeds")

    def digest(salt: str) -> Column:
        return F.sha2(F.concat(F.lit(salt), "id"), 256)

    def pick(options: tuple, salt: str) -> Column:
        place = F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(len(options))) + 1
        return F.element_at(F.array(*[F.lit(o) for o in options]), place.cast("int"))

    def base64(salt: str, n: int) -> Column:
        return F.substring(F.regexp_replace(F.base64(F.unhex(digest(salt))), "=", ""), 1, n)

    word = F.coalesce(F.get(F.regexp_extract_all("head", F.lit(r"\p{L}{3,}+"), 0), F.lit(2)), F.lit("word"))
    other = F.coalesce(F.get(F.regexp_extract_all("head", F.lit(r"[A-Za-z]{3,}+"), 0), F.lit(5)), F.lit("other"))
    before = F.right("head", F.lit(24))
    assign = pick((" = \"", "=", ": ", " = '", "\": \"", "=\""), "a")
    plain = pick((" ", ": ", " = ", " is "), "p")
    after = F.when(F.right(assign, F.lit(1)).isin("\"", "'"), F.concat(F.right(assign, F.lit(1)), F.lit(" "), word)).otherwise(F.concat(F.lit(" "), word))
    spaced = F.concat(F.lit(" "), word)
    secret = F.concat(before, F.lit(" "), F.when(F.pmod(F.xxhash64(F.lit("u"), "id"), F.lit(4)) == 0, F.upper(pick(SECRET_NAMES, "s"))).otherwise(pick(SECRET_NAMES, "s")), assign)
    named = F.concat(before, F.lit(" "), pick(OTHER_NAMES, "o"), plain)
    digits = F.translate(digest("n"), "abcdef", "012345")
    loud = F.pmod(F.xxhash64(F.lit("loud"), "id"), F.lit(4)) == 0

    def row(value: Column, left: Column, right: Column, path: str, label: int) -> Column:
        return F.struct(
            value.alias("value"), F.right(left, F.lit(AROUND)).alias("left"), F.left(right, F.lit(AROUND)).alias("right"),
            F.lit(path).alias("path"), F.lit(label).alias("label"),
        )

    hexes = F.substring(digest("h"), 1, 40)
    uuid = F.regexp_replace(F.substring(digest("u"), 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    sign = pick(("!", "@", "$", "&", ".", "#", "%", "*"), "y1")
    short = F.concat(base64("w", 4), sign, base64("v", 3), pick(("", "!", "7", "&3"), "y2"))
    third = F.coalesce(F.get(F.regexp_extract_all("head", F.lit(r"[A-Za-z]{3,}+"), 0), F.lit(8)), F.lit("third"))
    joint = pick(("-", "_", "."), "y3")
    phrase = F.lower(F.concat(other, joint, third, joint, other, joint, word))
    easy = F.concat(F.lower(other), F.substring(digits, 5, pick((1, 2), "z9")))
    close = F.when(F.right(assign, F.lit(1)).isin("\"", "'"), F.right(assign, F.lit(1))).otherwise(F.lit(""))
    loose = F.concat(before, F.lit(" "), pick(SECRET_NAMES, "y4"), pick((" ", " is ", ": ", " "), "y5"))
    url = F.concat(before, F.lit(" "), pick(("https", "postgres", "amqp", "ftp"), "y6"), F.lit("://"))
    host = F.concat(F.lit("@"), F.lower(other), F.lit(".example/"), F.lower(other))
    user = F.when(loud, F.lit("")).otherwise(F.concat(F.lower(third)))
    query = F.concat(url, F.lower(other), F.lit(".example/?"), pick(SECRET_NAMES, "y7"), F.lit("="))
    holder = pick(("${TOKEN}", "$SECRET", "<password>", "********", "None", "null", "changeme", "true", "os.environ[", "getpass()", "string", "%PWD%"), "y8")
    rows_of = [
        row(F.when(loud, F.upper(hexes)).otherwise(hexes), secret, after, "src", 1),
        row(F.substring(digest("m"), 1, 32), secret, after, "config/settings", 1),
        row(base64("b", 40), secret, after, "src/deploy", 1),
        row(F.concat(pick(("ghp_", "sk_live_", "xoxb-", "glpat-"), "x"), base64("g", 30)), secret, after, "src", 1),
        row(F.concat(pick(("AKIA", "ASIA"), "k"), F.translate(F.upper(F.substring(digest("k"), 1, 16)), "01", "ZY")), F.concat(before, F.lit(" ")), spaced, "src", 1),
        row(hexes, named, spaced, "src", 0),
        row(digest("c"), named, spaced, "docs/changes", 0),
        row(uuid, named, spaced, "src", 0),
        row(uuid, F.when(loud, F.lit("")).otherwise(F.concat(before, F.lit(" "))), pick((" is its uuid", " is the id", ": ", " was", " "), "z8"), "src", 0),
        row(F.substring(digits, 1, 16), F.concat(before, F.lit(" ")), spaced, "src", 0),
        row(F.substring(digits, 3, 14), named, spaced, "src", 0),
        row(F.concat(F.lower(other), F.lit("_"), F.lower(other), F.lit("_"), F.substring(digits, 1, 4)), F.concat(before, F.lit(" ")), spaced, "src", 0),
        row(F.concat(F.lit("/usr/"), F.lower(other), F.lit("/"), F.substring(digits, 1, 2), F.lit("/"), F.lower(other)), named, spaced, "src", 0),
        row(F.concat(F.lit("your_"), pick(SECRET_NAMES, "y"), F.lit("_here_123")), secret, after, "docs/example", 0),
        row(F.concat(F.lit("xxxxxxxxxxxx"), F.substring(digits, 1, 4)), secret, after, "docs/example", 0),
        row(F.concat(F.lower(other), F.lit("-"), F.lower(other), F.lit("-2"), F.substring(digits, 1, 3)), F.concat(before, F.lit(" ")), spaced, "docs", 0),
        row(short, secret, after, "src", 1),
        row(easy, secret, after, "config/settings", 1),
        row(phrase, secret, after, "src", 1),
        row(short, F.concat(before, F.lit(" "), pick(SECRET_NAMES, "y9"), pick((" ", " is "), "z1")), spaced, "src", 1),
        row(hexes, F.concat(before, F.lit(" "), pick(("Bearer ", "bearer ", "token "), "z2")), spaced, "src", 1),
        row(hexes, query, pick((" ", "&page=1"), "z3"), "src", 1),
        row(short, query, pick((" ", "&page=1"), "z4"), "src", 1),
        row(F.when(loud, phrase).when(F.pmod(F.xxhash64(F.lit("z5"), "id"), F.lit(2)) == 0, easy).otherwise(short), F.when(loud, F.lit(":")).otherwise(F.concat(url, user, F.lit(":"))), host, "src", 1),
        row(base64("t", 30), url, F.when(loud, F.concat(F.lit(":x"), host)).otherwise(host), "src", 1),
        row(F.lower(other), url, F.when(loud, host).otherwise(F.concat(F.lit(":"), easy, host)), "src", 0),
        row(F.lower(word), loose, spaced, "src", 0),
        row(F.concat(F.lower(word), pick(("", "'s", "!"), "z6")), loose, spaced, "docs", 0),
        row(holder, secret, F.concat(close, spaced), "src", 0),
        row(F.substring(digits, 7, 1), loose, spaced, "src", 0),
        row(F.concat(F.upper(other), F.lit("_"), F.upper(third), F.lit("_"), F.substring(digits, 2, 2)), F.concat(before, F.lit(" ")), F.concat(pick(("=", ": ", " = "), "z7"), easy), "src", 0),
    ]
    # Few rows at a time, as generated code has a limit.
    parts = [base.select(F.inline(F.array(*rows_of[i : i + 8]))) for i in range(0, len(rows_of), 8)]
    return reduce(DataFrame.unionAll, parts)


def train(findings: DataFrame, words: list[str], trees: int = TREES, depth: int = DEPTH, seed: int = 11) -> RandomForestClassificationModel:
    """A forest over the features of labelled findings, a bounded table.

    The forest draws rows by partition and place, so all are sorted into one partition:
    equal findings give the same forest in any session.
    """
    rows = described(findings.where("label IN (0, 1) AND value IS NOT NULL"), words)
    rows = rows.select(*FEATURES, F.col("label").cast("double").alias("label"), F.xxhash64("value", "left").alias("place"))
    rows = stored(rows, "findings").repartition(1).sortWithinPartitions("place", "label", *FEATURES)
    table = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(rows).select("features", "label")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label")
    return forest.fit(table)


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``spans.exploded`` for the candidate pattern: a row each, and one with null kind where there is none."""
    return spans.exploded(docs, text, [("secret", CANDIDATE)], AROUND, {"secret": NEEDS})


def rated(found: DataFrame, model: RandomForestClassificationModel, words: list[str]) -> DataFrame:
    """``found`` with ``score``: the share of the forest's votes for a secret."""
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(described(found, words))
    votes = vector_to_array("probability")
    scored = model.transform(ready).withColumn("score", F.coalesce(F.get(votes, F.lit(1)), F.lit(0.0)))
    return scored.select(*found.columns, "score")


def found_secrets(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source",
    findings: DataFrame | None = None, cut: float = CUT,
) -> DataFrame:
    """``(doc_id, tid, n_candidates, secrets)`` for every row; ``secrets`` are structs of begin, end,
    place (the candidate's number in the text) and score. ``tid`` is ``xxhash64`` of the text."""
    source = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("tid"), F.col(path).cast("string").alias("path"), F.col(text).alias("text")
    )
    words = dictionary(source)
    model = train(seeded_findings(source) if findings is None else findings, words)
    found = stored(candidates(source), "candidates")
    judged = rated(found.where("kind IS NOT NULL"), model, words)
    chosen = judged.where(F.col("score") >= cut).select("rid", "begin", "end", F.round("score", 6).alias("score"))
    columns = ["begin", "end", "score"]
    plain = found.select(
        "rid", "doc_id", "tid", F.col("kind").isNotNull().cast("long").alias("c"), F.lit(None).cast("long").alias("begin"),
        F.lit(None).cast("long").alias("end"), F.lit(None).cast("double").alias("score"),
    )
    kinds = dict(plain.dtypes)
    extra = chosen.select("rid", F.lit(None).cast(kinds["doc_id"]).alias("doc_id"), F.lit(None).cast("long").alias("tid"), F.lit(0).cast("long").alias("c"), *columns)
    one = F.when(F.col("begin").isNotNull(), F.struct(*columns))
    return plain.unionByName(extra).groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("tid").alias("tid"), F.sum("c").alias("n_candidates"),
        F.array_sort(F.collect_list(one)).alias("secrets"),
    ).drop("rid")


def masked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source", length: str | None = "n_chars", mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; ``length``, if there, becomes the new text's code points where it changed."""
    inner, back = set_aside(docs, ["s_id", "s_tid", "s_spans"], [doc_id, text, path])
    found = found_secrets(inner, doc_id, text, path, **options).where(F.size("secrets") > 0)
    found = found.dropDuplicates(["doc_id", "tid"]).select("doc_id", "tid", "secrets").toDF("s_id", "s_tid", "s_spans")
    same = F.col(doc_id).eqNullSafe(F.col("s_id")) & (F.xxhash64(text) == F.col("s_tid"))
    joined = inner.join(found, same, "left")

    def grow(state: Column, s: Column) -> Column:
        gap = F.substring(F.col(text), (state["at"] + 1).cast("int"), (s["begin"] - state["at"]).cast("int"))
        return F.struct(F.concat(state["out"], gap, F.lit(mark)).alias("out"), s["end"].alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    rebuilt = F.aggregate(
        "s_spans", start, grow,
        lambda state: F.concat(state["out"], F.substring(F.col(text), (state["at"] + 1).cast("int"), F.length(text))),
    )
    changed = F.col("s_spans").isNotNull()
    out = joined.withColumn(text, F.when(changed, rebuilt).otherwise(F.col(text)))
    if length and length in docs.columns:
        out = out.withColumn(length, F.when(changed, F.length(text).cast(docs.schema[length].dataType)).otherwise(F.col(length)))
    return back(out)


def report(docs: DataFrame, **options) -> DataFrame:
    """Numbers of candidates and secrets, and the secrets' places as ``begin:end``, for every row."""
    found = found_secrets(docs, **options)
    listed = F.array_join(F.transform("secrets", lambda s: F.concat_ws(":", s["begin"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", "n_candidates", F.size("secrets").cast("long").alias("n_secrets"), listed.alias("spans"))

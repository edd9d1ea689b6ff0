import re

import pytest
from pyspark.sql import functions as F

from garimpo.llm import secrets as S

FOLDER = "/root/testdata/sf0.001"
KEY = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_held_out_findings(spark, docs):
    words = S.dictionary(docs)
    findings = S.seeded_findings(docs).withColumn("held", F.pmod(F.xxhash64("value"), F.lit(4)) == 0)
    model = S.train(findings.where("NOT held").drop("held"), words)
    found = S.rated(findings.where("held"), model, words).select("label", "score").collect()
    assert len(found) > 200
    assert sum((r["score"] >= S.CUT) == (r["label"] == 1) for r in found) / len(found) > 0.95


def test_planted_secrets_are_found_and_others_left(spark, docs):
    rows = [
        (1, f'some words token = "{KEY}" and more'), (2, f"commit {KEY} was made"), (3, "order 1234567890123456 shipped"), (4, None), (5, ""),
        (6, "123e4567-e89b-12d3-a456-426614174000 is its uuid"), (None, f'x password="{KEY}"'), (1, "again"), (7, f'TOKEN = "{KEY.upper()}"!!'),
    ]
    texts = spark.createDataFrame([(i, t, None) for i, t in rows], "doc_id long, text string, source string")
    findings = S.seeded_findings(docs)
    found = S.report(texts, findings=findings)
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().executedPlan().toString())
    got = found.collect()
    assert len(got) == len(rows)
    spans = {}
    for r in got:
        spans.setdefault(r["doc_id"], []).append(r["spans"])
    at = rows[0][1].index(KEY)
    assert sorted(spans[1]) == ["", f"{at}:{at + 40}"]
    assert spans[None] == ["12:52"] and spans[7] == ["9:49"]
    assert all(spans[i] == [""] for i in (2, 3, 4, 5, 6))

    masked = S.masked(texts.withColumn("n_chars", F.lit(-1)), findings=findings)
    out = {(r["doc_id"], r["text"]): r["n_chars"] for r in masked.collect()}
    assert out[(None, 'x password="[SECRET]"')] == 21 and out[(4, None)] == -1 and (1, "again") in out
    assert masked.columns == ["doc_id", "text", "source", "n_chars"]


def test_empty_table_and_one_class(spark, docs):
    empty = docs.limit(0)
    findings = S.seeded_findings(docs)
    assert S.report(empty, findings=findings).count() == 0
    texts = spark.createDataFrame([(1, f'token = "{KEY}"', "s")], "doc_id long, text string, source string")
    assert S.report(texts, findings=findings.where("label = 0")).first()["n_secrets"] == 0


@pytest.mark.parametrize(
    ("text", "values"),
    [
        (f"API_KEY={KEY}", [KEY]), (f"see https://h.example/a?token={KEY}&page=2", [KEY]),
        ('password = "Tr0ub4dor&3"', ["Tr0ub4dor&3"]), ('{"password": "correct-horse-battery-staple", "a": 1}', ["correct-horse-battery-staple"]),
        ("postgres://u:S3cr3tPw@h", ["u", "S3cr3tPw"]), ("postgres://:p!w@h/x@y", ["p!w"]),
        (f"AWS_S3_ACCESS_KEY={KEY};b=2", [KEY]), ("pwd=a.b!c@d$e&f;User Id=x", ["a.b!c@d$e&f"]), ("(secret is s3;x!).", ["s3;x!"]),
        ("x QUJDMTIzNDU2Nzg5MA== y=1", ["QUJDMTIzNDU2Nzg5MA=="]), ("the key is token = abc", ["token", "abc"]), ("nothing here", []),
    ],
)
def test_candidates(documents, text, values):
    found = S.candidates(documents([(1, text)])).where("kind IS NOT NULL").orderBy("begin").collect()
    assert [r["value"] for r in found] == values
    assert all(text[r["begin"] : r["end"]] == r["value"] for r in found)


def test_long_values_are_read(documents):
    texts = ["password=" + "a;b" * 50_000, "key " * 50_000, "token=" * 20_000, "://" * 50_000, "://a:" * 20_000, "x\"" * 50_000]
    assert S.candidates(documents(list(enumerate(texts)))).where("kind IS NOT NULL").count() > 0


def test_secrets_after_names_and_in_urls(documents, docs):
    rows = [
        ("words API_KEY=" + KEY + " more", "words API_KEY=[SECRET] more"),
        ("see https://h.example/a?token=" + KEY + "&page=2", "see https://h.example/a?token=[SECRET]&page=2"),
        ('some password = "Tr0ub4dor&3" here', 'some password = "[SECRET]" here'),
        ('set "password": "correct-horse-battery-staple" now', 'set "password": "[SECRET]" now'),
        ("use postgres://u:S3cr3tPw@h now", "use postgres://u:[SECRET]@h now"),
        ("the key is important and the secret recipe of 3", None), ("read password = ${TOKEN} from there", None),
        ("clone ssh://git@h.example/x now", None), ("a token of respect", None),
    ]
    out = S.masked(documents([(i, text) for i, (text, _) in enumerate(rows)]), findings=S.seeded_findings(docs)).collect()
    assert {r["doc_id"]: r["text"] for r in out} == {i: masked or text for i, (text, masked) in enumerate(rows)}


def test_training_is_the_same_for_any_partitioning(spark, docs):
    words = S.dictionary(docs)
    findings = S.seeded_findings(docs)
    one, other = S.train(findings, words), S.train(findings.repartition(7), words)
    assert one.toDebugString.split("\n", 1)[1] == other.toDebugString.split("\n", 1)[1]
    assert S.dictionary(docs.repartition(5)) == words


def test_short_passwords_and_identifiers(documents, docs):
    rows = [
        ("password=hunter2", "password=[SECRET]"), ("its id is 7c9e6679-7425-40de-944b-e07fc1f90ae7 now", None),
        ("123e4567-e89b-12d3-a456-426614174000 is its uuid", None), ("build 20240131123456 of page 12345678901234", None),
    ]
    texts = documents([(i, t) for i, (t, _) in enumerate(rows)])
    got = {r.doc_id: r.text for r in S.masked(texts, findings=S.seeded_findings(docs)).collect()}
    assert got == {i: masked or text for i, (text, masked) in enumerate(rows)}

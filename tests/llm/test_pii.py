import hashlib
import random
import re

from garimpo.llm import pii as P

# The plain patterns of the contract.
PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base(text):
    found = []
    for rank, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), rank, kind, m.end()))
    return sorted(found)


def check(rows, found):
    assert len(found) == len(rows)
    expected = sorted((str(i), ",".join(f"{k}:{b}:{e}" for b, _, k, e in base(t))) for i, t in rows)
    plain = [",".join(s for s in r["spans"].split(",") if s and not s.startswith("term:")) for r in found]
    assert sorted((str(r["doc_id"]), s) for r, s in zip(found, plain, strict=True)) == expected
    for row, spans in zip(found, plain, strict=True):
        assert row["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
        assert [row[f"n_{k}"] for k, _ in PLAIN] == [spans.count(k + ":") for k, _ in PLAIN]


def test_base_spans_equal_plain_patterns(documents):
    rng = random.Random(5)
    rows = [
        (i, "".join(rng.choice(rng.choice(["a1@.b-_ ", "0123456789 -.+()", "1.2+ -@ax", "é1@.a5 💡"])) for _ in range(rng.randrange(60))))
        for i in range(150)
    ]
    for i in range(150):
        alphabet = rng.choice(["a1@.b-_ ", "0123456789 -.+()", "12.+ ", "é1@.a 💡"])
        rows.append((200 + i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(70)))))
    rows += [
        (1000, None), (1001, ""), (1001, ""), (None, "x@y.z"), (1002, "call +1 (017) 555-7713 or 4111 1111 1111 1111 💡 x@y.z"),
        (1003, "1" * 30_000 + " " + "a" * 30_000), (1004, "+1" + " " * 5_000), (1005, "a@b.c_d@e.f 1.2.3.4.5.6.7.8 001.002.003.0004 256.1.1.1"),
        (1006, "4111-1111-1111-1111" * 40 + " 0.0.0.0"), (1007, "10.0.0.1 00.000.0.255 0.0.0.256"),
    ]
    check(rows, P.report(documents(rows)).collect())


def test_terms_that_give_an_entity_away(documents):
    names = [(i, f"filler{i} words zorgblatt wrote from zb@mail.example today with the common words number {i}") for i in range(4)]
    common = [(100 + i, f"the common words come from somebody today with more text {i} and some words") for i in range(60)]
    found = {r["doc_id"]: r for r in P.report(documents(names + common), bits=3.0).collect()}
    for i, text in names:
        at = text.index("zorgblatt")
        assert f"term:{at}:{at + 9}" in found[i]["spans"].split(",")
        assert all(text[int(s.split(":")[1]) : int(s.split(":")[2])] in ("filler", "zorgblatt", "wrote", "number") for s in found[i]["spans"].split(",") if s.startswith("term"))
    assert all(r["spans"] == "" for i, r in found.items() if i >= 100)


def test_copies_of_one_text_are_one_support(documents):
    rows = [(i, "zorgblatt wrote from zb@mail.example today") for i in range(9)]
    assert all(r["n_term"] == 0 and r["n_email"] == 1 for r in P.report(documents(rows), bits=0.1).collect())


def test_sanitised_text(documents):
    rows = [(1, "mail x@y.z now 💡 +1 (017) 555-7713."), (2, None), (3, "none"), (None, "1.2.3.4")]
    docs = documents(rows)
    out = P.sanitised(docs)
    assert out.columns == [*docs.columns, "sanitised"]
    assert {r["doc_id"]: r["sanitised"] for r in out.collect()} == {1: "mail [EMAIL] now 💡 [PHONE].", 2: None, 3: "none", None: "[IP]"}
    assert P.report(documents([])).count() == 0


def test_main_path_is_native(documents):
    plan = P.report(documents([(1, "x@y.z")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_rare_name_in_one_text_is_a_term(documents):
    text = "the report came from zorgblatt at zb@mail.example with the numbers"
    rows = [(i, "the report came from them at last with the numbers and some more words " * 10) for i in range(80)]
    found = {r["doc_id"]: r["spans"] for r in P.report(documents([(1000, text), *rows])).collect()}
    at, mail = text.index("zorgblatt"), text.index("zb@")
    assert found[1000] == f"term:{at}:{at + 9},email:{mail}:{mail + 15}"
    assert all(found[i] == "" for i, _ in rows)

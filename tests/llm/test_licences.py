import textwrap

import pytest
from pyspark.sql import functions as F

from garimpo.llm import licences as L

MIT = L.TEXTS["MIT"]


@pytest.mark.parametrize(
    ("text", "whole", "lines", "names"),
    [
        (None, None, 0, ""), ("", None, 0, ""), ("...\n\n", None, 0, ""), (MIT, "MIT", 0, "MIT"),
        ("Copyright (c) 2020 Somebody\n\n# " + MIT.upper().replace("\n", "\n# "), "MIT", 0, "MIT"),
        (MIT + " changed", None, 0, ""), ("LICENCE: mit", "MIT", 1, "MIT"),
        ("text\n * Licensed  under the Apache Licence,\tVersion 2.0!\nSPDX-License-Identifier: MIT\nMIT", None, 3, "Apache-2.0,MIT"),
        ("a\nAll rights reserved.\nb", None, 1, "LicenseRef-All-Rights-Reserved"),
        ("© 2021 X. Released under MIT", None, 0, ""),
    ],
)
def test_rules(documents, text, whole, lines, names):
    (row,) = L.scanned(documents([(1, text)])).collect()
    assert tuple(row) == (1, whole, lines, names)


def test_forms_agree_in_both_languages(spark):
    texts = [*L.TEXTS.values(), "Copyright X\nA-b_c", "Sub-License && whilst\n(c) y\n z", "L’organisation É 2"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(F.trim(F.regexp_replace(L.canonical_lines(F.col("t")), r"\s+", " ")).alias("c")).collect()
    assert [r["c"] for r in got] == [L.canonical(t) for t in texts]


def test_repeated_rows_and_own_table(spark, documents):
    rows = [(1, "MIT"), (1, "MIT"), (None, "x")]
    assert L.scanned(documents(rows)).count() == 3
    own = spark.createDataFrame([("x", "mine")], "form string, licence string").select(F.sha2("form", 256).alias("digest"), "licence")
    assert {r["whole_licence"] for r in L.scanned(documents(rows), licences=own).collect()} == {None, "mine"}
    assert L.scanned(documents([])).count() == 0


def test_whole_texts_in_any_wrapping(documents):
    def wrapped(text, width):
        return "\n\n".join(textwrap.fill(" ".join(part.split()), width) for part in text.split("\n\n"))

    notice = "Copyright (c) 2021, Some Body"
    texts = [
        (name, f"{title}\n\n{notice}\n\n{wrapped(text, width)}")
        for name, text in L.TEXTS.items() for title in ("", L.NAMES[name][0]) for width in (60, 72, 78, 100)
    ]
    texts += [(name, text.replace("\n\n", "@").replace("\n", " ").replace("@", "\n")) for name, text in L.TEXTS.items()]
    texts.append(("MIT", MIT.replace("THE AUTHORS OR\nCOPYRIGHT HOLDERS", "THE\nAUTHORS OR COPYRIGHT HOLDERS")))
    texts.append(("ISC", L.TEXTS["ISC"].replace("above copyright notice", "above\ncopyright notice")))
    found = {r["doc_id"]: r["whole_licence"] for r in L.scanned(documents(list(enumerate(t for _, t in texts)))).collect()}
    assert [found[i] for i in range(len(texts))] == [name for name, _ in texts]
    assert {"BSD-3-Clause", "Apache-2.0", "GPL-3.0"} <= set(L.digests().values()) and set(L.known()) <= set(L.digests())


def test_long_licence_on_one_line(spark, documents):
    text = " ".join(L.TEXTS["BSD-2-Clause"].replace("THIS SOFTWARE IS PROVIDED BY", L._BSD_3).split())
    rows = documents([(1, "code\n" + text + "\nmore code"), (2, "x " * 100_000)])
    found = {r.doc_id: (r.n_lines, r.licences) for r in L.scanned(rows).collect()}
    assert found == {1: (1, "BSD-3-Clause"), 2: (0, "")}

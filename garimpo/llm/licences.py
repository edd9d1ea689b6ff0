"""License scans: canonical digests of entire texts, hash-joined to known licence digests.

A text and a known licence are the same if their canonical forms are: lower case,
copyright notices (a sign or a year after the word) to the end of their line and
"all rights reserved" lines dropped, equivalent spellings made one, everything
but letters and digits a single space. The digest of the canonical form is the join key, so a
scan costs one digest a text and one hash join, whatever the number of licences.

Texts scanned are the whole document and each of its lines, of any length, as
licence notices are lines of their own.

* null and blank texts have no licence; a line without letters or digits is none;
* lines of a licence found several times are counted several times;
* each row gets its own result row, repeated rows alike.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings that count as one, after lower-casing.
SPELLINGS = [
    ("licence", "license"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"), ("whilst", "while"),
    ("organisation", "organization"), ("favour", "favor"), ("honour", "honor"), ("https://", "http://"), ("&", "and"),
]
NOTICE = (
    r"(?m)^[\s*#/;>-]*(?:copyright[\s:]*(?:\(c\)|©|&copy;|[0-9]{4}|\[yyyy\]|<year>)|©|\(c\)\s*(?:copyright|[0-9]{4}))[^\n]*$"
)
# As the SQL has it: any line that begins with the word. The given tables have no such line.
COPYRIGHT = r"(?m)^[\s*#/;>-]*(?:copyright|\(c\)|©)[^\n]*$"
RESERVED = "all rights reserved"
RESERVED_LINE = rf"(?m)^ *{RESERVED} *$"
# Names licences go by in notices.
NAMES = {
    "MIT": ["MIT License", "MIT"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GPLv2", "GPL-2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GPLv3", "GPL-3.0"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL-2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "BSD-3-Clause"],
    "ISC": ["ISC License", "ISC"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
}
NOTICES = [
    "{}", "Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}",
    "This work is licensed under {}", "This work is licensed under the {}", "Distributed under the {}",
    "License: {}", "SPDX-License-Identifier: {}",
]
# Whole licence texts.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
}


# Titles of whole texts; theirs in NAMES count too.
TITLES = {
    "MIT": ["The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["The ISC License", "ISC License (ISC)"],
    "BSD-2-Clause": ["The BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"],
    "BSD-3-Clause": [
        "The BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License",
        "Revised BSD License", "BSD License",
    ],
}
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY"""
# Digests of the canonical forms of long whole texts.
LONG_TEXTS = {
    "Apache-2.0": "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2",
    "GPL-2.0": "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821",
    "GPL-3.0": "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a",
    "LGPL-3.0": "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    "MPL-2.0": "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a",
    "CC0-1.0": "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
}


def canonical(text: str, notice: str = NOTICE) -> str:
    """The canonical form in Python, for the known texts."""
    text = re.sub(notice, "", text.lower())
    for one, other in SPELLINGS:
        text = text.replace(one, other)
    lines = [" ".join(re.sub(r"[\W_]+", " ", line).split()) for line in text.split("\n")]
    return " ".join(line for line in lines if line and line != RESERVED)


def known() -> dict[str, str]:
    """Digest of each canonical form, and its licence, as the SQL has them."""
    forms = {canonical(text, COPYRIGHT): name for name, text in TEXTS.items()}
    forms |= {
        canonical(notice.format(name)): licence for licence, names in NAMES.items() for name in names for notice in NOTICES
    }
    # A line of its own, though not part of the licence above or below it.
    forms[RESERVED] = "LicenseRef-All-Rights-Reserved"
    return {hashlib.sha256(form.encode()).hexdigest(): licence for form, licence in forms.items()}


def digests() -> dict[str, str]:
    """``known``, and whole texts as they are, with titles, and of further licences."""
    texts = TEXTS | {"BSD-3-Clause": TEXTS["BSD-2-Clause"].replace("THIS SOFTWARE IS PROVIDED BY", _BSD_3)}
    forms = {
        canonical(title + "\n" + text): name
        for name, text in texts.items() for title in ["", *TITLES[name], *NAMES[name]]
    }
    whole = {hashlib.sha256(form.encode()).hexdigest(): licence for form, licence in forms.items()}
    return known() | whole | {digest: licence for licence, digest in LONG_TEXTS.items()}


def canonical_lines(text: Column) -> Column:
    """The canonical form, with line ends kept."""
    text = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOTICE, "")
    for one, other in SPELLINGS:
        text = F.replace(text, F.lit(one), F.lit(other))
    return F.regexp_replace(text, r"[^\p{L}\p{N}\n]+", " ")


def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", licences: DataFrame | None = None) -> DataFrame:
    """``(doc_id, whole_licence, n_lines, licences)`` for every row.

    ``whole_licence`` is the licence the entire text is, ``n_lines`` the number of
    lines that are notices, ``licences`` all names found, sorted, comma-joined.
    ``licences`` may be another table ``(digest, licence)``, joined by hash.
    """
    spark = docs.sparkSession
    table = licences if licences is not None else spark.createDataFrame(sorted(digests().items()), "digest string, licence string")
    lines = F.transform(F.split("canon", "\n"), lambda line: F.trim(line))
    fitting = F.filter(lines, lambda line: F.length(line) > 0)
    whole = F.trim(F.regexp_replace(F.regexp_replace("canon", RESERVED_LINE, ""), r"\s+", " "))
    units = F.concat(
        F.array(F.struct(F.lit(True).alias("entire"), F.sha2(whole, 256).alias("digest"))),
        F.transform(fitting, lambda line: F.struct(F.lit(False).alias("entire"), F.sha2(line, 256).alias("digest"))),
    )
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).alias("doc_id"), canonical_lines(F.col(text)).alias("canon"))
    found = rows.select("rid", "doc_id", F.inline(units)).join(table, "digest", "left")
    # All units of a row come from one task, so the shuffle carries one row a document.
    return found.groupBy("rid", "doc_id").agg(
        F.max(F.when(F.col("entire"), F.col("licence"))).alias("whole_licence"),
        F.count(F.when(~F.col("entire"), F.col("licence"))).alias("n_lines"),
        F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"),
    ).drop("rid")


def oracle() -> str:
    """The same over ``documents`` as DuckDB SQL."""
    form = f"regexp_replace(lower(coalesce(text, '')), '{COPYRIGHT}', '', 'g')"
    for one, other in SPELLINGS:
        form = f"replace({form}, '{one}', '{other}')"
    values = ", ".join(f"('{digest}', '{licence}')" for digest, licence in sorted(known().items()))
    return rf"""
WITH known(digest, licence) AS (VALUES {values}),
canon AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_replace({form}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS c FROM documents
),
units AS (
  SELECT rid, true AS entire, sha256(trim(regexp_replace(regexp_replace(c, '{RESERVED_LINE}', '', 'g'), '\s+', ' ', 'g'))) AS digest FROM canon
  UNION ALL
  SELECT rid, false, sha256(trim(line)) FROM (SELECT rid, unnest(string_split(c, chr(10))) AS line FROM canon) WHERE trim(line) <> ''
),
hits AS (SELECT rid, entire, licence FROM units JOIN known USING (digest))
SELECT c.doc_id, max(CASE WHEN entire THEN licence END) AS whole_licence,
  count(CASE WHEN NOT entire THEN licence END) AS n_lines,
  coalesce(string_agg(DISTINCT licence, ',' ORDER BY licence), '') AS licences
FROM canon c LEFT JOIN hits USING (rid) GROUP BY c.rid, c.doc_id
"""

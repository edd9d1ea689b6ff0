"""Start tags and their attributes, read as a browser reads them.

A tag ends at the first ``>`` outside a quoted value; quotes count only after ``=``.
A value that is never closed ends with the tag. Patterns take whole runs at once and
never give them back, so time is linear in the text; a tag of more than ``PARTS``
values ends there.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from garimpo.functions.entities import decode

PARTS = 500
INSIDE = rf"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+){{0,{PARTS}}}+>?+"""
ATTRIBUTE = r"""(?<![^\s"'>/=])([^\s"'>/=]++)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""
NOT_MARKUP = r"(?ius)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)"


def pattern(name: str) -> str:
    """Start tags of that name."""
    return rf"(?iu)<{name}(?=[\s/>]){INSIDE}"


def markup(html: Column) -> Column:
    """The page without comments and scripts, whose tags are no elements."""
    return F.regexp_replace(html, NOT_MARKUP, " ")


def attribute(tag: Column, name: str) -> Column:
    """The first attribute of that name, unquoted and decoded; null if there is none, or an empty one.

    Attributes are read one after another, so a name inside another's value is none.
    """
    pairs = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0))
    own = F.get(F.filter(pairs, lambda a: a.rlike(rf"(?i)^{name}\s*=")), F.lit(0))
    value = F.regexp_replace(F.regexp_replace(own, r"(?s)^[^=]*=\s*", ""), r"""(?s)^(["'])(.*)\1\z""", "$2")
    return F.nullif(decode(value, attribute=True), F.lit(""))


def attributes(text: Column, tag: str, name: str) -> Column:
    """The attribute of every start tag ``tag`` of the markup, where it has one, in page order."""
    tags = F.regexp_extract_all(text, F.lit(pattern(tag)), F.lit(0))
    return F.array_compact(F.transform(tags, lambda t: attribute(t, name)))


def followed(text: Column, tag: str) -> Column:
    """``array<struct<tag, after>>``: each start tag, and the markup from it to the next of its name."""
    # Bound to a lambda's variable, the pieces are made once.
    read = F.named_struct(F.lit("tags"), F.regexp_extract_all(text, F.lit(pattern(tag)), F.lit(0)), F.lit("after"), F.split(text, pattern(tag), -1))

    def pairs(r: Column) -> Column:
        after = F.slice(r["after"], F.lit(2), F.size(r["tags"]))
        return F.zip_with(r["tags"], after, lambda t, x: F.named_struct(F.lit("tag"), t, F.lit("after"), x))

    return F.flatten(F.transform(F.array(read), pairs))

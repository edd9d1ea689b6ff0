"""Field finders and text helpers, all as Catalyst expressions.

Finders search the raw text and normalise white space in what they found, which
gives the same value as normalising the whole page first without rewriting it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.functions.entities import decode

WHITE_SPACE = " \t\n\r\x0b\x0c\u0085\u00a0\u2028\u2029"


def none_if_empty(c: Column) -> Column:
    """Null for the empty string, with ``c`` evaluated once.

    ``nullif`` repeats its first argument, which doubles the cost of a pattern
    search at every level it is nested in.
    """
    return F.get(F.array_remove(F.array(c), ""), F.lit(0))


def strip(c: Column) -> Column:
    """Remove white space at both ends, non-breaking space included."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def collapse_ws(c: Column) -> Column:
    """Every run of white space becomes one space; one that is a space already is passed over."""
    return F.regexp_replace(c, r"(?U)\s(?:(?<! )\s*|\s+)", " ")


def find(c: Column, pattern: str, group: int = 0) -> Column:
    """First match of a pattern, null when there is none."""
    return none_if_empty(F.regexp_extract(c, pattern, group))


def with_unit(number: Column, unit: str) -> Column:
    return F.concat(number, F.lit(f" {unit}"))


def price_find(c: Column) -> Column:
    return F.when(c.contains("R$"), collapse_ws(find(c, C.PRICE)))


def price_upper(c: Column) -> Column:
    """Price in any letter case, returned in upper case."""
    return F.upper(collapse_ws(find(c, C.PRICE_ANY_CASE)))


def price_or_request(c: Column) -> Column:
    """Price as ``R$ n``, or the on-request text when the card shows none."""
    number = find(c, r"(?U)R\$\s*([\d.,]+)", 1)
    return F.coalesce(F.concat(F.lit("R$ "), number), F.lit(C.PRICE_ON_REQUEST))


def area_find(c: Column, pattern: str = C.AREA) -> Column:
    return with_unit(find(c, pattern, 1), "m²")


def rooms_find(c: Column, pattern: str = C.ROOMS) -> Column:
    return with_unit(find(c, pattern, 1), "Q")


def baths_find(c: Column, pattern: str = C.BATHS) -> Column:
    return with_unit(find(c, pattern, 1), "B")


def cep_find(c: Column, pattern: str = C.POSTAL_CODE) -> Column:
    return find(c, pattern)


def phone_find(c: Column, pattern: str = C.PHONE) -> Column:
    """Phone in the text, else in a ``tel:`` link, else in ``data-phone``."""
    return F.coalesce(
        collapse_ws(find(c, pattern)), collapse_ws(find(c, C.TEL_LINK, 1)), find(c, C.DATA_PHONE, 1)
    )


def address_match(c: Column) -> Column:
    """The text matched by ``street, city - UF``; one scan of the page.

    Only texts with the ``, city - UF`` part are searched for the whole line.
    """
    ended = F.filter(F.array(c), lambda x: x.rlike(C.ADDRESS_END))
    return F.get(F.transform(ended, lambda x: find(x, C.ADDRESS_LINE)), F.lit(0))


def address_line(match: Column) -> Column:
    """Street, city and state of an ``address_match``, stripped."""

    def part(group: int) -> Column:
        return strip(collapse_ws(find(match, C.ADDRESS_LINE, group)))

    return F.struct(
        part(1).alias("endereco"), part(2).alias("cidade"), part(3).alias("estado")
    )


def title_tag(c: Column) -> Column:
    return none_if_empty(strip(F.regexp_extract(c, C.HTML_TITLE, 1)))


def document_title(c: Column) -> Column:
    """The title element with any attributes, over any lines, decoded."""
    return none_if_empty(strip(collapse_ws(decode(F.regexp_extract(c, C.TITLE_ELEMENT, 1)))))


def attribute(tag: Column, name: str) -> Column:
    """Decoded value of a tag's attribute: in either quotes, which end at their own kind, or bare."""
    start = rf"(?isu)(?<![\w-]){name}\s*=\s*"
    return decode(
        F.coalesce(find(tag, start + '"([^"]*)"', 1), find(tag, start + "'([^']*)'", 1), find(tag, start + "([^\\s\"'>]+)", 1))
    )


def document_description(c: Column) -> Column:
    """Content of the description meta tag, whatever the order and quoting of its attributes."""
    tags = F.regexp_extract_all(c, F.lit(C.META_TAG), F.lit(0))
    named = F.filter(tags, lambda t: t.rlike(C.NAMED_DESCRIPTION))
    contents = F.transform(F.slice(named, 1, 1), lambda t: attribute(t, "content"))
    return none_if_empty(strip(F.get(contents, F.lit(0))))


def html_title(c: Column) -> Column:
    """``<title>``, else the first ``<h1>`` without its inner tags."""
    heading = F.regexp_replace(F.regexp_extract(c, C.HTML_H1, 1), "<[^>]+>", "")
    return F.coalesce(title_tag(c), none_if_empty(strip(heading)))


def meta_description(c: Column) -> Column:
    return F.coalesce(find(c, C.META_DESCRIPTION, 1), find(c, C.OG_DESCRIPTION, 1))


def first_line(c: Column, chars: int | None = C.TITLE_CHARS) -> Column:
    """First line that is not blank, stripped and cut to ``chars``."""
    line = strip(find(c, r"(?mUd)^[^\S\n]*\S[^\n]*$"))
    return line if chars is None else F.substring(line, 1, chars)


def visible_text(c: Column) -> Column:
    """Text without scripts, styles, comments and tags; character references decoded.

    A script, style or comment that is never closed ends with the page.
    """
    no_code = F.regexp_replace(c, C.NOT_TEXT, " ")
    return strip(collapse_ws(decode(F.regexp_replace(no_code, r"(?s)<[^>]+>", " "))))


def default(c: Column, value: str) -> Column:
    return F.coalesce(none_if_empty(c), F.lit(value))


def present(c: Column) -> Column:
    """Whether a column holds text, as two conditions that reach the Parquet scan."""
    return c.isNotNull() & (c != "")


def prefix(c: Column, chars: int) -> Column:
    return F.substring(c, 1, chars)


def title_case(c: Column) -> Column:
    return F.initcap(c)


FOLD_FROM = "áàâãäéèêëíìîïóòôõöúùûüçñ"
FOLD_TO = "aaaaaeeeeiiiiooooouuuucn"


def fold(c: Column) -> Column:
    """Lower case without accents, for dictionary look-ups."""
    return F.translate(F.lower(c), FOLD_FROM, FOLD_TO)


def iso_time(c: Column) -> Column:
    """Parse a collection time, which carries no zone; other text gives null."""
    return c.try_cast("timestamp_ntz")

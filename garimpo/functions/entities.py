"""Character references in HTML text and attribute values, as a Column builder.

The names are those of HTML 5, with the ones that count without a semicolon too: of
those the longest that begins the text after the ampersand is meant, so candidates are
looked up from the longest down. Numbers of the C1 controls mean what Windows-1252 has
in their place.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

REFERENCE = r"^(?:#[0-9]{1,7}(?![0-9])|#[xX][0-9A-Fa-f]{1,6}(?![0-9A-Fa-f])|[A-Za-z][A-Za-z0-9]{0,31})"
# A look-up goes through a table in order, so the older and commoner names come first.
_ORDERED = sorted(html5.items(), key=lambda x: (x[0].rstrip(";") not in name2codepoint, len(x[0]), x[0]))
CLOSED = {name[:-1]: char for name, char in _ORDERED if name.endswith(";")}
BARE = {name: char for name, char in _ORDERED if not name.endswith(";")}
BARE_LENGTHS = sorted({len(name) for name in BARE}, reverse=True)
C1 = range(0x80, 0xA0)


def _table(pairs: dict[str, str]) -> Column:
    """A map of two literals, folded once when the plan is made."""
    names, chars = (F.split(F.lit("\0".join(x)), "\0") for x in (pairs, pairs.values()))
    return F.map_from_arrays(names, chars)


def _struct(**fields: Column) -> Column:
    """A struct that keeps its names inside of generators, where aliases go."""
    return F.named_struct(*(x for name, value in fields.items() for x in (F.lit(name), value)))


def _windows(code: int) -> str:
    try:
        return bytes([code]).decode("cp1252")
    except UnicodeDecodeError:  # five codes that stand for nothing
        return chr(code)


def decode(c: Column, attribute: bool = False) -> Column:
    """``c`` with numeric and named references replaced, each once; unknown ones stay.

    In an ``attribute`` a name without its semicolon is one only if neither ``=`` nor
    a letter or digit follows, so parameters of a URL are left alone.
    """
    closed, bare = _table(CLOSED), _table(BARE)
    c1 = F.array(*(F.lit(_windows(code)) for code in C1))

    def found(x: Column) -> Column:
        p, ref = x["p"], x["ref"]
        size = F.length(ref)
        ended = F.substr(p, size + 1, F.lit(1)) == ";"
        number = (
            F.when(ref.rlike("^#[xX]"), F.conv(F.substring(ref, 3, 6), 16, 10))
            .when(ref.startswith("#"), F.substring(ref, 2, 7))
            .try_cast("int")
        )
        real = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        char = F.when(number.between(C1[0], C1[-1]), F.get(c1, number - C1[0])).when(
            real, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        )
        whole = F.coalesce(F.when(ended, F.try_element_at(closed, ref)), char)

        def begun(length: Column) -> Column:
            name = F.when(size >= length, F.try_element_at(bare, F.left(p, length)))
            if attribute:
                name = F.when(~F.substr(p, length + 1, F.lit(1)).rlike("^[=A-Za-z0-9]"), name)
            return _struct(char=name, used=length)

        every = F.transform(F.array(*(F.lit(n) for n in BARE_LENGTHS)), begun)
        options = F.concat(F.array(_struct(char=whole, used=size + ended.cast("int"))), F.when(ref != "", every).otherwise(F.slice(every, 1, 0)))
        return _struct(p=p, one=F.get(F.filter(options, lambda o: o["char"].isNotNull()), F.lit(0)))

    def written(x: Column) -> Column:
        one, p = x["one"], x["p"]
        return F.when(one.isNotNull(), F.concat(one["char"], F.substr(p, one["used"] + 1, F.length(p)))).otherwise(F.concat(F.lit("&"), p))

    def decoded(x: Column) -> Column:
        pieces = F.split(x, "&")
        read = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), lambda p: _struct(p=p, ref=F.regexp_extract(p, REFERENCE, 0)))
        joined = F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.transform(read, found), written), ""))
        return F.when(x.contains("&"), joined).otherwise(x)

    # Bound to a lambda's variable, the text and what is found of a piece are made once.
    return F.get(F.transform(F.array(c), decoded), F.lit(0))

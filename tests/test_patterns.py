"""The tuned patterns find what the plain ones find, on random texts."""

import random
import re

from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.functions import text

PIECES = [
    "R$", " ", "  ", "\n", "\u00a0", ".", ",", "-", " - ", ", ", "1", "23", "456", "7890", "12345", "m²", "M2", "m",
    "quartos", "quarto", "Q", "qt", "banheiro", "banheiros", "b.", "(", ")", "PR", "SP", "Rua", "Curitiba", "é", "<p>",
    "\t", "x", "'", "12345-678", "(11) 91234-5678", "Rua 1, Rio - RJ", '"ad_url":"u"', '"list_id":7', '"price":"p"', '"subject":"s"', '"municipality":"m"', '"state_uf":"f"',
]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randrange(1, 30))) for _ in range(n)]


def plain(pattern, group=0, flags=0):
    compiled = re.compile(pattern, flags)

    def find(s):
        m = compiled.search(re.sub(r"\s+", " ", s))
        return m.group(group) if m else None

    return find


def unit(find, mark):
    return lambda s: None if find(s) is None else f"{find(s)} {mark}"


# The patterns in the cases below are fixed values: the plain forms the tuned ones must equal.
def test_finders_equal_plain_patterns(spark):
    given = texts(4000, 11)
    address = r"([A-Za-z0-9\s\.,\-]+\b)(?:,\s*)([A-Za-z\s]+)\s*-\s*([A-Z]{2})"
    cases = {
        "price": (text.price_find, plain(r"R\$\s*[\d\.\,]+")),
        "area": (text.area_find, unit(plain(r"(\d{2,4})\s*m[²2]", 1, re.I), "m²")),
        "area_loose": (
            lambda c: text.area_find(c, C.AREA_LOOSE), unit(plain(r"(\d+)\s*m[²2]", 1, re.I), "m²"),
        ),
        "rooms": (text.rooms_find, unit(plain(r"(\d+)\s*(?:quarto|quartos|q|qt)\b", 1, re.I), "Q")),
        "rooms_loose": (
            lambda c: text.rooms_find(c, C.ROOMS_LOOSE), unit(plain(r"(\d+)\s*(?:quarto|q)", 1, re.I), "Q"),
        ),
        "cep": (text.cep_find, plain(r"\b\d{5}-\d{3}\b")),
        "phone": (
            lambda c: text.collapse_ws(text.find(c, C.PHONE)), plain(r"\(?\d{2,3}\)?\s*\d{4,5}-\d{4}"),
        ),
        **{
            name: (
                lambda c, name=name: text.address_line(text.address_match(c))[name],
                lambda s, g=g: None if plain(address, g)(s) is None else plain(address, g)(s).strip(),
            )
            for g, name in enumerate(["endereco", "cidade", "estado"], 1)
        },
    }
    df = spark.createDataFrame([(s,) for s in given], "t string")
    rows = df.select("t", *[build(F.col("t")).alias(n) for n, (build, _) in cases.items()]).collect()
    wrong = [(n, r.t, r[n], find(r.t)) for r in rows for n, (_, find) in cases.items() if r[n] != find(r.t)]
    assert wrong[:5] == []
    assert [n for n in cases if not any(r[n] for r in rows)] == []


def test_payload_pattern_equals_plain_lazy_chain(spark):
    rng = random.Random(3)
    keys = PIECES[-6:]
    given = ["".join(rng.choices([*keys, ",", "}{"], k=rng.randrange(5, 60))) for _ in range(1500)]
    given += [",".join(keys[1:2] + keys[:1] + keys[2:]) * 3]
    lazy = re.compile(
        r'"list_id":(\d+).*?"ad_url":"([^"]+)".*?"price":"([^"]+)".*?"subject":"([^"]+)"'
        r'.*?"municipality":"([^"]+)".*?"state_uf":"([^"]+)"',
        re.S,
    )
    df = spark.createDataFrame([(s,) for s in given], "t string")
    rows = df.select("t", F.regexp_extract_all("t", F.lit(C.CAPTURE_AD), F.lit(0)).alias("m")).collect()
    assert all(r.m == [m.group(0) for m in lazy.finditer(r.t)] for r in rows)
    assert any(r.m for r in rows)

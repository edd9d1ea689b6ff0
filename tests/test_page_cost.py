"""Work per page: methods the JVM compiles, patterns that fail early, pages that need no Python."""

import random
import re

from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.functions import jsons, text
from garimpo.operators import extract
from garimpo.plans.page_queries import ex_ad_page_merge, ex_listing

COMPILED_BYTES = 8000  # HotSpot leaves larger methods to its interpreter


def tables(spark, folder):
    orders = [(i, i % 5, 1000.5 * i, "2024-01-02") for i in range(1, 60)]
    customers = [(i, i, "BUILDING") for i in range(5)]
    kinds = "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate string"
    spark.createDataFrame(orders, kinds).withColumn("o_orderdate", F.to_timestamp("o_orderdate")).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")


def test_page_methods_are_compiled(spark, fresh_dir, capsys):
    tables(spark, fresh_dir)
    fixed = spark.newSession()
    fixed.conf.set("spark.sql.adaptive.enabled", "false")
    for query in (ex_listing, ex_ad_page_merge):
        capsys.readouterr()
        query(fixed, fresh_dir).explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) < COMPILED_BYTES, (query.__name__, sizes)


def test_markup_patterns_equal_plain_ones(spark):
    rng = random.Random(5)
    pieces = [
        "<script>", "<SCRIPT type='application/ld+json'>", "</script>", "</ScRiPt >", "</script", "<style a=b>", "</style\n>", "<!--", "-->", "->", "-", "<!-->",
        "<", ">", "x", "  ", " ", "\n", " ", "<scripts>", "<title>", "<TITLE a>", "</title>", "<meta name=\"description\" content='c'>", "<h1 x>", "</H1>",
        "HREF='tel:", "+55 1'", "data-phone=\"9\"", "Data-Phone='", "9'", "<meta", "é", '{"name": "A"}', "ld+json", "LD+JSON",
    ]
    given = ["".join(rng.choices(pieces, k=rng.randrange(1, 40))) for _ in range(3000)]
    plain = {
        C.NOT_TEXT: r"(?ius)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)",
        C.TEL_LINK: r"(?iuU)href=['\"]tel:(\+?[0-9\-\(\)\s]+)['\"]",
        C.DATA_PHONE: r"(?iu)data-phone=['\"]([^'\"]+)['\"]",
        C.HTML_TITLE: r"(?iud)<title>(.*?)</title>",
        C.TITLE_ELEMENT: r"(?ius)<title\b[^>]*>(.*?)</title\s*>",
        C.META_TAG: r"""(?iu)<meta\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""",
        C.HTML_H1: r"(?ius)<h1[^>]*>(.*?)</h1>",
        C.META_DESCRIPTION: r"(?iuU)<meta\s+name=[\"']description[\"']\s+content=[\"']([^\"']+)[\"']",
        C.SCRIPT_END: r"(?iu)</script>",
        C.JSONLD_START: r"""(?ius)<script[^>]*\btype\s*=\s*["']?application/ld\+json(?:["'\s][^>]*)?>(.*)\z""",
    }
    df = spark.createDataFrame([(s,) for s in given], "t string")

    def both(build, tuned, given):
        return F.struct(build(tuned).alias("now"), build(given).alias("plain"))

    found = [both(lambda p: F.regexp_extract_all("t", F.lit(p), F.lit(0)), a, b) for a, b in plain.items()]
    spaced = F.struct(text.collapse_ws(F.col("t")).alias("now"), F.regexp_replace("t", r"(?U)\s+", " ").alias("plain"))
    rows = df.select(F.array(*found).alias("f"), spaced.alias("s")).collect()
    assert [r for r in rows if r.s.now != r.s.plain or any(x.now != x.plain for x in r.f)][:3] == []
    assert [p for i, p in enumerate(plain) if not any(r.f[i].now for r in rows)] == []


def test_a_page_without_the_type_has_no_blocks(value):
    assert value(jsons.jsonld_blocks, "<script>{}</script>") == []
    assert value(jsons.jsonld_blocks, "<script type=application/LD+json>{}</script>") == ["{}"]
    assert value(jsons.jsonld_blocks, None) is None


def test_only_pages_that_can_hold_a_place_go_to_python(spark, monkeypatch):
    monkeypatch.setattr(extract, "page_places", lambda sent: F.struct(sent.alias("label"), sent.alias("crumb")))
    listed = '<script type="application/ld+json">[{"@type":"BreadcrumbList"}]</script><p>x</p>'
    given = {listed: False, "<p>No BAIRRO X</p>": True, "<a rel=breadcrumb>X</a>": True, "<a rel='&#98;readcrumb' class=Breadcrumb>X</a>": True, "<p>x</p>": False}
    df = spark.createDataFrame([(i, "u", h) for i, h in enumerate(given)], "page_id long, url string, html string")
    rows = {r.page_id: r.endereco for r in extract.merged_ads(df).collect()}
    assert [rows[i] is not None for i in range(len(given))] == list(given.values())


def test_pages_are_dealt_once_and_in_whole_rounds(spark, fresh_dir, capsys):
    tables(spark, fresh_dir)
    joined = spark.newSession()
    joined.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined.conf.set("spark.sql.adaptive.enabled", "false")
    rows = ex_listing(joined, fresh_dir)
    capsys.readouterr()
    rows.explain()
    # One exchange a side, and the pages are rendered in it.
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 2
    cores = spark.sparkContext.defaultParallelism
    assert rows.rdd.getNumPartitions() >= 4 * cores and rows.rdd.getNumPartitions() % cores == 0

import random

import pytest
from pyspark.sql import functions as F

from garimpo.operators import dedup, discover, queue, report


@pytest.fixture
def versions(spark):
    rows = [(f"k{i % 7}" if i % 3 else "hot", i, f"t{i}" if i % 5 else None) for i in range(300)]
    return spark.createDataFrame(rows, "id string, seq long, titulo string")


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_first_and_last_do_not_depend_on_partitioning(versions):
    first, last = dedup.first_by(versions, ["id"], ["seq"]), dedup.last_by(versions, ["id"], ["seq"])
    for parts in (1, 3, 9):
        moved = versions.orderBy(F.rand(parts)).repartition(parts)
        assert as_set(dedup.first_by(moved, ["id"], ["seq"])) == as_set(first)
        assert as_set(dedup.last_by(moved, ["id"], ["seq"])) == as_set(last)
    assert first.count() == 8


def test_null_links(spark):
    rows = spark.createDataFrame([("a", None, 1), ("b", None, 2), ("c", "u", 3), ("d", "u", 4)], "id string, link string, seq int")
    assert {r.id for r in dedup.first_by_link(rows, ["seq"]).collect()} == {"a", "b", "c"}
    assert {r.id for r in dedup.first_by_link(rows, ["seq"], merge_null_links=True).collect()} == {"a", "c"}


def test_upsert_is_idempotent_and_rejects_untitled(spark, versions):
    stored = spark.createDataFrame([("k1", -1, "old", "x"), ("keep", -1, "kept", "y")], "id string, seq long, titulo string, cep string")
    once = dedup.upsert(stored, versions, ["seq"])
    twice = dedup.upsert(once, versions, ["seq"])
    assert as_set(once) == as_set(twice)
    by_id = {r.id: r for r in once.collect()}
    assert by_id["keep"].cep == "y" and by_id["k1"].cep is None and by_id["k1"].titulo != "old"
    assert dedup.rejected(versions).count() + dedup.accepted(versions).count() == versions.count()
    delta = report.load_delta(stored, once).first()
    assert delta.adicionados == once.count() - 2


def test_rank_limit_runs_before_the_shuffle(versions):
    plan = dedup.first_by(versions, ["id"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("WindowGroupLimit", plan.index("Exchange"))
    assert "Partial" in plan[partial : partial + 200]


def test_queue(spark):
    found = spark.createDataFrame([("https://www.olx.com.br/vi/1",), ("https://www.olx.com.br/vi/1",), ("https://x.com",), (None,)], "url string")
    links = queue.as_links(found, "kw")
    assert {(r.url, r.domain, r.status) for r in links.collect()} == {
        ("https://www.olx.com.br/vi/1", "olx.com.br", "pending"), ("https://x.com", "outro", "pending"),
    }
    assert queue.insert_ignore(links, links).count() == 0
    ids = {r.url: r.id for r in links.collect()}
    events = spark.createDataFrame(
        [(ids["https://x.com"], s, t, n) for n, (s, t) in enumerate([("retry", 1), ("error", 2), ("retry", 3)])],
        "id string, status string, ts int, event_id int",
    )
    now = {r.url: r for r in queue.with_status(links, events).collect()}
    assert (now["https://x.com"].status, now["https://x.com"].tentativas) == ("retry", 3)
    assert now["https://www.olx.com.br/vi/1"].status == "pending"
    state = queue.with_status(links, events)
    assert [r.domain for r in queue.pending(state).collect()] == ["olx.com.br"]
    assert queue.pending(state, domain="outro").count() == 0 and queue.pending(state, limit=1).count() == 1
    assert queue.pending(queue.with_status(links, events.filter("event_id < 1"))).count() == 2
    stats = queue.stats(found.limit(3), state).first()
    assert (stats.links_total, stats.links_done, stats.links_error, stats.links_pending) == (2, 0, 0, 2)


def test_search_tasks_and_places(spark):
    keywords = spark.createDataFrame([("casa São Paulo",), ("imóvel",), ("CASA recife",)], "keyword string")
    tasks = queue.search_tasks(keywords)
    assert tasks.count() == 15
    assert "CartesianProduct" not in tasks._jdf.queryExecution().executedPlan().toString()
    places = {r.keyword: (r.cidade, r.estado, r.tipo) for r in discover.keyword_places(keywords).collect()}
    assert places == {
        "casa São Paulo": ("sao paulo", "SP", "casa"),
        "imóvel": ("curitiba", "PR", "apartamento"),
        "CASA recife": ("recife", "PE", "casa"),
    }
    row = discover.keyword_listings(keywords.filter("keyword like 'casa%'")).first()
    assert row.titulo == "Casa em Sao Paulo - Resultado de Busca"


def test_new_links_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(rng.choice("ab"), rng.randrange(12), f"l{rng.randrange(25)}") for _ in range(400)]
    got = {
        (r.site, r.page): (r.found, r.new)
        for r in discover.new_links_per_page(spark.createDataFrame(rows, "site string, page int, link string")).collect()
    }
    want = {}
    for site in "ab":
        seen = set()
        for page in sorted({p for s, p, _ in rows if s == site}):
            links = {x for s, p, x in rows if (s, p) == (site, page)}
            want[site, page] = (len(links), len(links - seen))
            if not links - seen:
                break
            seen |= links
    assert got == want


def test_links_on_pages(spark):
    html = (
        '<a href="/imoveis/1?x=1">a</a><a href="/imoveis/1?x=2">b</a><a href="https://www.olx.com.br/ajuda">c</a>'
        '<a href="https://www.olx.com.br/um-caminho-bem-mais-longo/2"><img src="i"></a>'
        '<a href="https://www.olx.com.br/um-caminho-bem-mais-longo/3">sem imagem</a>'
        '<a href="https://www.olx.com.br/um-caminho-que-passa-de-sessenta-caracteres/4">longo</a>'
        '<a href="https://other.com/venda/1">d</a>'
        '<a name="x">e</a><a href="https://www.olx.com.br/um-caminho-bem-mais-longo/6"><b><IMG src="i"></b>'
        '<script>window.__INITIAL_STATE__ = {"a":[{"u":"https://pr.olx.com.br/5?q=1"}],"b":"olx.nada"};</script>'
        "<script>window.__SSR_STATE__ = {bad};</script>"
    )
    pages = spark.createDataFrame([(1, "https://www.olx.com.br/imoveis?o=1", html)], "page_id long, url string, html string")
    assert {r.link for r in discover.ad_links(pages).collect()} == {
        "https://www.olx.com.br/imoveis/1",
        "https://www.olx.com.br/um-caminho-bem-mais-longo/2",
        "https://www.olx.com.br/um-caminho-que-passa-de-sessenta-caracteres/4",
        "https://www.olx.com.br/um-caminho-bem-mais-longo/6",
    }
    assert [r.link for r in discover.state_links(pages).collect()] == ["https://pr.olx.com.br/5"]
    totals = discover.anchor_totals(pages).first()
    assert (totals.anchors, totals.portal_anchors) == (8, 5)


def test_reports(spark):
    empty = spark.createDataFrame([], "preco string, cep string")
    assert {tuple(r) for r in report.coverage(empty, ["preco", "cep"]).collect()} == {(0, "preco", 0, 0.0), (0, "cep", 0, 0.0)}
    rows = spark.createDataFrame(
        [("R$ 1.000", "pr", "2025-01-02T00:00:00", "a"), ("R$ 3.000,", "PR", "invalid", "b"), ("", None, "2025-01-03T00:00:00", "c")],
        "preco string, estado string, data_coleta string, id string",
    )
    stats = report.price_stats(rows).first()
    assert tuple(stats) == (2, 1000.0, 3000.0, 2000.0)
    assert [tuple(r) for r in report.by_state_upper(rows).collect()] == [("PR", 2)]
    assert report.by_state(rows).count() == 3
    assert [r.id for r in report.recent_first(rows).collect()] == ["c", "a", "b"]
    cover = {r.campo: (r.preenchidos, r.pct) for r in report.coverage(rows, ["preco", "estado"]).collect()}
    assert cover == {"preco": (2, 66.7), "estado": (2, 66.7)}
    assert [r.id for r in report.last_rows(rows, ["id"], 2).collect()] == ["c", "b"]


def test_consolidate(spark):
    old = spark.createDataFrame([("1", "u", "2025-01-01T00:00:00", 0), ("2", None, "x", 0)], "id string, link string, data_coleta string, n int")
    new = spark.createDataFrame([("3", "u", 1, "c"), ("4", None, 1, "d")], "id string, link string, n int, cep string")
    whole = report.consolidate(old, new, order=["n", "id"])
    assert [r.id for r in whole.collect()] == ["1", "2", "4"]
    assert report.consolidate(old, new, order=["n", "id"], merge_null_links=True).count() == 2


def test_known_links_equal_the_queue_joined_with_its_events(spark):
    rng = random.Random(4)
    found = spark.createDataFrame([(rng.choice([None, *(f"https://www.olx.com.br/vi/{i}" for i in range(40))]),) for _ in range(200)], "url string")
    rows = [(f"https://www.zapimoveis.com.br/{i}" if rng.random() < 0.3 else f"https://www.olx.com.br/vi/{i}" if i else None, rng.randint(1, 4), n,
             rng.choice(["pending", "retry", "done", "error", None])) for n, i in enumerate(rng.choices(range(60), k=400))]
    events = spark.createDataFrame(rows, "url string, ts int, event_id long, status string").withColumn("id", F.md5("url"))
    queued, more = queue.as_links(events.select("url")), queue.as_links(found)
    links = queued.unionByName(queue.insert_ignore(queued, more))
    columns = ["id", "url", "domain", "status", "tentativas"]
    known = queue.known_links(found, events)
    assert known.columns == columns and as_set(known) == as_set(queue.with_status(links, events).select(*columns))
    assert known.count() == known.select("id").distinct().count() > 50
    assert queue.known_links(found.limit(0), events.limit(0)).count() == 0


def test_the_queue_is_read_in_three_scans_without_a_join_of_links(spark):
    """Events, and the two tables that the ads come from."""
    from __spark_entry__ import queries

    for key, scans in {"flt_pending_links": 3, "jn_status_update": 3, "ag_queue_stats": 5, "ag_anchor_counts": 2}.items():
        plan = queries()[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("FileScan") <= scans, key

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from garimpo.functions import payload
from garimpo.operators import captures as cap

AD = '{"list_id":%d,"ad_url":"https://x/%d","price":"R$ 1","subject":"s","municipality":"m","state_uf":"pr"}'


@pytest.fixture
def entries(spark):
    def build(*texts, status=200, url="u"):
        rows = [(i, url, status, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "entry_id long, url string, status int, text string")

    return build


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dictionaries(st.text(max_size=3), st.text('ab{}[]"\\,', max_size=6)), max_size=4), st.integers(0, 60))
def test_salvage_returns_exactly_the_whole_objects(objects, cut):
    text = json.dumps(objects)
    kept = text[: max(1, len(text) - cut)]
    got = [json.loads(o) for o in payload.salvage(kept)]
    assert got == objects[: len(got)]
    rest = len(json.dumps(objects[: len(got) + 1])) - 1
    assert len(got) == len(objects) or len(kept) < rest


def test_salvage_edges():
    assert payload.salvage('{"a":1}') == [] and payload.salvage(None) == []
    assert payload.salvage('[{"a":"}{"},{"b":{"c":1}},{"d":"x{y}') == ['{"a":"}{"}', '{"b":{"c":1}}']
    assert payload.salvage('[{bad},{"a":1}]') == ['{"a":1}']


def test_kinds():
    assert payload.classify(' [1, "]"] tail') == ("array", '[1, "]"]')
    assert payload.classify('{"ad_url":"https://a"}')[0] == "urls"
    assert payload.classify('var x = {"a": "}"};') == ("object", '{"a": "}"}')
    assert payload.classify("nada") == (None, None) and payload.classify("") == (None, None)


def test_deeply_nested_payloads_do_not_fail():
    deep = "[" * 200000
    assert payload.classify(deep) == (None, None) and payload.salvage(deep) == []
    assert payload.ad_urls('[{"a":' * 50000 + '"list_id":5') == [payload.NATIVE_URL + "5"]
    assert payload.salvage('[{"a":' + '{"b":' * 50000 + "1" + "}" * 50001 + ',{"c":1}') == ['{"c":1}']


def test_ad_urls_one_per_ad():
    whole = '[{"ad_url":"https://a","list_id":1,"more":[{"list_id":2},{"list_id":"3"},{"ad_url":"https://a"}]}]'
    assert payload.ad_urls(whole) == ["https://a", payload.NATIVE_URL + "2"]
    assert payload.ad_urls('[{"ad_url":"https://a","list_id":1},{"list_id":7,"ad_') == [
        "https://a", payload.NATIVE_URL + "7",
    ]
    deep = "[" * 12 + '{"ad_url":"https://a"}' + "]" * 12
    assert payload.ad_urls(deep) == ["https://a"]
    assert payload.ad_urls("[" + '{"b":' * 50000 + '{"ad_url":"https://a"}' + "}" * 50000 + "]") == ["https://a"]


def test_pattern_route_and_salvage_route(entries):
    lost = '{"list_id":9,"ad_url":"https://x/9"}'
    both = entries("[" + ",".join([AD % (1, 1), lost, AD % (2, 2)]) + "]")
    pattern = cap.ads_by_pattern(both).orderBy("pos").collect()
    assert [(r.list_id, r.ad_url, r.titulo) for r in pattern] == [("1", "https://x/1", "s"), ("9", "https://x/9", "s")]
    salvaged = cap.salvaged_ads(both).collect()
    assert sorted((r.list_id, r.preco) for r in salvaged) == [("1", "R$ 1"), ("2", "R$ 1"), ("9", None)]


def test_pattern_route_does_not_backtrack(entries):
    text = "[" + ",".join('{"list_id":%d,"ad_url":"u","price":"p","subject":"s","municipality":"m"}' % i for i in range(400)) + "]"
    assert cap.ads_by_pattern(entries(text)).count() == 0


def test_refused_and_empty_entries(entries):
    assert cap.answered(entries("", None, "x")).count() == 1
    assert cap.answered(entries("x", status=403)).count() == 0


def test_nested_and_bank(entries):
    text = '[{"content":[{"content":[{"ad_url":"a","list_id":1},{"ad_url":"b"}]},{"content":[]}]},{"x":1}]'
    assert [(r.ad_url, r.list_id) for r in cap.nested_ads(entries(text, "[cut")).collect()] == [("a", 1), ("b", None)]
    bank = entries('{"imoveis":[{"cidade":"C","valorminimo":10.5}]}', '{"imoveis":[]}', '{"x":1}', "no json")
    row = cap.bank_listings(cap.bank_rows(bank)).collect()
    assert [(r.cidade, r.valor_minimo, r.bairro, r.fonte) for r in row] == [("C", "10.5", None, "Caixa")]


def test_api_items_and_endpoints(spark, entries):
    items = spark.createDataFrame(
        [(1, "t", "p", "s", ("b", "c"), "z", "u"), (None, "t", "p", "s", None, "z", "u")],
        "id long, title string, price string, size string, location struct<neighborhood:string,municipality:string>, zip string, url string",
    )
    rows = cap.api_items(items, "sp").collect()
    assert [(r.bairro, r.cidade, r.estado) for r in rows] == [("b", "c", "SP"), (None, None, "SP")]
    assert cap.api_endpoints(entries("a", "b", url=" https://APIGW.olx.com.br/x ")).collect()[0].url == "https://APIGW.olx.com.br/x"


def test_parse_stats(entries):
    row = cap.parse_stats(entries("[" + AD % (1, 1) + "]", "[" + AD % (1, 1) + ",{", "nada", "", None)).first()
    assert tuple(row) == (5, 3, 2, 2, 1)


def test_profile_and_listings(entries):
    row = cap.profile(entries("GalleryGroup", None)).orderBy("entry_id").collect()
    assert [(r.chars, r.has_marker) for r in row] == [(12, True), (0, False)]
    listing = cap.as_listings(cap.ads_by_pattern(entries("[" + AD % (1, 1) + "]")), "2025-01-01T00:00:00").first()
    assert tuple(listing) == (
        "1", "https://x/1", "s", "R$ 1", "m", "PR", "", "Categoria: ", "OLX", "2025-01-01T00:00:00",
    )

"""Payload helpers for JSON that may be cut off.

``from_json`` gives null for a cut-off array, so whole objects are picked out by
a scanner that knows strings from structure. It works on Arrow batches.
"""

from __future__ import annotations

import json
import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from garimpo import constants as C

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}"]', re.S)
AD_URL = re.compile(r'"ad_url"\s*:\s*"(https?://[^"]+)"')
LIST_ID = re.compile(r'"list_id"\s*:\s*(\d+)')
NATIVE_URL = C.NATIVE_URL
UNREADABLE = (ValueError, RecursionError)


def loads(text):
    try:
        return json.loads(text)
    except UNREADABLE:
        return None


def whole_objects(text):
    """Outermost complete objects as (text, end); a cut-off last one is left out."""
    depth, start = 0, 0
    for token in TOKEN.finditer(text):
        mark = token.group()
        if mark == '"':
            return
        if mark == "{":
            if depth == 0:
                start = token.start()
            depth += 1
        elif mark == "}" and depth:
            depth -= 1
            if depth == 0:
                yield text[start : token.end()], token.end()


def salvage(text):
    if not text or not text.startswith("["):
        return []
    return [piece for piece, _ in whole_objects(text) if loads(piece) is not None]


def classify(text):
    """Kind of payload (array, urls, object) and the text it was found in."""
    body = (text or "").strip()
    if not body:
        return None, None
    decoder = json.JSONDecoder()
    if body.startswith("["):
        try:
            return "array", body[: decoder.raw_decode(body)[1]]
        except UNREADABLE:
            pass
    if AD_URL.search(body) or LIST_ID.search(body):
        return "urls", body
    at = body.find("{")
    if at >= 0:
        try:
            return "object", body[at : decoder.raw_decode(body, at)[1]]
        except UNREADABLE:
            pass
    return None, None


def walk(value):
    """Ad URLs of a JSON value at any depth, in text order; an ad without a URL gets one from its id."""
    ahead = [value]
    while ahead:
        value = ahead.pop()
        if isinstance(value, dict):
            url, ad_id = value.get("ad_url"), value.get("list_id")
            if isinstance(url, str):
                yield url
            elif "ad_url" not in value and isinstance(ad_id, int) and not isinstance(ad_id, bool):
                yield f"{NATIVE_URL}{ad_id}"
            ahead.extend(reversed(value.values()))
        elif isinstance(value, list):
            ahead.extend(reversed(value))


def ad_urls(text):
    return summary(text)[1]


def summary(text):
    """Kind of payload, and its distinct ad URLs in order: parsed where possible, searched in a cut-off tail."""
    kind, body = classify(text)
    return kind, _urls(body) if kind else []


def _urls(body):
    whole = loads(body)
    if whole is not None:
        return list(dict.fromkeys(walk(whole)))
    found, end = [], 0
    for piece, end in whole_objects(body):
        value = loads(piece)
        found.extend(AD_URL.findall(piece) if value is None else walk(value))
    tail = body[end:]
    found.extend(
        AD_URL.findall(tail) or [f"{NATIVE_URL}{ad_id}" for ad_id in LIST_ID.findall(tail)]
    )
    return list(dict.fromkeys(found))


def _list_udf(function):
    @F.arrow_udf("array<string>")
    def lists(texts: pa.Array) -> pa.Array:
        return pa.array([function(t.as_py()) for t in texts], type=pa.list_(pa.string()))

    return lists


def salvaged_objects(text: Column) -> Column:
    """Whole objects of an array text, complete or cut off, as JSON texts."""
    return _list_udf(salvage)(text)


def payload_ad_urls(text: Column) -> Column:
    return _list_udf(ad_urls)(text)


def payload_summary(text: Column) -> Column:
    """Struct of the payload kind and the distinct ad URLs; each text is decoded once."""

    @F.arrow_udf("struct<kind:string,urls:array<string>>")
    def summaries(texts: pa.Array) -> pa.Array:
        rows = [summary(t.as_py()) for t in texts]
        kind = pa.struct([("kind", pa.string()), ("urls", pa.list_(pa.string()))])
        return pa.array([{"kind": k, "urls": u} for k, u in rows], type=kind)

    return summaries(text)


def payload_kind(text: Column) -> Column:
    """Struct of the payload kind and the JSON text recognised."""

    @F.arrow_udf("struct<kind:string,body:string>")
    def kinds(texts: pa.Array) -> pa.Array:
        rows = [classify(t.as_py()) for t in texts]
        return pa.array(
            [{"kind": kind, "body": body} for kind, body in rows],
            type=pa.struct([("kind", pa.string()), ("body", pa.string())]),
        )

    return kinds(text)

"""JSON helpers: JSON-LD objects, optional fields, page cursors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from garimpo import constants as C
from garimpo.functions.money import price_label
from garimpo.functions.text import find, none_if_empty
from garimpo.functions.urls import header_next

STRICT = {"allowSingleQuotes": "false"}

OBJECT_FIELDS = (
    "name string, headline string, description string, telephone string, `@type` string, "
    "offers string, address string, contactPoint string"
)
ADDRESS_FIELDS = (
    "streetAddress string, addressLocality string, addressRegion string, postalCode string"
)


def field(json_text: Column, path: str) -> Column:
    """Optional nested field as text; empty counts as missing."""
    return none_if_empty(F.get_json_object(json_text, f"$.{path}"))


def elements(json_text: Column) -> Column:
    """Elements of a JSON array as JSON texts; null when it is no valid array."""
    return F.from_json(json_text, "array<string>", STRICT)


def _wrapped(json_text: Column) -> Column:
    """The text as a one-element array: the parser ignores what follows a value,
    but not what stands between a value and the closing bracket."""
    return elements(F.concat(F.lit("["), json_text, F.lit("]")))


def first_value(json_text: Column) -> Column:
    """The JSON value a text begins with, as JSON, whatever follows; null when it is cut off or none."""
    return F.get_json_object(json_text, "$")


def is_valid(json_text: Column) -> Column:
    """One JSON value and nothing after it."""
    return F.size(_wrapped(json_text)) == 1


def jsonld_blocks(html: Column) -> Column:
    """The JSON values of all JSON-LD scripts as texts, in page order, invalid ones left out.

    The page is cut at script ends and each closed piece searched once, so
    scripts that are never closed do not make the search start over. A page
    without the end of the type's name has none.
    """
    named = F.lit(False)
    for mark in C.JSONLD_MARKS:
        named = named | html.contains(mark)
    pieces = F.transform(
        F.array(F.split(html, C.SCRIPT_END)), lambda p: F.slice(p, 1, F.size(p) - 1)
    )
    bodies = F.transform(
        F.get(pieces, F.lit(0)), lambda p: F.regexp_extract(p, C.JSONLD_START, 1)
    )
    found = F.filter(bodies, lambda b: b != "")
    values = F.filter(F.transform(found, _wrapped), lambda v: F.size(v) == 1)
    none = F.array().cast("array<string>")
    return F.when(~named, none).otherwise(F.transform(values, lambda v: F.get(v, F.lit(0))))


def jsonld_objects(html: Column) -> Column:
    """All JSON-LD objects of a page as JSON texts, arrays spread."""
    spread = F.transform(
        jsonld_blocks(html), lambda v: F.when(v.startswith("["), elements(v)).otherwise(F.array(v))
    )
    return F.filter(F.flatten(spread), lambda o: o.startswith("{"))


def jsonld_plain_objects(html: Column, skip: list[str] = ()) -> Column:
    """JSON-LD scripts holding one object that mentions none of the skipped types."""

    def wanted(value: Column) -> Column:
        keep = value.startswith("{")
        for name in skip:
            keep = keep & ~value.contains(name)
        return keep

    return F.filter(jsonld_blocks(html), wanted)


def _object(json_text: Column) -> Column:
    return F.when(json_text.startswith("{"), json_text)


def _one_object(json_text: Column) -> Column:
    """The object itself, or the first element of a list of objects."""
    return F.when(json_text.startswith("["), F.get(elements(json_text), F.lit(0))).otherwise(
        _object(json_text)
    )


def _price(value: Column, kind: Column) -> Column:
    """Price label; a numeric zero counts as missing."""
    is_text = kind == "STRING"
    return price_label(F.when(is_text | (value.try_cast("double") != 0), value), is_text)


def _kind(variant: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(variant, path, "variant"))


def jsonld_listings(objects: Column) -> Column:
    """Listing fields of each JSON-LD object of an array.

    Parsing goes in steps, one ``transform`` each, so that every JSON text is
    parsed once and later steps read the parsed value.
    """
    parsed = F.transform(objects, lambda o: F.from_json(o, OBJECT_FIELDS, STRICT))
    picked = F.transform(
        parsed,
        lambda t: F.struct(
            t.alias("top"),
            _one_object(t["offers"]).alias("offer"),
            F.from_json(_object(t["address"]), ADDRESS_FIELDS, STRICT).alias("address"),
            F.from_json(_object(t["contactPoint"]), "telephone string", STRICT).alias("contact"),
        ),
    )
    opened = F.transform(
        picked,
        lambda p: F.struct(
            p["top"].alias("top"),
            p["address"].alias("address"),
            none_if_empty(p["contact"]["telephone"]).alias("contact_phone"),
            F.from_json(p["offer"], "price string, priceSpecification string", STRICT).alias("offer"),
            F.try_parse_json(p["offer"]).alias("variant"),
        ),
    )
    valued = F.transform(
        opened,
        lambda p: F.struct(
            p["top"].alias("top"),
            p["address"].alias("address"),
            p["contact_phone"].alias("contact_phone"),
            none_if_empty(p["offer"]["price"]).alias("price"),
            none_if_empty(field(_object(p["offer"]["priceSpecification"]), "price")).alias("spec_price"),
            p["variant"].alias("variant"),
        ),
    )
    # A label looks at its value and kind several times.
    kinds = F.transform(
        valued,
        lambda p: F.struct(
            p["top"].alias("top"),
            p["address"].alias("address"),
            p["contact_phone"].alias("contact_phone"),
            p["price"].alias("price"),
            F.when(p["price"].isNotNull(), _kind(p["variant"], "$.price")).alias("kind"),
            p["spec_price"].alias("spec_price"),
            F.when(p["spec_price"].isNotNull(), _kind(p["variant"], "$.priceSpecification.price")).alias("spec_kind"),
        ),
    )
    priced = F.transform(
        kinds,
        lambda p: F.struct(
            p["top"].alias("top"),
            p["address"].alias("address"),
            p["contact_phone"].alias("contact_phone"),
            _price(p["price"], p["kind"]).alias("price"),
            _price(p["spec_price"], p["spec_kind"]).alias("spec_price"),
        ),
    )

    def listing(p: Column) -> Column:
        top, address = p["top"], p["address"]
        return F.struct(
            top["@type"].alias("tipo"),
            none_if_empty(top["name"]).alias("nome"),
            F.coalesce(none_if_empty(top["name"]), none_if_empty(top["headline"])).alias("titulo"),
            p["price"].alias("preco_oferta"),
            F.coalesce(p["price"], p["spec_price"]).alias("preco"),
            none_if_empty(top["description"]).alias("descricao"),
            none_if_empty(address["streetAddress"]).alias("endereco"),
            none_if_empty(address["addressLocality"]).alias("cidade"),
            none_if_empty(address["addressRegion"]).alias("estado"),
            none_if_empty(address["postalCode"]).alias("cep"),
            F.coalesce(none_if_empty(top["telephone"]), p["contact_phone"]).alias("contato"),
            p["contact_phone"].alias("contato_ponto"),
        )

    return F.transform(priced, listing)


def page_cursor(payload: Column, link_header: Column) -> Column:
    """Next-page token: first non-empty of the known keys, else the Link header."""

    def token(key: str) -> Column:
        value = field(payload, key)
        return F.when(~value.isin("null", "false", "0", "[]", "{}"), value)

    return F.coalesce(*[token(k) for k in C.CURSOR_KEYS], header_next(link_header))


def embedded(html: Column, key: str, pattern: str) -> Column:
    """Value of a key written anywhere in the page."""
    return F.when(html.contains(f'"{key}"'), find(html, pattern, 1))


def embedded_city(html: Column) -> Column:
    return embedded(html, "addressLocality", C.EMBEDDED_CITY)


def embedded_region(html: Column) -> Column:
    return embedded(html, "addressRegion", C.EMBEDDED_REGION)


def embedded_postal(html: Column) -> Column:
    return embedded(html, "postalCode", C.EMBEDDED_POSTAL)

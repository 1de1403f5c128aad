"""Chat messages and model replies as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet import rules as R
from rivulet.functions.text import contains_any, strip, title_case


def is_station_question(message: Column) -> Column:
    return contains_any(F.lower(message), R.STATION_QUESTION_KEYWORDS)


def is_risk_question(message: Column) -> Column:
    return contains_any(F.lower(message), R.RISK_QUESTION_KEYWORDS)


def needs_station(message: Column) -> Column:
    return contains_any(F.lower(message), R.NEEDS_STATION_KEYWORDS)


def strip_fences(text: Column) -> Column:
    opened = F.regexp_replace(strip(text), r"\A```[a-zA-Z]*\n", "")
    return strip(F.regexp_replace(opened, r"\n```\z", ""))


def json_object(text: Column) -> Column:
    """JSON text inside a reply: the whole text, else its outermost braces; NULL if malformed."""
    whole = strip_fences(text)
    inner = F.nullif(F.regexp_extract(whole, r"(?s)\{.*\}", 0), F.lit(""))
    return (
        F.when(F.try_parse_json(whole).isNotNull(), whole)
        .when(F.try_parse_json(inner).isNotNull(), inner)
    )


def kind_of(item: Column) -> Column:
    """Type of a VARIANT value without what is inside it: STRING, BIGINT, OBJECT, ARRAY, VOID and so on."""
    return F.regexp_extract(F.schema_of_variant(item), r"^[A-Z]+", 0)


def value_text(item: Column) -> Column:
    """A VARIANT value as text: truth values as True and False, objects and lists as JSON, null as NULL."""
    written = F.try_variant_get(item, "$", "string")
    return F.when(kind_of(item) == "BOOLEAN", F.initcap(written)).otherwise(written)


def says_something(item: Column) -> Column:
    """False for null, false, zero, an empty text, list or object."""
    kind, written = kind_of(item), F.try_variant_get(item, "$", "string")
    return F.coalesce(
        F.when(kind == "STRING", written != "").when(kind == "BOOLEAN", written == "true")
        .when(kind == "OBJECT", written != "{}").when(kind == "ARRAY", written != "[]")
        .when(kind == "VOID", F.lit(False)).otherwise(F.try_variant_get(item, "$", "double") != 0.0),
        F.lit(False))


def render_item(raw: Column, item: Column) -> Column:
    """One reply item (text, number, truth value, list or object) as a readable line.

    ``item`` is the VARIANT value and decides how it is read, so a text that looks like an object stays a
    text. ``raw`` is its JSON text: VARIANT keeps fields by name, the line keeps them as written.
    """
    fields = F.try_variant_get(item, "$", "map<string, variant>")

    def said(key: Column) -> Column:
        value = F.try_element_at(fields, key)
        return F.when(says_something(value), strip(value_text(value)))

    keys = F.array(*[F.lit(key) for key in R.REPLY_ITEM_KEYS])
    preferred = F.get(F.filter(F.transform(keys, said), lambda text: text != ""), F.lit(0))
    parts = F.transform(F.json_object_keys(raw), lambda key: F.concat(
        title_case(F.replace(key, F.lit("_"), F.lit(" "))), F.lit(": "), value_text(F.try_element_at(fields, key))))
    line = F.array_join(F.filter(parts, lambda part: part.isNotNull()), "; ")
    return F.when(kind_of(item) == "OBJECT", F.coalesce(preferred, line)).otherwise(
        strip(F.coalesce(value_text(item), F.lit(""))))


def response_list(json_text: Column, key: str) -> Column:
    """Field of a reply as a list of readable lines; a single item becomes a list of one, a missing one an empty list."""
    field, raw = F.try_variant_get(F.try_parse_json(json_text), f"$.{key}", "variant"), F.get_json_object(json_text, f"$.{key}")
    lines = F.when(kind_of(field) == "ARRAY", F.zip_with(
        F.from_json(raw, "array<string>"), F.try_variant_get(field, "$", "array<variant>"), render_item,
    )).otherwise(F.array(render_item(raw, field)))
    return F.coalesce(
        F.filter(lines, lambda line: line.isNotNull() & (line != "")),
        F.array().cast("array<string>"),
    )


def text_list(field: Column) -> Column:
    """A VARIANT list as texts in order, nulls kept; NULL where it is no list."""
    return F.when(kind_of(field) == "ARRAY", F.transform(F.try_variant_get(field, "$", "array<variant>"), value_text))

"""Checking what a model answers, field by field, before any of it is used.

An answer is JSON text. It is parsed once into a variant, so that every field can be judged by the type it really has; a
struct read from the text would turn whatever does not fit into null. Each departure is one row with the JSON path
where it is and the rule it breaks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schemas import GROUP_TYPES, LAYOUT, STORY_FILE

VIOLATION = "array<struct<path:string,rule:string>>"


@dataclass(frozen=True)
class Field:
    """One required field: ``kind`` is string, integer, list or object; lists name what they hold in ``each``."""

    name: str
    kind: str
    each: Field | None = None
    fields: tuple[Field, ...] = ()
    allowed: tuple[str, ...] = ()


def _strings(*names: str) -> tuple[Field, ...]:
    return tuple(Field(n, "string") for n in names)


def _list(name: str, each: Field) -> Field:
    return Field(name, "list", each)


_TEXT, _ID = Field("", "string"), Field("", "integer")
# The fields of the three answer formats.
ITEMS = (_list("items", Field("", "object", fields=(
    *_strings("title", "summary", "main_topic"), _list("source_urls", _TEXT), _list("key_points", _TEXT)))),)
GROUPS = (_list("groups", Field("", "object", fields=(
    Field("type", "string", allowed=GROUP_TYPES), _list("item_ids", _ID), *_strings("group_title", "group_summary")))),)
LAYOUTS = (*_strings("newsletter_title"), _list("categories", Field("", "object", fields=(
    *_strings("category_name"), _list("subcategories", Field("", "object", fields=(
        *_strings("subcategory_name"), _list("item_ids", _ID), *_strings("intro_text"))))))), *_strings("executive_summary"))

ITEM_ANSWER = T.StructType([T.StructField("items", T.ArrayType(T.StructType([
    f for f in STORY_FILE["items"].dataType.elementType.fields if f.name in {x.name for x in ITEMS[0].each.fields}])))])
GROUP_ANSWER = T.StructType([T.StructField("groups", T.ArrayType(T.StructType([
    T.StructField("type", T.StringType()), T.StructField("item_ids", T.ArrayType(T.LongType())),
    T.StructField("group_title", T.StringType()), T.StructField("group_summary", T.StringType())])))])
LAYOUT_ANSWER = LAYOUT


def _one(path: Column, rule: str) -> Column:
    return F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule")))


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _is_integer(value: Column) -> Column:
    """Whole numbers, also written as text or with zeros behind the point, within 64 bits."""
    text = F.try_variant_get(value, "$", "string")
    whole = F.when(_kind(value) == "STRING", text.rlike(r"^\s*[+-]?[0-9]+\s*$")).otherwise(
        _kind(value).rlike("^(BIGINT|DOUBLE|DECIMAL)") & text.rlike(r"^[+-]?[0-9]+([.]0*)?(E[0-9]+)?$"))
    return F.coalesce(whole & F.try_variant_get(value, "$", "bigint").isNotNull(), F.lit(False))


def _value(value: Column, field: Field, path: Column) -> Column:
    """Departures of a value that is there."""
    none = F.array().cast(VIOLATION)
    if field.kind == "integer":
        return F.when(_is_integer(value), none).otherwise(_one(path, "not an integer"))
    if field.kind == "string":
        fine = F.when(F.try_variant_get(value, "$", "string").isin(*field.allowed), none).otherwise(
            _one(path, "not in list")) if field.allowed else none
        return F.when(_kind(value) == "STRING", fine).otherwise(_one(path, "not a string"))
    if field.kind == "list":
        places = F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda x, i: _value(
            x, field.each, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        return F.when(F.startswith(_kind(value), F.lit("ARRAY")), F.flatten(places)).otherwise(_one(path, "not a list"))
    return F.when(F.startswith(_kind(value), F.lit("OBJECT")), _members(value, field.fields, path)).otherwise(_one(path, "not an object"))


def _members(value: Column, fields: tuple[Field, ...], path: Column) -> Column:
    parts = []
    for field in fields:
        member, place = F.try_variant_get(value, f"$.{field.name}", "variant"), F.concat(path, F.lit(f".{field.name}"))
        parts.append(F.when(member.isNull(), _one(place, "missing")).otherwise(_value(member, field, place)))
    return F.concat(*parts)


def departures(answer: Column, fields: tuple[Field, ...]) -> Column:
    """``array<struct<path, rule>>`` of an answer's departures, in the order of the format; empty for a good one.

    Rules: missing, not json, not a string, an integer, a list, an object, not in list. A null or empty answer is not json.
    Fields beyond the format are allowed.
    """
    parsed, root = F.try_parse_json(answer), F.lit("$")
    return F.when(parsed.isNull(), _one(root, "not json")).otherwise(_value(parsed, Field("", "object", fields=fields), root))


def violations(answers: DataFrame, fields: tuple[Field, ...], key: list[str], response: str = "response") -> DataFrame:
    """(key, path, rule), one row per departure of the answers in ``response``."""
    return answers.select(*key, F.inline(departures(F.col(response), fields)))


def checked(answers: DataFrame, fields: tuple[Field, ...], schema: T.StructType, response: str = "response") -> DataFrame:
    """``answers`` with ``answer``, a struct of ``schema``, null where the answer departs from the format."""
    marked = answers.withColumn("_fine", F.size(departures(F.col(response), fields)) == 0)
    # The check has judged every field; reading through the variant also takes integers written as text.
    read = F.try_variant_get(F.try_parse_json(F.col(response)), "$", schema.simpleString())
    return marked.withColumn("answer", F.when(F.col("_fine"), read)).drop("_fine")

"""Expressions over JSON answers."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, functions as F, types as T

from leafmill.functions.text import BLANKS


def json_path(field: str) -> str:
    quote = '"' if "'" in field else "'"
    return f"$[{quote}{field}{quote}]"


def marked_json(text: Column) -> Column:
    """Parse a text together with a mark that shows whether all of it was read.

    The JSON parser stops after the first complete value, so text behind it would go
    unnoticed. The text is therefore parsed as the first item of a two-item list
    whose second item is a hash of the text: anything that closes the value early
    loses the hash or moves it to another place.
    """
    mark = F.xxhash64(text).cast("string")
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark, F.lit("]")))


def object_json(text: Column, marked: Column) -> Column:
    """The value of ``marked_json`` if the text was exactly one JSON object; NULL otherwise."""
    complete = (F.try_variant_get(marked, "$[1]", "bigint") == F.xxhash64(text)) & (
        F.try_variant_get(marked, "$[2]", "variant").isNull()
    )
    braced = F.startswith(F.ltrim(text, F.lit(BLANKS)), F.lit("{"))
    return F.when(braced & complete, F.try_variant_get(marked, "$[0]", "variant"))


def string_field(answer: Column, field: str) -> Column:
    """Text of a field: '' when missing, NULL when JSON null."""
    value = F.variant_get(answer, json_path(field), "variant")
    return (
        F.when(value.isNull(), F.lit(""))
        .when(F.is_variant_null(value), F.lit(None).cast("string"))
        .otherwise(F.variant_get(answer, json_path(field), "string"))
    )


def json_field(answer: Column, field: str) -> Column:
    """JSON text of a field: '[]' when missing, 'null' when JSON null."""
    return F.coalesce(
        F.to_json(F.variant_get(answer, json_path(field), "variant")), F.lit("[]")
    )


def metadata_json(extraction_date: Column, processing_date: Column) -> Column:
    """The metadata object as JSON text; a NULL date is kept as null."""
    return F.to_json(
        F.struct(
            extraction_date.alias("extraction_date"),
            processing_date.alias("processing_date"),
        ),
        {"ignoreNullFields": "false"},
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def json_schema_of(dtype: T.DataType, *, nullable: bool = False, extra_allowed: bool = False) -> dict[str, Any]:
    """The JSON Schema of a Spark type: non-nullable fields are required, nullable ones may be null.

    List items and map values may not be null.
    """
    if isinstance(dtype, T.StructType):
        node: dict[str, Any] = {
            "type": "object",
            "properties": {
                f.name: json_schema_of(f.dataType, nullable=f.nullable, extra_allowed=extra_allowed)
                for f in dtype.fields
            },
            "required": [f.name for f in dtype.fields if not f.nullable],
            "additionalProperties": extra_allowed,
        }
    elif isinstance(dtype, T.ArrayType):
        node = {"type": "array", "items": json_schema_of(dtype.elementType, extra_allowed=extra_allowed)}
    elif isinstance(dtype, T.MapType):
        values = json_schema_of(dtype.valueType, extra_allowed=extra_allowed)
        node = {"type": "object", "additionalProperties": values}
    elif isinstance(dtype, T.StringType):
        node = {"type": "string"}
    elif isinstance(dtype, (T.IntegerType, T.LongType)):
        node = {"type": "integer"}
    elif isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        node = {"type": "number"}
    elif isinstance(dtype, T.BooleanType):
        node = {"type": "boolean"}
    else:
        return {}
    return {**node, "type": [node["type"], "null"]} if nullable else node


# How ``schema_of_variant`` names the values of a JSON type.
SCALAR_KINDS = {
    "string": r"^STRING$",
    "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$",
    "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\))$",
    "boolean": r"^BOOLEAN$",
}
NO_VIOLATIONS = "array<string>"


def violations_of(value: Column, node: Mapping[str, Any], path: str = "") -> Column:
    """How a JSON value breaks a JSON Schema node: a list of texts, empty if it does not.

    ``missing:p`` for a required property, ``type:p`` for a value of another type, ``extra:p`` for
    an undeclared property, ``enum:p`` for a value not listed. Paths join names by dots; ``[]``
    stands for the items of a list and ``{}`` for the values of an open object, and scalar ones
    are reported under the list or object itself. Each is told once, by property in schema order,
    extras of an object behind them in alphabetical order. Of ``anyOf`` (or ``oneOf``) and of
    several types one has to fit; if none does, that is one ``type:p``. The expression follows the
    schema to any depth and grows with its size; values are fetched once each.
    """
    none = F.array().cast(NO_VIOLATIONS)
    wrong = F.array(F.lit(f"type:{path}"))
    if options := node.get("anyOf") or node.get("oneOf"):
        found = none
        for option in reversed(options):
            found = F.when(F.size(violations_of(value, option, path)) == 0, none).otherwise(
                wrong if option is options[-1] else found
            )
        return found
    kinds = node.get("type")
    kinds = [kinds] if isinstance(kinds, str) else list(kinds or ())
    found = none
    if kinds:
        named = F.schema_of_variant(value)
        scalars = [SCALAR_KINDS[k] for k in kinds if k in SCALAR_KINDS]
        fits = F.rlike(named, F.lit("|".join(scalars))) if scalars else F.lit(False)
        found = F.when(fits, none).otherwise(wrong)
        if "array" in kinds:
            found = _if_list(value, node.get("items"), path, found)
        if "object" in kinds:
            found = _if_object(value, node, path, found)
        found = F.when(F.is_variant_null(value), none if "null" in kinds else wrong).otherwise(found)
    if "enum" in node:
        listed = [json.dumps(v, separators=(",", ":"), sort_keys=True, ensure_ascii=False) for v in node["enum"]]
        unlisted = F.when(F.to_json(value).isin(listed), none).otherwise(F.array(F.lit(f"enum:{path}")))
        found = F.when(F.size(found) > 0, found).otherwise(unlisted) if kinds else unlisted
    return found


def _is_scalar(node: Mapping[str, Any]) -> bool:
    kinds = node.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds or ()
    return not ({"object", "array"} & set(kinds))


def _each(values: Column, node: Mapping[str, Any], path: str, mark: str) -> Column:
    inner = path if _is_scalar(node) else path + mark
    return F.array_distinct(F.flatten(F.transform(values, lambda item: violations_of(item, node, inner))))


def _if_list(value: Column, node: Mapping[str, Any] | None, path: str, rest: Column) -> Column:
    def body(items: Column) -> Column:
        inner = _each(items, node, path, "[]") if node else F.array().cast(NO_VIOLATIONS)
        return F.when(items.isNull(), rest).otherwise(inner)

    return let(F.try_variant_get(value, "$", "array<variant>"), body)


def _if_object(value: Column, node: Mapping[str, Any], path: str, rest: Column) -> Column:
    def body(fields: Column) -> Column:
        return F.when(fields.isNull(), rest).otherwise(_object_violations(value, fields, node, path))

    return let(F.try_variant_get(value, "$", "map<string,variant>"), body)


def _property(value: Column, name: str, node: Mapping[str, Any], path: str, required: bool) -> Column:
    absent = F.array(F.lit(f"missing:{path}")) if required else F.array().cast(NO_VIOLATIONS)

    # A JSON null is a value here; only an absent property is NULL.
    def body(item: Column) -> Column:
        return F.when(item.isNull(), absent).otherwise(violations_of(item, node, path))

    return let(F.variant_get(value, json_path(name), "variant"), body)


def _object_violations(value: Column, fields: Column, node: Mapping[str, Any], path: str) -> Column:
    prefix = f"{path}." if path else ""
    declared = node.get("properties", {})
    required = set(node.get("required", ()))
    parts = [
        _property(value, name, child, prefix + name, name in required) for name, child in declared.items()
    ]
    others = node.get("additionalProperties", True)
    names = F.array(*[F.lit(name) for name in declared]).cast(NO_VIOLATIONS)
    if others is False:
        extra = F.array_sort(F.array_except(F.map_keys(fields), names))
        parts.append(F.transform(extra, lambda k: F.concat(F.lit(f"extra:{prefix}"), k)))
    elif isinstance(others, Mapping) and others:
        rest = F.map_values(F.map_filter(fields, lambda k, _: ~F.array_contains(names, k)))
        parts.append(_each(rest, others, path, "{}"))
    return F.concat(*parts) if parts else F.array().cast(NO_VIOLATIONS)


def rule_answer(content: Column) -> Column:
    """A JSON answer made by fixed rules, standing in for a model.

    It lets the data path run and be checked without any remote service: the title
    is the first line, the abstract the second, and the keywords are the five
    longest distinct words of at least five ASCII letters, equal lengths in
    alphabetical order. The other fields are present and empty.
    """
    words = F.array_distinct(F.regexp_extract_all(content, F.lit("[A-Za-z]{5,}"), F.lit(0)))
    ranked = F.sort_array(F.transform(words, lambda w: F.struct(-F.length(w), w.alias("word"))))
    keywords = F.slice(ranked, 1, 5)["word"]
    none = F.array().cast("array<string>")
    return F.to_json(
        F.struct(
            F.substring_index(content, "\n", 1).alias("title"),
            none.alias("authors"),
            F.split_part(
                F.substring_index(content, "\n", 2), F.lit("\n"), F.lit(2)
            ).alias("abstract"),
            keywords.alias("keywords"),
            F.lit("").alias("methodology"),
            none.alias("key_findings"),
            F.lit("").alias("conclusions"),
            none.alias("proposed_models"),
            F.lit("").alias("future_work"),
        )
    )

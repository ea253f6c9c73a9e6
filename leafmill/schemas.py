"""Fixed values and schemas of the pipeline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import types as T

# --- Fixed values: prompts, answer schema and table columns that results depend on.

PROMPT_MESSAGES = [
    {
        "role": "system",
        "content": (
            "You are an expert in analyzing technical and scientific papers. "
            "Always answer in English. Your task is to extract specific structured "
            "details from the paper content provided."
        ),
    },
    {
        "role": "user",
        "content": (
            "Analyze the content of this technical or scientific paper and extract "
            "the following details in a structured format. If a piece of information "
            "is not clearly present, omit the field or set it to null.\n\n"
            "Paper URL: {url}\n\nPaper content: {text}"
        ),
    },
]

RESPONSE_FORMAT = {
    "type": "json_schema",
    "json_schema": {
        "name": "paper_information_extraction",
        "schema": {
            "type": "object",
            "properties": {
                "title": {
                    "type": "string",
                    "description": "The title of the paper.",
                },
                "authors": {
                    "type": "array",
                    "description": "List of authors of the paper.",
                    "items": {"type": "string", "description": "Name of an author."},
                },
                "abstract": {
                    "type": "string",
                    "description": "The abstract or summary of the paper.",
                },
                "keywords": {
                    "type": "array",
                    "description": "List of keywords or key topics mentioned in the paper.",
                    "items": {"type": "string", "description": "A keyword or key topic."},
                },
                "methodology": {
                    "type": "string",
                    "description": "A summary of the methodology or approach used in the research.",
                },
                "key_findings": {
                    "type": "array",
                    "description": "List of main results or findings from the paper.",
                    "items": {"type": "string", "description": "A key result or finding."},
                },
                "conclusions": {
                    "type": "string",
                    "description": "The main conclusions or implications of the research.",
                },
                "proposed_models": {
                    "type": "array",
                    "description": (
                        "List of models, algorithms, or frameworks proposed in the paper."
                    ),
                    "items": {
                        "type": "string",
                        "description": "A model, algorithm, or framework proposed.",
                    },
                },
                "future_work": {
                    "type": "string",
                    "description": "Suggestions for future research mentioned in the paper.",
                },
            },
            "required": [
                "title",
                "authors",
                "abstract",
                "keywords",
                "methodology",
                "key_findings",
                "conclusions",
                "proposed_models",
                "future_work",
            ],
            "additionalProperties": False,
        },
        "strict": True,
    },
}

MODEL = "gpt-4o"

TEMPERATURE = 0

TABLE_NAME = "documents"

TABLE_COLUMNS = {
    "document_id": "VARCHAR",
    "filename": "VARCHAR",
    "company_name": "VARCHAR",
    "report_year": "INTEGER",
    "title": "VARCHAR",
    "authors": "JSON",
    "abstract": "TEXT",
    "keywords": "JSON",
    "methodology": "TEXT",
    "key_findings": "JSON",
    "conclusions": "TEXT",
    "proposed_models": "JSON",
    "future_work": "TEXT",
    "metadata": "JSON",
}

# --- Schemas of the data passed between stages.

FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)

LISTING = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modificationTime", T.TimestampType()),
    ]
)

EXTRACTED = T.StructType(
    [
        T.StructField("stem", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("extraction_date", T.StringType()),
    ]
)

MESSAGES = T.ArrayType(
    T.StructType(
        [
            T.StructField("role", T.StringType()),
            T.StructField("content", T.StringType()),
        ]
    )
)

# Type names accepted in a column map that Spark spells differently. Names not
# listed go to Spark's own type parser as they are.
SPARK_TYPE_NAMES = {
    "VARCHAR": "STRING",
    "TEXT": "STRING",
    "JSON": "STRING",
    "UUID": "STRING",
    "INTEGER": "INT",
    "HUGEINT": "DECIMAL(38,0)",
    "REAL": "FLOAT",
    "BLOB": "BINARY",
}


def spark_type(name: str) -> str:
    """Spark spelling of a column type from a column map."""
    return SPARK_TYPE_NAMES.get(name.strip().upper(), name)


def struct_from_json_schema(node: Mapping[str, Any]) -> T.DataType:
    """Spark type of a JSON Schema node.

    Required properties become non-nullable fields, which is how the checks in
    ``validate_records`` know them. An object without declared properties is any
    JSON value and becomes VARIANT.
    """
    kind = node.get("type")
    if isinstance(kind, list):
        # A union with null is that type; a field's nullability is no part of its type here.
        rest = [option for option in kind if option != "null"]
        if len(rest) != 1:
            return T.VariantType()
        return struct_from_json_schema({**node, "type": rest[0]})
    if kind == "object" and "properties" in node:
        required = set(node.get("required", ()))
        return T.StructType(
            [
                T.StructField(name, struct_from_json_schema(child), name not in required)
                for name, child in node["properties"].items()
            ]
        )
    if kind == "array":
        return T.ArrayType(struct_from_json_schema(node["items"])) if "items" in node else (
            T.ArrayType(T.VariantType())
        )
    scalars = {
        "string": T.StringType(),
        "integer": T.LongType(),
        "number": T.DoubleType(),
        "boolean": T.BooleanType(),
    }
    return scalars.get(kind, T.VariantType())


def restrict_struct(schema: T.StructType, fields: Sequence[str] | None) -> T.StructType:
    """The requested fields of a struct, in the requested order; unknown ones are ignored."""
    if not fields:
        return schema
    known = set(schema.names)
    return T.StructType([schema[name] for name in dict.fromkeys(fields) if name in known])


def restrict_response_format(
    fields: Sequence[str] | None, response_format: Mapping[str, Any] | None = None
) -> dict[str, Any]:
    """The response format to send to a model when only some fields are wanted.

    Properties follow the requested order, ``required`` keeps the schema's own.
    Without fields the whole format is returned, or the generic JSON object when
    there is none.
    """
    if not fields:
        return dict(response_format) if response_format else {"type": "json_object"}
    if not response_format:
        raise ValueError("fields need a response format to choose from")
    wrapper = response_format["json_schema"]
    schema = wrapper["schema"]
    wanted = [name for name in dict.fromkeys(fields) if name in schema["properties"]]
    narrowed = {
        **schema,
        "properties": {name: schema["properties"][name] for name in wanted},
        "required": [name for name in schema["required"] if name in wanted],
    }
    return {**response_format, "json_schema": {**wrapper, "schema": narrowed}}


ANSWER = struct_from_json_schema(RESPONSE_FORMAT["json_schema"]["schema"])

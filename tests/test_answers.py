"""JSON answers: parsing, quarantine, checks and flattening."""

import json

import pytest
from pyspark.sql import functions as F, types as T

from leafmill.functions.answers import json_schema_of
from leafmill.operators.extract import split_failures
from leafmill.operators.load import flatten_record, with_metadata
from leafmill.operators.structure import parse_responses, project_fields, validate_records
from leafmill.schemas import (
    ANSWER,
    RESPONSE_FORMAT,
    restrict_response_format,
    restrict_struct,
    struct_from_json_schema,
)

GOOD = [
    '{"title":"a"}',
    ' {"title":"a"}\r\n\t',
    "{}",
    '{"title":null}',
    '{"title":"] , } x"}',
    '{"title":{"z":1,"b":[1,2.50,"Ł"]}}',
    '{"title":"a","title":"b"}',
]
BAD = [
    "{bad",
    "",
    " ",
    "[1]",
    "3",
    "null",
    '"text"',
    '{"title":"a"} x',
    '{"title":"a"} x}',
    '{"title":"a"}}',
    '{"title":"a"}]',
    '{"title":"a"}] x}',
    '{"title":"a"},2',
    '{"title":"a"},{"title":"b"}',
    '{"title":"a"},',
    ',{"title":"a"}',
    'x {"title":"a"}',
    '{"title":NaN}',
    "{'title':'a'}",
]


def answers(spark, texts):
    rows = spark.createDataFrame(
        [(i, text) for i, text in enumerate(texts)], "id int, response string"
    )
    return parse_responses(rows)


def test_whole_objects_are_kept(spark):
    rows = answers(spark, GOOD).orderBy("id").select(F.to_json("answer").alias("j"), "error")
    for text, row in zip(GOOD, rows.collect()):
        assert row["error"] is None, text
        assert json.loads(row["j"]) == json.loads(text)


def test_everything_else_is_set_aside(spark):
    good, errors = split_failures(answers(spark, [*BAD, None]))
    assert good.count() == 0
    reasons = {row["response"]: row["error"] for row in errors.collect()}
    assert reasons.pop(None) == "no response"
    assert set(reasons) == set(BAD)
    assert set(reasons.values()) == {"not a JSON object"}


def test_earlier_error_stays(spark):
    rows = spark.createDataFrame([(None, "boom")], "response string, error string")
    assert parse_responses(rows).first()["error"] == "boom"


def test_typed_answers(spark):
    rows = spark.createDataFrame(
        [('{"title":"a","authors":["x"]}',), ("{bad",)], "response string"
    )
    typed = parse_responses(rows, restrict_struct(ANSWER, ["authors", "title"]))
    assert [row["typed"] and row["typed"].asDict() for row in typed.collect()] == [
        {"authors": ["x"], "title": "a"},
        None,
    ]


FIELDS = {"string": "title", "list": "authors"}


@pytest.mark.parametrize(
    "body, title, authors",
    [
        ({}, "", "[]"),
        ({"title": None, "authors": None}, None, "null"),
        ({"title": "Ł", "authors": ["Ł a", "b"]}, "Ł", '["Ł a","b"]'),
        ({"title": "", "authors": []}, "", "[]"),
        ({"title": 5, "authors": "x"}, "5", '"x"'),
        ({"title": True, "authors": {"z": 1, "a": [None]}}, "true", '{"a":[null],"z":1}'),
    ],
)
def test_flatten_truth_table(spark, body, title, authors):
    parsed = answers(spark, [json.dumps(body)]).withColumn("filename", F.lit("f.pdf"))
    row = flatten_record(parsed).first()
    assert (row["title"], row["authors"]) == (title, authors)
    assert (row["document_id"], row["filename"]) == ("f.pdf", "f.pdf")
    assert (row["future_work"], row["keywords"]) == ("", "[]")


def test_metadata_keeps_null_dates(spark):
    rows = spark.createDataFrame([("2024-01-01T00:00:00",), (None,)], "extraction_date string")
    moment = F.lit("2024-05-06 07:08:09.1").cast("timestamp")
    found = [row["metadata"] for row in with_metadata(rows, processed_at=moment).collect()]
    assert found == [
        '{"extraction_date":"2024-01-01T00:00:00","processing_date":"2024-05-06T07:08:09.100000"}',
        '{"extraction_date":null,"processing_date":"2024-05-06T07:08:09.100000"}',
    ]


def complete(**changes):
    body = {
        f.name: [] if isinstance(f.dataType, T.ArrayType) else "" for f in ANSWER.fields
    } | changes
    return json.dumps({key: value for key, value in body.items() if value is not ...})


@pytest.mark.parametrize(
    "text, violations",
    [
        (complete(), []),
        (complete(authors=["a", "b"]), []),
        (complete(title=...), ["missing:title"]),
        (complete(title=None), ["type:title"]),
        (complete(title=5, authors="x"), ["type:title", "type:authors"]),
        (complete(authors=["a", 1]), ["type:authors"]),
        (complete(authors=[None]), ["type:authors"]),
        (complete(zeta=1, alpha=2), ["extra:alpha", "extra:zeta"]),
        ("{}", [f"missing:{name}" for name in ANSWER.names]),
    ],
)
def test_validate(spark, text, violations):
    assert validate_records(answers(spark, [text])).first()["violations"] == violations


def test_validate_second_schema(spark):
    """A schema with numbers, free-form objects and an optional field."""
    schema = T.StructType.fromDDL(
        "company_name STRING NOT NULL, report_year INT NOT NULL, metrics MAP<STRING,VARIANT>"
        " NOT NULL, emissions MAP<STRING,VARIANT>, share DOUBLE, listed BOOLEAN"
    )
    rows = answers(
        spark,
        [
            '{"company_name":"c","report_year":2024,"metrics":{"a":1}}',
            '{"company_name":"c","report_year":2024.5,"metrics":[],"emissions":null,"share":1}',
            '{"company_name":"c","report_year":"x","metrics":{},"share":"1","listed":0,"n":1}',
        ],
    )
    strict = validate_records(rows, schema).orderBy("id").collect()
    assert [row["violations"] for row in strict] == [
        [],
        ["type:report_year", "type:metrics"],
        ["type:report_year", "type:share", "type:listed", "extra:n"],
    ]
    loose = validate_records(rows, schema, extra_allowed=True).orderBy("id").collect()
    assert loose[2]["violations"] == ["type:report_year", "type:share", "type:listed"]


NESTED = "o STRUCT<x: INT NOT NULL> NOT NULL, l ARRAY<STRUCT<y: INT>>, m MAP<STRING, STRUCT<z: BOOLEAN NOT NULL>>"


@pytest.mark.parametrize(
    "text, violations",
    [
        ('{"o":{"zz":1},"l":[{"y":"no"}]}', ["missing:o.x", "extra:o.zz", "type:l[].y"]),
        ('{"o":{"x":1},"l":[{"y":1},{"y":null},{}]}', []),
        ('{"o":{"x":null},"l":[{"y":"a"},{"y":"b"},{"b":1,"a":1},3]}',
         ["type:o.x", "type:l[].y", "extra:l[].a", "extra:l[].b", "type:l[]"]),
        ('{"o":[],"l":{},"m":[]}', ["type:o", "type:l", "type:m"]),
        ('{"o":{"x":1},"m":{"a":{"z":true},"b":{"z":1},"c":{}}}', ["type:m{}.z", "missing:m{}.z"]),
        ('{"o":null,"l":null,"m":null,"n":null}', ["type:o", "extra:n"]),
    ],
)
def test_validate_nested(spark, text, violations):
    assert validate_records(answers(spark, [text]), T.StructType.fromDDL(NESTED)).first()["violations"] == violations


DEEP = {
    "type": "object",
    "required": ["id"],
    "properties": {
        "id": {"anyOf": [{"type": "integer"}, {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer"}}}]},
        "kind": {"type": ["string", "null"], "enum": ["a", "b", None]},
        "tree": {
            "type": "array",
            "items": {"type": "object", "properties": {"leaf": {"type": "array", "items": {"type": ["number", "string"]}}},
                      "additionalProperties": False},
        },
        "open": {"type": "object", "additionalProperties": {"type": "integer"}},
        "any": {},
    },
}


@pytest.mark.parametrize(
    "body, violations",
    [
        ({"id": 1, "kind": "a", "tree": [{"leaf": [1, "x", 2.5]}], "open": {"k": 1}, "any": [None], "more": 1}, []),
        ({"id": {"n": 1}, "kind": None}, []),
        ({"id": {"n": "x"}, "kind": "c"}, ["type:id", "enum:kind"]),
        ({"id": "x", "kind": 5}, ["type:id", "type:kind"]),
        ({"tree": [{"leaf": [True], "q": 1}, {"leaf": 3}], "open": {"a": 1, "b": "x", "c": None}},
         ["missing:id", "type:tree[].leaf", "extra:tree[].q", "type:open"]),
    ],
)
def test_validate_follows_a_json_schema(spark, body, violations):
    assert validate_records(answers(spark, [json.dumps(body)]), DEEP).first()["violations"] == violations


def brute_violations(value, node, path=""):
    """The same by recursion over Python values."""
    kinds = node.get("type")
    kinds = [kinds] if isinstance(kinds, str) else list(kinds or ())
    names = {bool: ["boolean"], int: ["integer", "number"], float: ["number"], str: ["string"], list: ["array"],
             dict: ["object"], type(None): ["null"]}[type(value)]
    if kinds and not set(kinds) & set(names):
        return [f"type:{path}"]
    out = []
    if isinstance(value, dict) and "object" in kinds:
        prefix = f"{path}." if path else ""
        for name, child in node.get("properties", {}).items():
            if name in value:
                out += brute_violations(value[name], child, prefix + name)
            elif name in node.get("required", ()):
                out.append(f"missing:{prefix}{name}")
        if node.get("additionalProperties") is False:
            out += [f"extra:{prefix}{k}" for k in sorted(set(value) - set(node.get("properties", {})))]
    if isinstance(value, list) and "items" in node:
        child = node["items"]
        scalar = not {"object", "array"} & set([child["type"]] if isinstance(child["type"], str) else child["type"])
        for item in value:
            out += brute_violations(item, child, path if scalar else path + "[]")
    return list(dict.fromkeys(out)) if isinstance(value, list) else out


def test_validate_equals_recursion_on_random_answers(spark):
    import random

    draw = random.Random(4)

    def value(depth):
        kind = draw.randrange(9 if depth else 6)
        if kind < 6:
            return [None, True, 3, 2.5, "t", 0][kind]
        if kind == 6:
            return [value(depth - 1) for _ in range(draw.randrange(3))]
        return {draw.choice("oxylzq"): value(depth - 1) for _ in range(draw.randrange(4))}

    node = json_schema_of(T.StructType.fromDDL(
        "o STRUCT<x: INT NOT NULL, y: ARRAY<STRING>> NOT NULL, l ARRAY<STRUCT<y: DOUBLE, z: STRUCT<q: BOOLEAN NOT NULL>>>, x INT"
    ))
    bodies = [{draw.choice("olxq"): value(3) for _ in range(4)} for _ in range(400)]
    rows = validate_records(answers(spark, [json.dumps(b) for b in bodies]), node).orderBy("id").collect()
    assert [r["violations"] for r in rows] == [brute_violations(b, node) for b in bodies]


@pytest.mark.parametrize("setting", ["true", "false", None])
def test_the_last_of_equal_keys_counts_in_every_session(spark, setting):
    name = "spark.sql.variant.allowDuplicateKeys"
    spark.conf.unset(name) if setting is None else spark.conf.set(name, setting)
    rows = spark.createDataFrame([('{"a":1,"a":2}',), ('{"o":{"a":1,"a":{"b":1,"b":3}}}',)], "response string")
    parsed = parse_responses(rows, "a INT, o STRUCT<a: STRUCT<b: INT>>").collect()
    assert [r["error"] for r in parsed] == [None, None]
    assert [r["answer"].toPython() for r in parsed] == [{"a": 2}, {"o": {"a": {"b": 3}}}]
    assert (parsed[0]["typed"]["a"], parsed[1]["typed"]["o"]["a"]["b"]) == (2, 3)


def test_what_does_not_fit_the_types_is_shown(spark):
    texts = ['{"a":1,"b":"x"}', '{"a":"no","b":"x"}', '{"a":null}', '{"a":1}}', "[1]", '{"a":NaN}', '{"a":{}}', None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, response string")
    found = parse_responses(rows, "a INT, b STRING").orderBy("id").collect()
    assert [r["typed"] and r["typed"]["a"] for r in found] == [1, None, None, None, None, None, None, None]
    assert [r["corrupt"] for r in found] == [None, texts[1], None, None, None, None, texts[6], None]
    assert [r["error"] is None for r in found] == [True, True, True, False, False, False, True, False]
    with pytest.raises(ValueError):
        parse_responses(rows, "_corrupt_answer STRING")


def test_validate_leaves_unparsed_rows_alone(spark):
    rows = validate_records(answers(spark, ["{bad"])).collect()
    assert [row["violations"] for row in rows] == [None]


def test_restrict_fields(spark):
    narrowed = restrict_response_format(["keywords", "nope", "title"], RESPONSE_FORMAT)
    schema = narrowed["json_schema"]["schema"]
    assert list(schema["properties"]) == ["keywords", "title"]
    assert schema["required"] == ["title", "keywords"]
    assert schema["additionalProperties"] is False and narrowed["json_schema"]["strict"] is True
    assert len(RESPONSE_FORMAT["json_schema"]["schema"]["properties"]) == 9
    assert restrict_response_format(None, RESPONSE_FORMAT) == RESPONSE_FORMAT
    assert restrict_response_format(None) == {"type": "json_object"}

    df = spark.sql("SELECT struct('t' AS title, array('k') AS keywords, 1 AS other) AS answer")
    kept = project_fields(df, "answer", df.schema["answer"].dataType, ["keywords", "no", "title"])
    assert kept.first()["answer"].asDict() == {"keywords": ["k"], "title": "t"}
    assert project_fields(df, "answer", df.schema["answer"].dataType).first() == df.first()


def test_struct_from_json_schema():
    assert ANSWER.names[0] == "title" and not ANSWER["title"].nullable
    found = struct_from_json_schema(
        {
            "type": "object",
            "properties": {
                "n": {"type": "integer"},
                "x": {"type": "number"},
                "b": {"type": "boolean"},
                "o": {"type": "object"},
                "l": {"type": "array", "items": {"type": "integer"}},
            },
            "required": ["n"],
        }
    )
    assert found == T.StructType.fromDDL(
        "n BIGINT NOT NULL, x DOUBLE, b BOOLEAN, o VARIANT, l ARRAY<BIGINT>"
    )

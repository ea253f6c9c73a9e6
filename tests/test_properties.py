"""Expressions against the Python functions they stand for, on random inputs."""

import json
from pathlib import PurePosixPath

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from leafmill.functions.text import file_name, file_stem, percent_text
from leafmill.operators.extract import assemble_text
from leafmill.operators.load import flatten_record
from leafmill.operators.structure import parse_responses, render_prompts

FEW = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
# Any text that UTF-8 can carry.
TEXT = st.text(st.characters(exclude_categories=["Cs"]), max_size=30)
NAME = st.text(st.sampled_from("ab.. é%\n"), min_size=1, max_size=8).filter(
    lambda n: n not in (".", "..")
)


@FEW
@given(st.lists(NAME, min_size=1, max_size=40))
def test_stem(spark, names):
    df = spark.createDataFrame([("/x/" + n,) for n in names], "path string")
    rows = df.select(file_stem(file_name(F.col("path"))).alias("s")).collect()
    assert [r["s"] for r in rows] == [PurePosixPath("/x/" + n).stem for n in names]


@FEW
@given(
    st.lists(
        st.tuples(st.integers(0, 10**6), st.integers(1, 10**6)).map(
            lambda t: (min(t), max(1, *t))
        ),
        min_size=1,
        max_size=60,
    )
)
def test_percent(spark, pairs):
    pairs = [*pairs, (1, 4000), (1, 800), (3, 800), (203, 20000), (1, 20000), (3, 20000), (7, 7)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    rows = df.select(percent_text(F.col("a"), F.col("b")).alias("p")).collect()
    assert [r["p"] for r in rows] == [f"{a / b * 100:.2f}%" for a, b in pairs]


@FEW
@given(st.lists(TEXT, min_size=1, max_size=20))
def test_prompts(spark, texts):
    template = "{text} and {url}: {text}"
    df = spark.createDataFrame([(t,) for t in texts], "content string")
    rows = render_prompts(df, [{"role": "user", "content": template}]).collect()
    for text, row in zip(texts, rows):
        if text:
            assert row["messages"][0]["content"] == template.replace("{text}", text)
        else:
            assert row["messages"] is None


JSON_VALUE = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**63), 2**63 - 1) | TEXT,
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(TEXT, inner, max_size=3),
    max_leaves=6,
)
ANSWERS = st.fixed_dictionaries(
    {},
    optional={
        "title": st.none() | TEXT,
        "abstract": st.none() | TEXT,
        "authors": st.none() | st.lists(TEXT, max_size=3),
        "key_findings": JSON_VALUE,
        "other": JSON_VALUE,
    },
)


@FEW
@given(st.lists(ANSWERS, min_size=1, max_size=20))
def test_flatten(spark, answers):
    df = spark.createDataFrame(
        [(str(i), json.dumps(a, ensure_ascii=i % 2 == 0)) for i, a in enumerate(answers)],
        "filename string, response string",
    )
    rows = flatten_record(parse_responses(df)).collect()
    for answer, row in zip(answers, rows):
        assert row["title"] == answer.get("title", "")
        assert row["abstract"] == answer.get("abstract", "")
        for field in ("authors", "key_findings", "keywords"):
            assert json.loads(row[field]) == answer.get(field, [])


@FEW
@given(st.dictionaries(st.integers(0, 3), st.lists(TEXT, max_size=12), max_size=4), st.integers(1, 5))
def test_assembly(spark, documents, run_length):
    rows = [(k, i, t) for k, texts in documents.items() for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows[::-1], "doc int, seq int, text string")
    found = assemble_text(df, "doc", "seq", run_length=run_length).collect()
    assert {r["doc"]: r["content"] for r in found} == {
        k: "\n".join(texts) for k, texts in documents.items() if texts
    }


@FEW
@given(st.lists(TEXT, min_size=1, max_size=15), TEXT)
def test_text_behind_an_answer_is_noticed(spark, bodies, tail):
    """An object followed by anything but blanks is refused; alone it is kept."""
    df = spark.createDataFrame(
        [(json.dumps({"title": b}), json.dumps({"title": b}) + tail) for b in bodies],
        "alone string, followed string",
    )
    blank = all(c in " \t\r\n" for c in tail)
    for column, kept in (("alone", True), ("followed", blank)):
        rows = parse_responses(df, response=column).collect()
        assert [r["error"] is None for r in rows] == [kept] * len(bodies)

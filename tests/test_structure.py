"""Stage 2 operators on hand-made rows."""

import json

import pytest

from pyspark.sql import functions as F

from leafmill.operators.metrics import structured_metrics
from leafmill.operators.structure import (
    filter_empty,
    keep_last,
    parse_responses,
    render_prompts,
    run_extractor,
)
from leafmill.schemas import PROMPT_MESSAGES

TEXTS = ["plain", r"\1 $2 {text} {url}", " ", "é\n", "", None]


def documents(spark, texts=TEXTS):
    return spark.createDataFrame(
        [(f"d{i}", text) for i, text in enumerate(texts)], "document_id string, content string"
    )


def test_filter_empty(spark):
    kept, rejected = filter_empty(documents(spark))
    assert {r["document_id"] for r in kept.collect()} == {"d0", "d1", "d2", "d3"}
    assert [(r["document_id"], r["error"]) for r in rejected.collect()] == [
        ("d4", "empty content"),
        ("d5", "empty content"),
    ]


def test_prompts(spark):
    rows = render_prompts(documents(spark)).orderBy("document_id").collect()
    for text, row in zip(TEXTS[:4], rows):
        system, user = row["messages"]
        assert system.asDict() == PROMPT_MESSAGES[0]
        assert user["content"] == PROMPT_MESSAGES[1]["content"].replace("{text}", text)
        assert "{url}" in user["content"]
    assert rows[4]["messages"] is None and rows[5]["messages"] is None


def test_prompts_fill_user_messages_only(spark):
    messages = [
        {"role": "system", "content": "{text}"},
        {"role": "user", "content": "{text}-{text} {url}"},
        {"role": "assistant", "content": "{text}"},
        {"role": "user", "content": "no marker"},
    ]
    df = documents(spark, ["a{text}{url}"]).withColumn("link", F.lit("http://x"))
    found = render_prompts(df, messages, url="link").first()["messages"]
    assert [m["content"] for m in found] == [
        "{text}",
        "a{text}{url}-a{text}{url} http://x",
        "{text}",
        "no marker",
    ]


def test_rule_answers(spark):
    text = "First line\nsecond line\nalpha betagamma alpha gamma delta omega zetas abcd"
    row = run_extractor(documents(spark, [text, "one", ""])).orderBy("document_id").collect()
    assert json.loads(row[0]["response"]) == {
        "title": "First line",
        "authors": [],
        "abstract": "second line",
        "keywords": ["betagamma", "second", "First", "alpha", "delta"],
        "methodology": "",
        "key_findings": [],
        "conclusions": "",
        "proposed_models": [],
        "future_work": "",
    }
    one = json.loads(row[1]["response"])
    assert (one["title"], one["abstract"], one["keywords"]) == ("one", "", [])
    assert (row[2]["response"], row[2]["error"]) == (None, "empty content")


def test_model_failure_stays_with_its_document(spark):
    def model(messages):
        text = messages[-1]["content"].rsplit("Paper content: ", 1)[1]
        if text == "boom":
            raise TimeoutError("no answer")
        return None if text == "none" else json.dumps({"title": text})

    df = documents(spark, ["a", "boom", "none", "", "b"]).coalesce(1)
    rows = run_extractor(render_prompts(df), model, carry=["content"]).collect()
    assert [(r["content"], r["response"], r["error"]) for r in rows] == [
        ("a", '{"title": "a"}', None),
        ("boom", None, "TimeoutError: no answer"),
        ("none", None, None),
        ("", None, "empty content"),
        ("b", '{"title": "b"}', None),
    ]
    parsed = parse_responses(run_extractor(render_prompts(df), model))
    assert parsed.where("error IS NULL").count() == 2


def test_setup_runs_once_per_partition(spark):
    def setup():
        calls = []

        def model(messages):
            calls.append(1)
            return str(len(calls))

        return model

    df = documents(spark, ["x"] * 300).coalesce(1)
    rows = run_extractor(render_prompts(df), setup=setup).collect()
    assert {int(r["response"]) for r in rows} == set(range(1, 301))


def test_hooks_leave_other_columns_alone_and_survive_odd_answers(spark):
    big = 9007199254740993
    df = spark.createDataFrame(
        [(big, None, "a"), (None, big, "surrogate"), (1, 2, "dict"), (3, None, "b")],
        "document_id bigint, other bigint, content string",
    ).coalesce(1)

    def model(messages):
        text = messages[-1]["content"].rsplit("Paper content: ", 1)[1]
        return {"surrogate": "\ud800", "dict": {"a": 1}}.get(text, text)

    found = run_extractor(render_prompts(df), model, carry=["other"]).collect()
    assert [(r[0], r[1], r["response"]) for r in found] == [
        (big, None, "a"), (None, big, None), (1, 2, None), (3, None, "b"),
    ]
    assert found[1]["error"].startswith("UnicodeEncodeError") and "dict" in found[2]["error"]


def fails_on(bad):
    calls = []

    def model(batch):
        calls.append(len(batch))
        texts = [messages[-1]["content"].rsplit("Paper content: ", 1)[1] for messages in batch]
        if set(texts) & set(bad):
            raise RuntimeError(f"call {len(calls)} failed")
        return [f"{t}:{len(calls)}:{len(batch)}" for t in texts]

    return model


@pytest.mark.parametrize("bad", [["d13"], ["d0"], ["d63"], ["d5", "d6", "d40"], []])
def test_a_failing_batch_loses_the_bad_documents_only(spark, bad):
    df = documents(spark, [f"d{i}" for i in range(64)]).coalesce(1)
    rows = run_extractor(render_prompts(df), setup=lambda: fails_on(bad), carry=["content"], batch_size=64).collect()
    lost = [r["content"] for r in rows if r["error"]]
    assert lost == bad and [r["content"] for r in rows] == [f"d{i}" for i in range(64)]
    assert all(r["response"].startswith(r["content"] + ":") for r in rows if not r["error"])
    calls = max([int(r["response"].split(":")[1]) for r in rows if r["response"]])
    assert calls <= 1 + 2 * 6 * max(len(bad), 0) + (not bad)


def test_batches_have_the_size_asked_for_and_skip_empty_documents(spark):
    df = documents(spark, ["a", "", "b", None, "c", "d", "e"]).coalesce(1)
    rows = run_extractor(render_prompts(df), setup=lambda: fails_on([]), batch_size=2).collect()
    assert [r["response"] and r["response"].split(":")[2] for r in rows] == ["2", None, "2", None, "2", "2", "1"]
    assert [r["error"] for r in rows] == [None, "empty content", None, "empty content", None, None, None]


def test_answers_that_do_not_pair_up_are_asked_again(spark):
    def model(batch):
        return ["x"] * (len(batch) + (len(batch) > 1)) if len(batch) != 1 else [5 if "odd" in str(batch) else "y"]

    df = documents(spark, ["a", "b", "odd", "c"]).coalesce(1)
    rows = run_extractor(render_prompts(df), model, batch_size=4).collect()
    assert [r["response"] for r in rows] == ["y", "y", None, "y"]
    assert "an answer is text" in rows[2]["error"]


@pytest.mark.parametrize("batch_size", [0, 3])
def test_calls_in_flight_are_bounded(spark, batch_size):
    def setup():
        import threading
        import time

        lock, now, most = threading.Lock(), [0], [0]

        def one(_):
            with lock:
                now[0] += 1
                most[0] = max(most[0], now[0])
            time.sleep(0.02)
            with lock:
                now[0] -= 1
            return str(most[0])

        return (lambda batch: [one(None)] * len(batch)) if batch_size else one

    df = documents(spark, [f"d{i}" for i in range(48)]).coalesce(1)
    rows = run_extractor(render_prompts(df), setup=setup, batch_size=batch_size, in_flight=4).collect()
    assert [r["document_id"] for r in rows] == [f"d{i}" for i in range(48)]
    assert 2 <= max(int(r["response"]) for r in rows) <= 4


def test_keep_last(spark):
    rows = [
        ("a", "sub/1", None),
        ("a", "sub/2", "x"),
        ("b", "1", "y"),
        (None, "1", "p"),
        (None, "2", "q"),
        ("c", None, "z"),
    ]
    df = spark.createDataFrame(rows, "name string, path string, text string")
    expected = {("a", "sub/2", "x"), ("b", "1", "y"), (None, "2", "q"), ("c", None, "z")}
    last = keep_last(df, "name", "path")
    assert last.columns == df.columns
    assert sorted(last.collect(), key=repr) == sorted(expected, key=repr)


def test_keep_last_leaves_one_of_equals(spark):
    rows = [
        ("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z"),  # a tie: the highest row
        ("b", None, "p"), ("b", None, "q"),  # no order at all
        ("c", 5, "same"), ("c", 5, "same"), ("c", 5, "same"),  # identical rows
        (None, 2, None), (None, 2, "n"), ("d", 1, "only"), ("e", None, "low"), ("e", 3, "high"),
    ]
    df = spark.createDataFrame(rows, "name string, place int, text string").repartition(5)
    last = keep_last(df, "name", "place")
    assert last.columns == df.columns
    assert sorted(map(tuple, last.collect()), key=repr) == sorted(
        [("a", 1, "y"), ("b", None, "q"), ("c", 5, "same"), (None, 2, None), ("d", 1, "only"), ("e", 3, "high")], key=repr
    )


def test_keep_last_ties_are_broken_by_columns_and_any_type(spark):
    df = spark.sql(
        """SELECT name, place, at, parse_json(j) AS answer, map('k', at) AS m FROM VALUES
           ('a', 1, 2, '{"x":1}'), ('a', 1, 9, '{"x":0}'), ('a', 1, 9, '{"x":0}'), ('b', 1, 1, '{}')
           AS t(name, place, at, j)"""
    )
    rows = keep_last(df, "name", "place", tie=["at"]).collect()
    assert sorted((r["name"], r["at"], r["answer"].toPython(), r["m"]) for r in rows) == [
        ("a", 9, {"x": 0}, {"k": 9}), ("b", 1, {}, {"k": 1}),
    ]


def test_keep_last_with_a_hot_key(spark):
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("name"),
        F.col("id").alias("path"),
    )
    last = keep_last(df, "name", "path")
    assert last.count() == 40001
    assert last.where("name = 0").first()["path"] == 59997


def test_structured_metrics(spark):
    three, two = documents(spark, ["a", "b", "c"]), documents(spark, ["a", "b"])
    assert structured_metrics(three, two).first().asDict() == {
        "documents_processed": 2,
        "success_rate": "66.67%",
    }
    none = three.limit(0)
    assert structured_metrics(none, none).first().asDict() == {
        "documents_processed": 0,
        "success_rate": "0%",
    }
    assert structured_metrics(three, none).first()["success_rate"] == "0.00%"

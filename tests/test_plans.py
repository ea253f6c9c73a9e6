"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from leafmill.operators.extract import assemble_text, extract_elements
from leafmill.operators.load import flatten_record
from leafmill.operators.structure import keep_last, parse_responses, render_prompts, run_extractor
from leafmill.sources.files import list_files

SF_DIR = "/root/testdata/sf0.001"
PYTHON = re.compile(r"MapInArrow|MapInPandas|BatchEvalPython|ArrowEvalPython|FlatMapGroups")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry_module.own_queries()))
def test_registered_plans(spark, name):
    text = plan(entry_module.own_queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in ("parser_hook", "model_hook", "batch_hook", "scan_pages", "scan_isolated"):
        assert not PYTHON.search(text)


def test_contents_are_not_read_for_a_listing(spark, tmp_path):
    (tmp_path / "a.pdf").write_text("x")
    schema = re.search(r"ReadSchema: (.*)", plan(list_files(spark, str(tmp_path)))).group(1)
    assert "content" not in schema and "length" in schema


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_answers_are_computed_and_parsed_once(documents):
    asked = run_extractor(documents, id_col="doc_id", content="text")
    text = plan(
        flatten_record(parse_responses(asked).where("error IS NULL"), key="doc_id")
    )
    assert text.count("StructsToJsonEvaluator(Map(),StructType(StructField(title") == 1
    assert text.count("parseJson") == 1
    assert "Exchange" not in text
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string>", text)


def test_row_operators_do_not_shuffle(documents):
    for df in (
        render_prompts(documents, content="text"),
        extract_elements(documents, "lines", key="doc_id", content="text"),
    ):
        assert "Exchange" not in plan(df)


def test_keep_last_sorts_and_shuffles_no_payload(documents):
    text = plan(keep_last(documents, "source", "doc_id"))
    assert "SortAggregate" not in text and "BroadcastHashJoin" in text
    for line in text.splitlines():
        if "Aggregate" in line or "Exchange hashpartitioning" in line:
            assert "text" not in line and "lang" not in line


def test_keep_last_without_broadcast(spark, documents):
    expected = keep_last(documents, "source", "doc_id").collect()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = keep_last(documents, "source", "doc_id")
        assert "SortMergeJoin" in plan(df)
        assert sorted(df.collect()) == sorted(expected)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_assembly_joins_before_each_shuffle(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    text = plan(assemble_text(rows, "conv_id", "turn"))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("partial_listagg") == 2
    assert "role" not in text


def test_filters_reach_the_scan(spark):
    text = plan(entry_module.query_by_position(spark, SF_DIR))
    assert "EqualTo(o_orderstatus,F)" in text and "GreaterThan(o_totalprice" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text


def test_spread_leaves_large_scans_alone(spark, tmp_path):
    from leafmill.operators.shaping import spread

    path = str(tmp_path / "many")
    spark.range(2000).repartition(40).write.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        many = spark.read.parquet(path)
        assert many.rdd.getNumPartitions() >= cores
        assert "Exchange" not in plan(spread(many, "id"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    few = spread(spark.read.parquet(path).coalesce(1), "id")
    assert few.rdd.getNumPartitions() == cores
    assert few.agg(F.sum("id")).first()[0] == sum(range(2000))

"""

``entry`` is the smoke check, ``queries`` has one callable per operator and
``oracle_sql`` the same result as SQL over the same tables.
"""

from __future__ import annotations

import functools
import importlib
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leafmill.functions.answers import json_field, metadata_json
from leafmill.functions.text import file_name, file_stem, iso_text
from leafmill.operators.extract import (
    assemble_text,
    assign_ids,
    explode_elements,
    extract_elements,
    join_elements,
    split_failures,
)
from leafmill.operators.load import (
    align_to_schema,
    append_records,
    flatten_record,
    load_table,
    recreate_table,
)
from leafmill.operators.metrics import (
    extraction_metrics,
    file_outcomes,
    load_metrics,
    structured_metrics,
)
from leafmill.operators.query import fetch_records, run_query, table_exists
from leafmill.operators.shaping import spread
from leafmill.operators.structure import (
    filter_empty,
    keep_last,
    parse_responses,
    project_fields,
    render_prompts,
    run_extractor,
    validate_records,
)
from leafmill.plans.refresh import refresh
from leafmill.schemas import EXTRACTED, PROMPT_MESSAGES, TABLE_COLUMNS
from leafmill.settings import shared_dir
from leafmill.sources.files import list_files, list_prefix, read_bytes, scan_documents
from leafmill.sources.json_documents import read_json_documents, read_json_objects
from leafmill.sources.sinks import write_dataset, write_files, write_extracted, write_structured

KEYWORD_REPORT = """
    SELECT lang, count(*) AS n_documents,
           sum(json_array_length(keywords)) AS n_keywords,
           count_if(title <> '') AS n_titled
    FROM {table} GROUP BY lang
"""

# Bytes that no UTF-8 text contains, put behind some documents to make them unreadable.
BAD_BYTES = bytearray(b"\xff\xfe")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents spread over all cores, for costly work on each text."""
    return spread(_table(spark, sf_dir, "documents"), "doc_id")


def _loadable(documents: DataFrame, date: Column) -> DataFrame:
    """Flat records of ``documents``, extracted by rule and parsed, with language and metadata."""
    kept, _ = filter_empty(documents, content="text")
    asked = run_extractor(
        kept.withColumn("filename", F.concat(F.lit("doc."), "doc_id", F.lit(".pdf"))),
        id_col="filename",
        content="text",
        carry=["lang"],
    )
    good, _ = split_failures(parse_responses(asked))
    flat = flatten_record(good, carry=("lang",))
    dated = flat.withColumn("extraction_date", F.lit(None).cast("string"))
    return dated.withColumn("metadata", metadata_json(F.col("extraction_date"), date))


FIXED_DATE = "2024-01-01T00:00:00"
WITH_LANG = {**TABLE_COLUMNS, "lang": "VARCHAR"}


def entry(spark: SparkSession) -> DataFrame:
    """Documents, titles and keywords per language, over records extracted by rule."""
    documents = _table(spark, "/root/testdata/sf0.001", "documents")
    records = align_to_schema(_loadable(documents, F.lit(FIXED_DATE)), WITH_LANG)
    records.createOrReplaceTempView("entry_documents")
    return run_query(spark, KEYWORD_REPORT.format(table="entry_documents"))


# --- Sources and sinks ------------------------------------------------------------


@functools.cache
def _pages_as_files(spark: SparkSession, sf_dir: str) -> str:
    """The pages as one text file each, in a shared folder written once per session."""
    pages = spread(_table(spark, sf_dir, "pages"), "page_id").select("html")
    return write_dataset(pages, shared_dir(spark, "pages"), "text", maxRecordsPerFile="1")


def scan_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = scan_documents(spark, _pages_as_files(spark, sf_dir), ".txt")
    return extract_elements(files, "markup").select(
        F.size("elements").cast("bigint").alias("n_elements"),
        F.md5(join_elements()).alias("content_md5"),
    )


def list_page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = list_files(spark, _pages_as_files(spark, sf_dir), ".txt")
    return files.select(F.endswith("name", F.lit(".txt")).alias("is_text"), "length")


@functools.cache
def _page_tree(spark: SparkSession, sf_dir: str) -> str:
    """The pages as files in nested folders with awkward names; every fifth file is empty."""
    pages = spread(_table(spark, sf_dir, "pages"), "page_id")
    kind = F.pmod("page_id", F.lit(3))
    rows = pages.select(
        F.when(F.pmod("page_id", F.lit(5)) > 0, F.col("html")).otherwise(F.lit("")).cast("binary").alias("data"),
        F.when(kind == 0, F.lit("_under")).when(kind == 1, F.lit("x[1]")).otherwise(F.lit("a b")).alias("top"),
        F.concat(F.lit("p"), "page_id", F.lit(".html")).alias("name"),
    )
    place = shared_dir(spark, "tree")
    write_files(rows.select(F.concat_ws("/", F.lit(place), "top", F.lit(".deep"), "name").alias("path"), "data"))
    return place


def list_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hidden folders, names with brackets and empty files are all listed."""
    files = list_files(spark, _page_tree(spark, sf_dir), recursive=True)
    return files.select("name", "length")


def list_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix is literal: a bracket in it is no pattern."""
    return list_prefix(spark, f"{_page_tree(spark, sf_dir)}/x[").select("name", "length")


def scan_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents of all files; those over 3000 bytes are set aside and counted."""
    files = scan_documents(spark, _page_tree(spark, sf_dir), ".html", max_bytes=3000)
    return extraction_metrics(extract_elements(files))


def read_page_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = read_bytes(spark, _pages_as_files(spark, sf_dir))
    return files.select(F.md5("content").alias("content_md5"))


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select(
        F.concat("source", F.lit("."), "lang", F.lit(".pdf")).alias("filename"),
        F.col("text").alias("content"),
        F.lit(FIXED_DATE).alias("extraction_date"),
        F.col("doc_id").alias("path"),
    )
    path = write_extracted(documents, shared_dir(spark, "extracted"))
    back = read_json_documents(spark, path, EXTRACTED, one_per_file=False)
    return back.select("stem", "filename", F.md5("content").alias("content_md5"), "extraction_date")


def structured_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _spread_documents(spark, sf_dir).select(
        F.concat("source", F.lit("."), "lang", F.lit(".pdf")).alias("filename"),
        F.col("doc_id").alias("path"),
        "text",
    )
    answers = parse_responses(
        run_extractor(documents, id_col="filename", content="text", carry=["path"])
    )
    path = write_structured(answers, shared_dir(spark, "structured"))
    back = read_json_documents(spark, path, one_per_file=False)
    data = F.variant_get("document", "$.json_data", "variant")
    return back.select(
        F.variant_get("document", "$.name", "string").alias("name"),
        F.variant_get(data, "$.title", "string").alias("title"),
        json_field(data, "keywords").alias("keywords"),
    )


def rewrite_by_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write replaces the documents that come again and leaves the others."""
    documents = _table(spark, sf_dir, "documents").select(
        F.concat("doc_id", F.lit(".pdf")).alias("filename"),
        F.col("text").alias("content"),
        F.lit(FIXED_DATE).alias("extraction_date"),
        F.col("doc_id").alias("path"),
    )
    place = shared_dir(spark, "rewritten")
    write_extracted(documents.where("path % 3 < 2"), place)
    second = documents.where("path % 3 > 0").withColumn("content", F.concat(F.lit("new "), "content"))
    write_extracted(second, place)
    back = read_json_documents(spark, place, EXTRACTED, one_per_file=False)
    return back.select("stem", F.md5("content").alias("content_md5"))


def json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pretty-printed object per file, read with a declared schema."""
    pages = spread(_table(spark, sf_dir, "pages"), "page_id")
    place = shared_dir(spark, "objects")
    body = F.to_json(F.struct("page_id", F.struct("url", F.array("html").alias("html")).alias("page")), {"pretty": "true"})
    path = F.concat(F.lit(f"{place}/"), "page_id", F.lit(".json"))
    write_files(pages.select(path.alias("path"), body.cast("binary").alias("data")))
    back = read_json_documents(spark, place, "page_id BIGINT, page STRUCT<url: STRING, html: ARRAY<STRING>>")
    return back.select("page_id", "page.url", F.md5(F.get("page.html", F.lit(0))).alias("html_md5"))


def pretty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pretty-printed objects, many to a file, read as one object a row."""
    documents = _table(spark, sf_dir, "documents")
    body = F.to_json(F.struct("doc_id", F.struct("lang", "text").alias("body")), {"pretty": "true"})
    place = write_dataset(documents.select(body.alias("value")), shared_dir(spark, "pretty"), "text")
    found = read_json_objects(spark, place)
    return found.select(
        F.variant_get("document", "$.doc_id", "bigint").alias("doc_id"),
        F.variant_get("document", "$.body.lang", "string").alias("lang"),
        F.md5(F.variant_get("document", "$.body.text", "string")).alias("text_md5"),
        "error",
    )


# --- Stage 1 ----------------------------------------------------------------------


def assemble_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return assemble_text(turns, "conv_id", "turn").select("conv_id", "content")


def assemble_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of uneven elements; conversations over 2000 bytes are set aside with their size."""
    turns = _table(spark, sf_dir, "conversations")
    joined = assemble_text(turns, "conv_id", "turn", run_length=3, run_bytes=200, max_bytes=2000)
    return joined.select("conv_id", F.md5("content").alias("content_md5"), "error")


def split_rejoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    rows = explode_elements(
        extract_elements(documents, "lines", key="doc_id", content="text"), key="doc_id"
    )
    joined = assemble_text(rows, "doc_id", "seq")
    return joined.select("doc_id", F.md5("content").alias("content_md5"))


def extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return extract_elements(pages, "markup", key="page_id", content="html").select(
        "page_id",
        F.size("elements").cast("bigint").alias("n_elements"),
        join_elements().alias("content"),
    )


def page_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    rows = explode_elements(
        extract_elements(pages, "markup", key="page_id", content="html"), key="page_id"
    )
    return rows.select("page_id", F.col("seq").cast("bigint").alias("seq"), "text")


def parser_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Python hook, with a parser that fails on the unreadable documents."""
    parsed = extract_elements(
        _some_unreadable(spark, sf_dir), lambda data: data.decode("utf-8").split("\n")
    )
    return parsed.select(
        F.col("path").alias("doc_id"),
        F.split_part(F.col("error"), F.lit(":"), F.lit(1)).alias("error"),
        F.md5(join_elements()).alias("content_md5"),
    )


def _some_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as file bytes; those in German are not valid UTF-8."""
    raw = F.col("text").cast("binary")
    return _table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("path"),
        F.when(F.col("lang") == "de", F.concat(raw, F.lit(BAD_BYTES)))
        .otherwise(raw)
        .alias("content"),
    )


def isolate_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = extract_elements(_some_unreadable(spark, sf_dir)).withColumn(
        "filename", F.col("path").cast("string")
    )
    return file_outcomes(extracted)


def extraction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction_metrics(extract_elements(_some_unreadable(spark, sf_dir)))


def document_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = assign_ids(_table(spark, sf_dir, "documents").select("doc_id"))
    return ids.agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.count_distinct("doc_uid").alias("n_ids"),
        F.min(F.length("doc_uid")).cast("bigint").alias("id_length"),
    )


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = file_name(F.col("url"))
    return _table(spark, sf_dir, "pages").select(
        "page_id", name.alias("filename"), file_stem(name).alias("stem")
    )


def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", iso_text(F.col("ts")).alias("iso"))


# --- Stage 2 ----------------------------------------------------------------------


def empty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.when(F.col("n_chars") >= 500, F.col("text")).otherwise(F.lit(""))
    kept, rejected = filter_empty(
        _table(spark, sf_dir, "documents").select("doc_id", content.alias("content"))
    )
    return kept.select(
        "doc_id", F.length("content").cast("bigint").alias("n_chars"),
        F.lit(None).cast("string").alias("error"),
    ).unionAll(rejected.select("doc_id", F.lit(0).cast("bigint"), "error"))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = render_prompts(_table(spark, sf_dir, "documents"), content="text")
    return rendered.select("doc_id", F.inline("messages")).select(
        "doc_id", "role", F.md5("content").alias("content_md5")
    )


def requested_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    whole = documents.select("doc_id", F.struct(*documents.columns).alias("answer"))
    wanted = ["n_chars", "unknown", "lang", "source"]
    return project_fields(whole, "answer", documents.schema, wanted).select(
        "doc_id", F.to_json("answer").alias("answer")
    )


def rule_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_extractor(
        _spread_documents(spark, sf_dir), id_col="doc_id", content="text"
    ).select("doc_id", "response")


def model_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Python hook, with a stand-in model that fails on one-line documents."""

    # Defined here so that it travels to workers that cannot import this module.
    def first_line(messages: list[dict[str, str]]) -> str:
        text = messages[-1]["content"].split("Paper content: ", 1)[1]
        title, rest = text.split("\n", 1)
        return json.dumps({"title": title, "n_rest": len(rest)}, ensure_ascii=False)

    asked = render_prompts(_table(spark, sf_dir, "documents"), content="text")
    answers = run_extractor(asked, first_line, id_col="doc_id")
    title = F.variant_get("answer", "$.title", "string")
    n_rest = F.variant_get("answer", "$.n_rest", "bigint")
    return parse_responses(answers).select(
        "doc_id",
        F.md5(title).alias("title_md5"),
        n_rest.alias("n_rest"),
        F.col("error").isNotNull().alias("failed"),
    )


def batch_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 16 documents, four calls in flight; the model fails on every 50th document."""

    # Defined here so that it travels to workers that cannot import this module.
    def sizes(batch: list[list[dict[str, str]]]) -> list[str]:
        texts = [messages[-1]["content"].split("Paper content: ", 1)[1] for messages in batch]
        if any(text.startswith("fail here") for text in texts):
            raise RuntimeError("the batch was refused")
        return [json.dumps({"n_lines": text.count("\n") + 1}) for text in texts]

    refused = F.pmod("doc_id", F.lit(50)) == 0
    texts = _table(spark, sf_dir, "documents").withColumn(
        "text", F.when(refused, F.concat(F.lit("fail here "), "text")).otherwise(F.col("text"))
    )
    asked = render_prompts(texts, content="text")
    answers = run_extractor(asked, sizes, id_col="doc_id", batch_size=16, in_flight=4)
    return parse_responses(answers).select(
        "doc_id", F.variant_get("answer", "$.n_lines", "bigint").alias("n_lines"), "error"
    )


def parse_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated keys, values that do not fit and broken answers, by kind of event."""
    kind, props = F.col("event_type"), F.col("props")
    changed = (
        F.when(kind == "error", F.replace(props, F.lit("}"), F.lit(', "k": -1}')))
        .when(kind == "purchase", F.regexp_replace(props, r"(\d+)", '"$1 pieces"'))
        .when(kind == "signup", F.concat(props, F.lit("}")))
        .otherwise(props)
    )
    events = _table(spark, sf_dir, "events").withColumn("response", changed)
    parsed = parse_responses(events, "k INT, more STRING")
    return parsed.select(
        "event_id",
        F.col("typed.k").alias("k"),
        F.variant_get("answer", "$.k", "string").alias("k_text"),
        F.col("corrupt").isNotNull().alias("is_corrupt"),
        "error",
    )


def validate_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects in lists in objects; each kind of event breaks the schema at another depth."""
    kind, key = F.col("event_type"), F.get_json_object("props", "$.k")
    body = (
        F.when(kind == "error", F.lit('{"o":{"zz":%s},"l":[{"y":"no"}]}'))
        .when(kind == "purchase", F.lit('{"o":{"x":%s},"l":[{"y":1},{"y":true},{"q":[],"p":0}]}'))
        .when(kind == "signup", F.lit('{"o":{"x":%s,"deep":{"list":[[1],["a"]]}},"l":null}'))
        .when(kind == "view", F.lit('{"o":[%s],"l":{},"m":{"a":{"z":1},"b":{}}}'))
        .otherwise(F.lit('{"o":{"x":%s,"deep":{"list":[[1],[]]}},"l":[],"m":{"a":{"z":false}}}'))
    )
    events = _table(spark, sf_dir, "events").withColumn("response", F.replace(body, F.lit("%s"), key))
    schema = _schema(
        "o STRUCT<x: INT NOT NULL, deep: STRUCT<list: ARRAY<ARRAY<INT>>>> NOT NULL, "
        "l ARRAY<STRUCT<y: INT>>, m MAP<STRING, STRUCT<z: BOOLEAN NOT NULL>>"
    )
    checked = validate_records(parse_responses(events), schema)
    return checked.select("event_id", F.array_join("violations", ",").alias("violations"))


def parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    parsed = parse_responses(events, "k int", response="props")
    return parsed.select(
        "event_id",
        F.col("typed.k").alias("k"),
        F.variant_get("answer", "$.k", "int").alias("k_variant"),
        "error",
    )


def parse_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each kind of event breaks its JSON in its own way; clicks stay whole."""
    kind, props = F.col("event_type"), F.col("props")
    broken = (
        F.when(kind == "error", F.expr("left(props, length(props) - 1)"))
        .when(kind == "purchase", F.concat(props, F.lit(" end")))
        .when(kind == "signup", F.concat(props, F.lit("}")))
        .when(kind == "view", F.concat(F.lit("["), props, F.lit("]")))
        .otherwise(F.concat(F.lit("  "), props, F.lit("\n")))
    )
    events = _table(spark, sf_dir, "events").withColumn("response", broken)
    key = F.variant_get("answer", "$.k", "int")
    return parse_responses(events).select("event_id", key.alias("k"), "error")


def validate_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each kind of event breaks the schema in its own way; clicks keep to it."""
    kind, props = F.col("event_type"), F.col("props")
    changed = (
        F.when(kind == "error", F.replace(props, F.lit('"k"'), F.lit('"z"')))
        .when(kind == "purchase", F.replace(props, F.lit("}"), F.lit(', "tags": ["a", 1]}')))
        .when(kind == "signup", F.replace(props, F.lit("}"), F.lit(', "b": 1, "a": 2}')))
        .when(kind == "view", F.regexp_replace(props, r"(\d+)", '"$1"'))
        .otherwise(F.replace(props, F.lit("}"), F.lit(', "tags": ["a"]}')))
    )
    events = _table(spark, sf_dir, "events").withColumn("response", changed)
    schema = _schema("k INT NOT NULL, tags ARRAY<STRING>")
    checked = validate_records(parse_responses(events), schema)
    return checked.select("event_id", F.array_join("violations", ",").alias("violations"))


def _schema(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def keep_last_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("source", "doc_id", "lang", "n_chars")
    return keep_last(documents, "source", "doc_id")


def keep_last_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = keep_last(_table(spark, sf_dir, "documents"), "source", "doc_id")
    return last.select("source", "doc_id", "lang", F.md5("text").alias("text_md5"))


def keep_last_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = keep_last(_table(spark, sf_dir, "events"), "user_id", "event_id")
    return last.withColumn("ts", iso_text(F.col("ts")))


def keep_last_tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most rows tie or have no order at all; one row of each user is left."""
    events = _table(spark, sf_dir, "events").select("user_id", "event_type", "event_id").withColumn(
        "rank", F.when(F.pmod("user_id", F.lit(3)) > 0, F.col("event_type"))
    )
    return keep_last(events, "user_id", "rank", tie=["event_id"])


def structured_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("source", "lang", "doc_id")
    kept = keep_last(
        documents.withColumn("filename", F.concat("source", F.lit("."), "lang")),
        "filename",
        "doc_id",
    )
    return structured_metrics(documents, kept)


# --- Stage 3 ----------------------------------------------------------------------


def _partial_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers from documents: English ones whole, German with nulls, the rest with gaps."""
    lines = F.split("text", "\n")
    whole = F.to_json(
        F.struct(
            F.element_at(lines, 1).alias("title"), lines.alias("authors"),
            F.col("n_chars").alias("abstract"),
        )
    )
    response = (
        F.when(F.col("lang") == "en", whole)
        .when(F.col("lang") == "de", F.lit('{"title":null,"authors":null,"abstract":true}'))
        .otherwise(F.to_json(F.struct(F.col("source").alias("conclusions"))))
    )
    documents = _table(spark, sf_dir, "documents").withColumn("response", response)
    return parse_responses(documents)


def json_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partial_answers(spark, sf_dir).select(
        "doc_id", F.md5(json_field(F.col("answer"), "authors")).alias("authors_md5")
    )


def metadata_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.when(F.col("lang") == "en", F.col("source"))
    return _table(spark, sf_dir, "documents").select(
        "doc_id", metadata_json(found, F.lit(FIXED_DATE)).alias("metadata")
    )


def flat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = _partial_answers(spark, sf_dir).withColumn(
        "filename", F.concat("doc_id", F.lit(".pdf"))
    )
    return align_to_schema(flatten_record(answers), TABLE_COLUMNS).drop("metadata")


def aligned_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = {"lang": "TEXT", "n_chars": "INTEGER", "company_name": "VARCHAR", "doc_id": "VARCHAR"}
    return align_to_schema(_table(spark, sf_dir, "documents"), mapping)


def load_and_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage 2 by rule, stage 3 into a real table, then SQL over it."""
    records = _loadable(_spread_documents(spark, sf_dir), F.lit(FIXED_DATE))
    load_table(records, "loaded_documents", WITH_LANG, shared_dir(spark, "loaded"))
    return run_query(spark, KEYWORD_REPORT.format(table="loaded_documents"))


def loaded_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _loadable(_spread_documents(spark, sf_dir), F.lit(FIXED_DATE))
    load_table(records, "loaded_records", WITH_LANG, shared_dir(spark, "loaded"))
    return spark.table("loaded_records")


def appended_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made from a column map, then filled by two appends of unlike frames."""
    mapping = {"document_id": "VARCHAR", "title": "TEXT", "report_year": "INTEGER"}
    recreate_table(spark, "appended", mapping, shared_dir(spark, "appended"))
    documents = _table(spark, sf_dir, "documents")
    first = append_records(
        documents.select(F.col("source").alias("title"), F.col("doc_id").alias("document_id")),
        "appended",
    )
    second = append_records(
        documents.select(F.col("doc_id").alias("document_id"), F.col("n_chars").alias("report_year")),
        "appended",
    )
    return run_query(
        spark,
        """SELECT count(*) AS n_rows, count(title) AS n_titles, sum(report_year) AS sum_years,
                  count(DISTINCT document_id) AS n_documents,
                  CAST(:first AS BIGINT) AS first_count, CAST(:second AS BIGINT) AS second_count
           FROM appended""",
        {"first": first, "second": second},
    )


def recreated_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made anew on the location of one that has rows: only the new rows count."""
    documents = _table(spark, sf_dir, "documents")
    place = shared_dir(spark, "recreated")
    recreate_table(spark, "recreated", {"doc_id": "BIGINT"}, place)
    append_records(documents, "recreated")
    recreate_table(spark, "recreated", {"doc_id": "BIGINT", "lang": "TEXT"}, place)
    added = append_records(documents.where("lang <> 'en'"), "recreated")
    return run_query(
        spark,
        """SELECT lang, count(*) AS n_rows, sum(doc_id) AS sum_ids,
                  CAST(:added AS BIGINT) AS n_added
           FROM recreated GROUP BY lang""",
        {"added": added},
    )


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    done = load_table(documents, "load_counts", {"doc_id": "BIGINT", "lang": "TEXT"},
                      shared_dir(spark, "loaded"))
    return load_metrics(spark.table("load_counts"), str(done["table_name"]))


# --- Queries ----------------------------------------------------------------------


def query_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    _table(spark, sf_dir, "orders").createOrReplaceTempView("orders_view")
    return run_query(
        spark,
        "SELECT o_orderkey, o_totalprice FROM orders_view "
        "WHERE o_orderstatus = ? AND o_totalprice > ?",
        ["F", 100000],
    )


def query_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    _table(spark, sf_dir, "orders").createOrReplaceTempView("orders_view")
    return run_query(
        spark,
        "SELECT o_orderpriority, count(*) AS n_orders FROM orders_view "
        "WHERE o_orderstatus <> :status GROUP BY o_orderpriority",
        {"status": "F"},
    )


def fetched_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a grouped query as dictionaries on the driver: one per priority."""
    _table(spark, sf_dir, "orders").createOrReplaceTempView("orders_view")
    records = fetch_records(
        spark,
        "SELECT o_orderpriority, count(*) AS n_orders, max(o_orderkey) AS last_key "
        "FROM orders_view WHERE o_totalprice > ? GROUP BY o_orderpriority",
        [50000],
        max_rows=1000,
    )
    return spark.createDataFrame(
        [tuple(record.values()) for record in records],
        "o_orderpriority string, n_orders bigint, last_key bigint",
    )


def catalog_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    load_table(_table(spark, sf_dir, "documents"), "checked", {"doc_id": "BIGINT"},
               shared_dir(spark, "checked"))
    return spark.table("checked").agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.lit(table_exists(spark, "checked")).alias("found"),
        F.lit(table_exists(spark, "no_such_table")).alias("found_other"),
    )


# --- Everything together ----------------------------------------------------------


def refresh_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three stages, from one file per page to a loaded table."""
    done = refresh(
        spark,
        _pages_as_files(spark, sf_dir),
        suffix=".txt",
        parser="markup",
        table="refreshed_pages",
        table_path=shared_dir(spark, "refreshed"),
    )
    return run_query(
        spark,
        """SELECT title, abstract, keywords, authors, report_year,
                  CAST(:rows AS BIGINT) AS rows_inserted
           FROM refreshed_pages""",
        {"rows": done.load["rows_inserted"]},
    )


def _optional(module: str):
    """A module of the training-data part, or None where that part has been taken out."""
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as error:
        if error.name in ("leafmill.llm", "leafmill.llm.queries", "corpus_pipeline"):
            return None
        raise


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each callable takes (spark, sf_dir)."""
    found = own_queries()
    if (training := _optional("leafmill.llm.queries")) is not None:
        found |= training.QUERIES
        if (pipeline := _optional("corpus_pipeline")) is not None:
            found["pipeline"] = pipeline.run
    return found


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of the document pipeline itself."""
    return {
        fn.__name__: fn
        for fn in (
            scan_pages,
            list_page_files,
            list_recursive,
            list_by_prefix,
            scan_isolated,
            read_page_bytes,
            json_round_trip,
            structured_round_trip,
            rewrite_by_stem,
            json_files,
            pretty_documents,
            assemble_conversation,
            assemble_bounded,
            split_rejoin,
            extract_pages,
            page_elements,
            parser_hook,
            isolate_failures,
            extraction_counts,
            document_ids,
            file_names,
            iso_dates,
            empty_documents,
            prompts,
            requested_fields,
            rule_answers,
            model_hook,
            batch_hook,
            parse_typed,
            validate_nested,
            parse_props,
            parse_broken,
            validate_props,
            keep_last_by_source,
            keep_last_wide,
            keep_last_event,
            keep_last_tied,
            structured_counts,
            json_columns,
            metadata_objects,
            flat_records,
            aligned_records,
            load_and_query,
            loaded_records,
            appended_records,
            recreated_table,
            load_counts,
            query_by_position,
            query_by_name,
            fetched_report,
            catalog_check,
            refresh_pages,
        )
    }


# --- The same results in SQL ------------------------------------------------------


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SYSTEM, _USER = (_literal(message["content"]) for message in PROMPT_MESSAGES)

_PAGE_ELEMENTS = """
    page_elements AS (
      SELECT page_id, html, list_filter(
        list_transform(
          string_split_regex(html,
            '(?s)<(?:!--.*?-->|(?i:script)\\b.*?</(?i:script)\\s*>'
            || '|(?i:style)\\b.*?</(?i:style)\\s*>|[^>]*>)'),
          lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13))),
        lambda x: x <> '') AS elements
      FROM pages)
"""


def _rule_fields(text: str) -> str:
    """Title, abstract and keywords of the rules, as SQL over a text expression."""
    return f"""
      split_part({text}, chr(10), 1) AS title,
      split_part({text}, chr(10), 2) AS abstract,
      list_transform(
        list_sort(list_transform(
          list_distinct(regexp_extract_all({text}, '[A-Za-z]{{5,}}')),
          lambda w: struct_pack(n := -length(w), word := w)))[1:5],
        lambda r: r.word) AS keywords
    """


_KEYWORD_REPORT_SQL = f"""
    WITH answers AS (SELECT lang, {_rule_fields("text")} FROM documents)
    SELECT lang, count(*) AS n_documents, CAST(sum(len(keywords)) AS BIGINT) AS n_keywords,
           count(*) FILTER (WHERE title <> '') AS n_titled
    FROM answers GROUP BY lang
"""

_LAST_BY_FILE = """
    last_by_file AS (
      SELECT source || '.' || lang AS stem, arg_max(text, doc_id) AS text
      FROM documents GROUP BY source || '.' || lang)
"""

_PARTIAL_SQL = """
    partial AS (
      SELECT doc_id, source, lang, n_chars, string_split(text, chr(10)) AS lines FROM documents)
"""


def oracle_sql() -> dict[str, str]:
    """The equivalent SQL, with the same column names, of each query that SQL can express."""
    found = own_sql()
    if (training := _optional("leafmill.llm.queries")) is not None:
        found |= training.SQL
        pipeline = _optional("corpus_pipeline")
        if pipeline is not None and pipeline.ORACLE_SQL is not None:
            found["pipeline"] = pipeline.ORACLE_SQL
    return found


def own_sql() -> dict[str, str]:
    return {
        "scan_pages": f"""
            WITH {_PAGE_ELEMENTS}
            SELECT len(elements) AS n_elements,
                   md5(array_to_string(elements, chr(10))) AS content_md5
            FROM page_elements""",
        "list_page_files": """
            SELECT true AS is_text, octet_length(encode(html)) + 1 AS length FROM pages""",
        "list_recursive": """
            SELECT CASE page_id % 3 WHEN 0 THEN '_under' WHEN 1 THEN 'x[1]' ELSE 'a b' END
                     || '/.deep/p' || page_id || '.html' AS name,
                   CASE WHEN page_id % 5 > 0 THEN octet_length(encode(html)) ELSE 0 END AS length
            FROM pages""",
        "list_by_prefix": """
            SELECT 'p' || page_id || '.html' AS name,
                   CASE WHEN page_id % 5 > 0 THEN octet_length(encode(html)) ELSE 0 END AS length
            FROM pages WHERE page_id % 3 = 1""",
        "scan_isolated": """
            WITH sized AS (
              SELECT page_id % 5 = 0 OR octet_length(encode(html)) <= 3000 AS good FROM pages)
            SELECT count_if(good)::BIGINT AS files_processed, count(*) AS total_files,
                   count_if(NOT good)::BIGINT AS failed_files,
                   printf('%.2f%%', count_if(good) / count(*) * 100.0) AS success_rate
            FROM sized""",
        "read_page_bytes": "SELECT md5(html || chr(10)) AS content_md5 FROM pages",
        "json_round_trip": f"""
            WITH {_LAST_BY_FILE}
            SELECT stem, stem || '.pdf' AS filename, md5(text) AS content_md5,
                   '{FIXED_DATE}' AS extraction_date
            FROM last_by_file""",
        "structured_round_trip": f"""
            WITH {_LAST_BY_FILE},
            answers AS (SELECT stem, {_rule_fields("text")} FROM last_by_file)
            SELECT stem || '_structured' AS name, title,
                   CAST(to_json(keywords) AS VARCHAR) AS keywords
            FROM answers""",
        "assemble_conversation": """
            SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS content
            FROM conversations GROUP BY conv_id""",
        "assemble_bounded": """
            WITH joined AS (
              SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS content
              FROM conversations GROUP BY conv_id),
            sized AS (SELECT *, octet_length(encode(content)) AS n FROM joined)
            SELECT conv_id, CASE WHEN n <= 2000 THEN md5(content) END AS content_md5,
                   CASE WHEN n > 2000 THEN n || ' bytes are more than 2000' END AS error
            FROM sized""",
        "rewrite_by_stem": """
            SELECT CAST(doc_id AS VARCHAR) AS stem,
                   md5(CASE WHEN doc_id % 3 > 0 THEN 'new ' || text ELSE text END) AS content_md5
            FROM documents""",
        "json_files": "SELECT page_id, url, md5(html) AS html_md5 FROM pages",
        "pretty_documents": """
            SELECT doc_id, lang, md5(text) AS text_md5, CAST(NULL AS VARCHAR) AS error
            FROM documents""",
        "batch_hook": """
            SELECT doc_id, CASE WHEN doc_id % 50 > 0
                   THEN length(text) - length(replace(text, chr(10), '')) + 1 END AS n_lines,
                   CASE WHEN doc_id % 50 = 0 THEN 'RuntimeError: the batch was refused' END AS error
            FROM documents""",
        "parse_typed": """
            WITH found AS (
              SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
            SELECT event_id,
                   CASE event_type WHEN 'error' THEN -1 WHEN 'purchase' THEN NULL
                     WHEN 'signup' THEN NULL ELSE k END AS k,
                   CASE event_type WHEN 'error' THEN '-1' WHEN 'purchase' THEN k || ' pieces'
                     WHEN 'signup' THEN NULL ELSE CAST(k AS VARCHAR) END AS k_text,
                   event_type = 'purchase' AS is_corrupt,
                   CASE WHEN event_type = 'signup' THEN 'not a JSON object' END AS error
            FROM found""",
        "validate_nested": """
            SELECT event_id, CASE event_type
                WHEN 'error' THEN 'missing:o.x,extra:o.zz,type:l[].y'
                WHEN 'purchase' THEN 'type:l[].y,extra:l[].p,extra:l[].q'
                WHEN 'signup' THEN 'type:o.deep.list[]'
                WHEN 'view' THEN 'type:o,type:l,type:m{}.z,missing:m{}.z'
                ELSE '' END AS violations
            FROM events""",
        "keep_last_tied": """
            WITH ranked AS (
              SELECT user_id, event_type, event_id,
                     CASE WHEN user_id % 3 > 0 THEN event_type END AS rank FROM events)
            SELECT * FROM ranked QUALIFY row_number() OVER (
              PARTITION BY user_id ORDER BY rank DESC NULLS LAST, event_id DESC) = 1""",
        "split_rejoin": "SELECT doc_id, md5(text) AS content_md5 FROM documents",
        "extract_pages": f"""
            WITH {_PAGE_ELEMENTS}
            SELECT page_id, len(elements) AS n_elements,
                   array_to_string(elements, chr(10)) AS content
            FROM page_elements""",
        "page_elements": f"""
            WITH {_PAGE_ELEMENTS}
            SELECT page_id, unnest(range(len(elements))) AS seq, unnest(elements) AS text
            FROM page_elements""",
        "parser_hook": """
            SELECT doc_id,
                   CASE WHEN lang = 'de' THEN 'UnicodeDecodeError' END AS error,
                   CASE WHEN lang <> 'de' THEN md5(text) END AS content_md5
            FROM documents""",
        "isolate_failures": """
            SELECT CAST(doc_id AS VARCHAR) AS filename, lang <> 'de' AS processed,
                   CASE WHEN lang = 'de' THEN 'not valid UTF-8' END AS error
            FROM documents""",
        "extraction_counts": """
            SELECT count(*) FILTER (WHERE lang <> 'de') AS files_processed,
                   count(*) AS total_files,
                   count(*) FILTER (WHERE lang = 'de') AS failed_files,
                   printf('%.2f%%', count(*) FILTER (WHERE lang <> 'de') / count(*) * 100.0)
                     AS success_rate
            FROM documents""",
        "document_ids": """
            SELECT count(*) AS n_documents, count(*) AS n_ids, CAST(36 AS BIGINT) AS id_length
            FROM documents""",
        "file_names": """
            WITH named AS (SELECT page_id, string_split(url, '/')[-1] AS filename FROM pages)
            SELECT page_id, filename, regexp_replace(filename, '(.)\\.[^.]+$', '\\1') AS stem
            FROM named""",
        "iso_dates": """
            SELECT event_id,
                   regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.000000$', '') AS iso
            FROM events""",
        "empty_documents": """
            SELECT doc_id, CASE WHEN n_chars >= 500 THEN n_chars ELSE 0 END AS n_chars,
                   CASE WHEN n_chars < 500 THEN 'empty content' END AS error
            FROM documents""",
        "prompts": f"""
            SELECT doc_id, 'system' AS role, md5({_SYSTEM}) AS content_md5 FROM documents
            UNION ALL
            SELECT doc_id, 'user', md5(replace({_USER}, '{{text}}', text)) FROM documents""",
        "requested_fields": """
            SELECT doc_id, CAST(to_json(struct_pack(
                     n_chars := n_chars, lang := lang, source := source)) AS VARCHAR) AS answer
            FROM documents""",
        "rule_answers": f"""
            WITH answers AS (SELECT doc_id, {_rule_fields("text")} FROM documents)
            SELECT doc_id, CAST(to_json(struct_pack(
                     title := title, authors := []::VARCHAR[], abstract := abstract,
                     keywords := keywords, methodology := '', key_findings := []::VARCHAR[],
                     conclusions := '', proposed_models := []::VARCHAR[], future_work := ''))
                   AS VARCHAR) AS response
            FROM answers""",
        "model_hook": """
            SELECT doc_id,
                   CASE WHEN contains(text, chr(10))
                        THEN md5(split_part(text, chr(10), 1)) END AS title_md5,
                   CASE WHEN contains(text, chr(10))
                        THEN n_chars - length(split_part(text, chr(10), 1)) - 1 END AS n_rest,
                   NOT contains(text, chr(10)) AS failed
            FROM documents""",
        "parse_props": """
            SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
                   CAST(json_extract(props, '$.k') AS INTEGER) AS k_variant,
                   CAST(NULL AS VARCHAR) AS error
            FROM events""",
        "parse_broken": """
            WITH broken AS (
              SELECT event_id, CASE event_type
                WHEN 'error' THEN left(props, length(props) - 1)
                WHEN 'purchase' THEN props || ' end'
                WHEN 'signup' THEN props || '}'
                WHEN 'view' THEN '[' || props || ']'
                ELSE '  ' || props || chr(10) END AS response
              FROM events),
            checked AS (
              SELECT event_id, response, CASE WHEN json_valid(response)
                THEN json_type(response) = 'OBJECT' ELSE false END AS good
              FROM broken)
            SELECT event_id,
                   CASE WHEN good THEN CAST(json_extract(response, '$.k') AS INTEGER) END AS k,
                   CASE WHEN NOT good THEN 'not a JSON object' END AS error
            FROM checked""",
        "validate_props": """
            SELECT event_id, CASE event_type
                WHEN 'error' THEN 'missing:k,extra:z'
                WHEN 'purchase' THEN 'type:tags'
                WHEN 'signup' THEN 'extra:a,extra:b'
                WHEN 'view' THEN 'type:k'
                ELSE '' END AS violations
            FROM events""",
        "keep_last_by_source": """
            SELECT source, max(doc_id) AS doc_id, arg_max(lang, doc_id) AS lang,
                   arg_max(n_chars, doc_id) AS n_chars
            FROM documents GROUP BY source""",
        "keep_last_wide": """
            SELECT source, max(doc_id) AS doc_id, arg_max(lang, doc_id) AS lang,
                   md5(arg_max(text, doc_id)) AS text_md5
            FROM documents GROUP BY source""",
        "keep_last_event": """
            SELECT max(event_id) AS event_id, user_id,
                   regexp_replace(strftime(arg_max(ts, event_id), '%Y-%m-%dT%H:%M:%S.%f'),
                                  '\\.000000$', '') AS ts, arg_max(event_type, event_id) AS event_type,
                   arg_max(value, event_id) AS value, arg_max(props, event_id) AS props
            FROM events GROUP BY user_id""",
        "structured_counts": """
            SELECT count(DISTINCT source || '.' || lang) AS documents_processed,
                   printf('%.2f%%', count(DISTINCT source || '.' || lang) / count(*) * 100.0)
                     AS success_rate
            FROM documents""",
        "json_columns": f"""
            WITH {_PARTIAL_SQL}
            SELECT doc_id, md5(CASE lang WHEN 'en' THEN CAST(to_json(lines) AS VARCHAR)
                                         WHEN 'de' THEN 'null' ELSE '[]' END) AS authors_md5
            FROM partial""",
        "metadata_objects": f"""
            SELECT doc_id, CAST(to_json(struct_pack(
                     extraction_date := CASE WHEN lang = 'en' THEN source END,
                     processing_date := '{FIXED_DATE}')) AS VARCHAR) AS metadata
            FROM documents""",
        "flat_records": f"""
            WITH {_PARTIAL_SQL}
            SELECT doc_id || '.pdf' AS document_id, doc_id || '.pdf' AS filename,
                   CAST(NULL AS VARCHAR) AS company_name, CAST(NULL AS INTEGER) AS report_year,
                   CASE lang WHEN 'en' THEN lines[1] WHEN 'de' THEN NULL ELSE '' END AS title,
                   CASE lang WHEN 'en' THEN CAST(to_json(lines) AS VARCHAR)
                             WHEN 'de' THEN 'null' ELSE '[]' END AS authors,
                   CASE lang WHEN 'en' THEN CAST(n_chars AS VARCHAR)
                             WHEN 'de' THEN 'true' ELSE '' END AS abstract,
                   '[]' AS keywords, '' AS methodology, '[]' AS key_findings,
                   CASE WHEN lang IN ('en', 'de') THEN '' ELSE source END AS conclusions,
                   '[]' AS proposed_models, '' AS future_work
            FROM partial""",
        "aligned_records": """
            SELECT lang, CAST(n_chars AS INTEGER) AS n_chars,
                   CAST(NULL AS VARCHAR) AS company_name, CAST(doc_id AS VARCHAR) AS doc_id
            FROM documents""",
        "load_and_query": _KEYWORD_REPORT_SQL,
        "loaded_records": f"""
            WITH answers AS (SELECT doc_id, lang, {_rule_fields("text")} FROM documents)
            SELECT 'doc.' || doc_id || '.pdf' AS document_id,
                   'doc.' || doc_id || '.pdf' AS filename,
                   CAST(NULL AS VARCHAR) AS company_name, CAST(NULL AS INTEGER) AS report_year,
                   title, '[]' AS authors, abstract,
                   CAST(to_json(keywords) AS VARCHAR) AS keywords,
                   '' AS methodology, '[]' AS key_findings, '' AS conclusions,
                   '[]' AS proposed_models, '' AS future_work,
                   '{{"extraction_date":null,"processing_date":"{FIXED_DATE}"}}' AS metadata,
                   lang
            FROM answers""",
        "appended_records": """
            SELECT 2 * count(*) AS n_rows, count(source) AS n_titles,
                   CAST(sum(n_chars) AS BIGINT) AS sum_years,
                   count(DISTINCT doc_id) AS n_documents, count(*) AS first_count,
                   count(*) AS second_count
            FROM documents""",
        "recreated_table": """
            SELECT lang, count(*) AS n_rows, CAST(sum(doc_id) AS BIGINT) AS sum_ids,
                   CAST(sum(count(*)) OVER () AS BIGINT) AS n_added
            FROM documents WHERE lang <> 'en' GROUP BY lang""",
        "load_counts": """
            SELECT count(*) AS rows_inserted, 'load_counts' AS table_name FROM documents""",
        "query_by_position": """
            SELECT o_orderkey, o_totalprice FROM orders
            WHERE o_orderstatus = 'F' AND o_totalprice > 100000""",
        "query_by_name": """
            SELECT o_orderpriority, count(*) AS n_orders FROM orders
            WHERE o_orderstatus <> 'F' GROUP BY o_orderpriority""",
        "fetched_report": """
            SELECT o_orderpriority, count(*) AS n_orders, max(o_orderkey) AS last_key
            FROM orders WHERE o_totalprice > 50000 GROUP BY o_orderpriority""",
        "catalog_check": """
            SELECT count(*) AS n_documents, true AS found, false AS found_other FROM documents""",
        "refresh_pages": f"""
            WITH {_PAGE_ELEMENTS},
            texts AS (
              SELECT array_to_string(elements, chr(10)) AS text FROM page_elements
              WHERE len(elements) > 0),
            answers AS (SELECT {_rule_fields("text")} FROM texts)
            SELECT title, abstract, CAST(to_json(keywords) AS VARCHAR) AS keywords,
                   '[]' AS authors, CAST(NULL AS INTEGER) AS report_year,
                   count(*) OVER () AS rows_inserted
            FROM answers""",
    }

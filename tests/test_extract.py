"""Stage 1 operators on hand-made rows."""

import os
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from leafmill.functions.text import iso_text, markup_elements
from leafmill.operators.extract import (
    assemble_runs,
    assemble_text,
    assign_ids,
    explode_elements,
    extract_elements,
    join_elements,
    split_failures,
    with_extraction_date,
    with_file_names,
)
from leafmill.operators.metrics import extraction_metrics, file_outcomes


def files(spark, **contents):
    return spark.createDataFrame(
        [(path, None if data is None else bytearray(data)) for path, data in contents.items()],
        "path string, content binary",
    )


def by_path(df):
    return {row["path"]: row for row in df.collect()}


def test_lines(spark):
    rows = by_path(
        extract_elements(files(spark, a="x\n\ny\n".encode(), e=b"", bad=b"\xff", none=None))
    )
    assert rows["a"]["elements"] == ["x", "", "y", ""]
    assert rows["e"]["elements"] == [""]
    assert (rows["bad"]["elements"], rows["bad"]["error"]) == (None, "not valid UTF-8")
    assert (rows["none"]["elements"], rows["none"]["error"]) == (None, "no content")


def test_markup(spark):
    html = (
        "<!-- a <b>no</b>\n --><Style>p{}</sTyle><p>One <b>two</b>\n</p>"
        "<script type='x'>if (a<b) {}</script  > three <br/>\t"
    )
    row = spark.range(1).select(markup_elements(F.lit(html)).alias("e")).first()
    assert row["e"] == ["One", "two", "three"]


def test_python_parser_failure_stays_with_its_file(spark):
    def parser(data):
        if data == b"boom":
            raise RuntimeError("broken file")
        return [part for part in data.decode().split(",") if part]

    data = {f"f{i}": b"boom" if i == 3 else f"{i},x".encode() for i in range(20)}
    data["empty"] = b""
    df = extract_elements(files(spark, **data).coalesce(1), parser)
    rows = by_path(df)
    assert len(rows) == 21
    assert rows["f3"]["error"] == "RuntimeError: broken file" and rows["f3"]["elements"] is None
    assert rows["f4"]["elements"] == ["4", "x"]
    assert rows["empty"]["elements"] == []
    good, errors = split_failures(df)
    assert (good.count(), errors.count()) == (20, 1)
    assert by_path(good.select("path", join_elements().alias("c")))["empty"]["c"] == ""


def test_documents_without_elements_survive_the_round_trip(spark):
    df = extract_elements(files(spark, a=b"1,2", empty=b""), lambda d: [x for x in d.decode().split(",") if x])
    text = by_path(assemble_text(explode_elements(df), "path", "seq"))
    assert (text["a"]["content"], text["empty"]["content"]) == ("1\n2", "")


def test_one_document_with_a_third_of_all_rows(spark):
    """Runs split the large document; the text is whole and in order."""
    small = spark.range(40000).select(
        (F.col("id") % 2000 + 1).alias("doc"),
        F.floor(F.col("id") / 2000).alias("seq"),
        F.concat(F.lit("s"), "id").alias("text"),
    )
    large = spark.range(20000).select(
        F.lit(0).cast("bigint").alias("doc"), F.col("id").alias("seq"),
        F.col("id").cast("string").alias("text"),
    )
    rows = small.unionAll(large).repartition(8)
    runs = assemble_runs(rows, "doc", "seq", run_length=500)
    assert runs.where("doc = 0").count() == 40
    text = {r["doc"]: r["content"] for r in assemble_text(rows, "doc", "seq", run_length=500).collect()}
    assert len(text) == 2001
    assert text[0] == "\n".join(str(i) for i in range(20000))
    assert text[7] == "\n".join(f"s{6 + 2000 * i}" for i in range(20))


def test_names_ids_and_dates(spark):
    paths = ["file:/x/a.b.pdf", "s3a://b/.pdf", "x", "/p/a.", "/p/a b%20.PDF", "/p/..a"]
    df = with_file_names(spark.createDataFrame([(p,) for p in paths], "path string"))
    assert [tuple(r) for r in df.select("filename", "stem").collect()] == [
        ("a.b.pdf", "a.b"),
        (".pdf", ".pdf"),
        ("x", "x"),
        ("a.", "a."),
        ("a b%20.PDF", "a b%20"),
        ("..a", "."),
    ]
    ids = [r["doc_uid"] for r in assign_ids(df).collect()]
    assert len(set(ids)) == len(paths) and all(len(i) == 36 for i in ids)
    dated = with_extraction_date(df, F.lit("2024-01-02 03:04:05").cast("timestamp"))
    assert dated.first()["extraction_date"] == "2024-01-02T03:04:05"
    now = with_extraction_date(df).select("extraction_date").distinct().collect()
    assert len(now) == 1 and now[0][0][10] == "T"


def test_iso_text_keeps_six_digits(spark):
    for text, expected in [
        ("2024-01-02 03:04:05.1", "2024-01-02T03:04:05.100000"),
        ("2024-01-02 03:04:05.000001", "2024-01-02T03:04:05.000001"),
        ("2024-01-02 03:04:05", "2024-01-02T03:04:05"),
    ]:
        df = spark.range(1).select(iso_text(F.lit(text).cast("timestamp")).alias("t"))
        assert df.first()["t"] == expected


def test_metrics(spark):
    df = spark.createDataFrame(
        [("a.pdf", None), ("b.pdf", "boom"), ("c.pdf", None)], "filename string, error string"
    )
    assert extraction_metrics(df).first().asDict() == {
        "files_processed": 2,
        "total_files": 3,
        "failed_files": 1,
        "success_rate": "66.67%",
    }
    assert extraction_metrics(df.limit(0)).first().asDict() == {
        "files_processed": 0,
        "total_files": 0,
        "failed_files": 0,
        "success_rate": None,
    }
    outcomes = file_outcomes(df).orderBy("filename").collect()
    assert [r["processed"] for r in outcomes] == [True, False, True]


def test_runs_are_bounded_by_bytes(spark):
    """Short elements, long ones, empty and NULL ones; every run ends once it is full."""
    sizes = [0, 5, 900, 1, 1, 2000, 0, 0, 300, 300, 300, 300, 50] * 40
    rows = [("d", i, None if i % 17 == 3 else chr(97 + i % 26) * n) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "doc string, seq bigint, text string").repartition(7)
    runs = assemble_runs(df, "doc", "seq", run_length=64, run_bytes=1000).orderBy("run").collect()
    assert max(len(r["text"] or "") for r in runs) <= 1000 + 2001
    assert len(runs) > len(sizes) // 64 + 1
    whole = "\n".join(t for *_, t in rows if t is not None)
    assert "\n".join(r["text"] for r in runs if r["text"] is not None) == whole
    found = assemble_text(df, "doc", "seq", run_length=64, run_bytes=1000).first()
    assert found["content"] == whole and found["error"] is None


def test_a_document_too_long_for_a_value_is_a_row_with_an_error(spark):
    rows = [("a", 0, "x" * 60), ("a", 1, "y" * 39), ("b", 0, "x" * 60), ("b", 1, "y" * 40), (None, 0, "z" * 101), ("c", 0, None)]
    df = spark.createDataFrame(rows, "doc string, seq bigint, text string")
    found = {r["doc"]: (r["content"], r["error"]) for r in assemble_text(df, "doc", "seq", max_bytes=100).collect()}
    assert found == {
        "a": ("x" * 60 + "\n" + "y" * 39, None), "c": ("", None),
        "b": (None, "101 bytes are more than 100"), None: (None, "101 bytes are more than 100"),
    }


HUNDRED_MEGABYTES = """
from pyspark.sql import SparkSession, functions as F
from leafmill.operators.extract import assemble_runs, assemble_text
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.driver.host", "127.0.0.1").config("spark.sql.shuffle.partitions", "2").getOrCreate()
text = F.when(F.col("id") == 700, F.expr("repeat(if(id > 0, 'x', 'y'), 104857600)")).otherwise("short")
df = spark.range(2000).select(F.lit(1).alias("doc"), F.col("id").alias("seq"), text.alias("text"))
runs = [r.n for r in assemble_runs(df, "doc", "seq").select(F.octet_length("text").alias("n")).collect()]
assert len(runs) == 2 and sum(runs) + 1 == 1999 * 6 + 104857600, runs
whole = assemble_text(df, "doc", "seq").select(F.octet_length("content").alias("n"), "error").first()
assert tuple(whole) == (1999 * 6 + 104857600, None), whole
"""


def test_one_element_of_a_hundred_megabytes(tmp_path):
    """In a session with more memory than that of the other tests."""
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--driver-memory 4g pyspark-shell", "PYTHONPATH": str(Path(__file__).parent.parent)}
    done = subprocess.run([sys.executable, "-c", HUNDRED_MEGABYTES], env=env, cwd=tmp_path, capture_output=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:].decode()

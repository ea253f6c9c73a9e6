"""Scans, JSON documents and sinks on temporary folders."""

import hashlib
import json
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from leafmill.operators.extract import extract_elements
from leafmill.operators.metrics import extraction_metrics
from leafmill.schemas import EXTRACTED, FILES, LISTING
from leafmill.sources import files as sources_files
from leafmill.sources.files import list_files, list_prefix, read_bytes, scan_documents
from leafmill.sources.listing import list_tree, open_by_uri
from leafmill.sources.json_documents import read_json_documents, read_json_objects
from leafmill.sources.sinks import _line_files, write_dataset, write_extracted, write_structured


@pytest.fixture
def folder(tmp_path):
    contents = {
        "a.pdf": "top",
        "sub/a.pdf": "below",
        "sub/b.c.pdf": "b",
        "sub/deep er/p%20q é[1].pdf": "p",
        "U.PDF": "u",
        ".h.pdf": "hidden",
        "_u.pdf": "hidden",
        "n.txt": "n",
        "empty.pdf": "",
        "k=v/z.pdf": "z",
    }
    for name, text in contents.items():
        (tmp_path / "raw" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "raw" / name).write_text(text, encoding="utf-8")
    (tmp_path / "raw2").mkdir()
    (tmp_path / "raw2" / "other.pdf").write_text("o")
    (tmp_path / "none").mkdir()
    return tmp_path


def names(df):
    return sorted(row["name"] for row in df.collect())


def test_scan(spark, folder):
    df = scan_documents(spark, str(folder / "raw"))
    assert df.schema == FILES
    found = {row["path"].split("/raw/")[1]: bytes(row["content"]) for row in df.collect()}
    assert found == {
        ".h.pdf": b"hidden",
        "_u.pdf": b"hidden",
        "empty.pdf": b"",
        "a.pdf": b"top",
        "sub/a.pdf": b"below",
        "sub/b.c.pdf": b"b",
        "sub/deep er/p%20q é[1].pdf": b"p",
        "k=v/z.pdf": b"z",
    }
    assert scan_documents(spark, str(folder / "raw"), "[1].pdf").count() == 1


@pytest.mark.parametrize("place", ["none", "missing"])
def test_nothing_to_scan(spark, folder, place):
    df = scan_documents(spark, str(folder / place))
    assert df.schema == FILES and df.count() == 0
    assert list_files(spark, str(folder / place)).count() == 0


def test_list(spark, folder):
    for root in (str(folder / "raw"), f"file://{folder}/raw/", f"file:{folder}/x/../raw"):
        assert names(list_files(spark, root)) == [".h.pdf", "U.PDF", "_u.pdf", "a.pdf", "empty.pdf", "n.txt"]
    top = list_files(spark, str(folder / "raw"), "a.pdf")
    assert names(top) == ["a.pdf"] and top.schema == LISTING
    assert names(list_files(spark, str(folder / "raw"), ".pdf", recursive=True)) == [
        ".h.pdf",
        "_u.pdf",
        "a.pdf",
        "empty.pdf",
        "k=v/z.pdf",
        "sub/a.pdf",
        "sub/b.c.pdf",
        "sub/deep er/p%20q é[1].pdf",
    ]
    with pytest.raises(ValueError):
        list_files(spark, "relative/folder")


def test_list_prefix(spark, folder):
    found = list_prefix(spark, f"{folder}/raw", ".pdf")
    all_names = [".h.pdf", "_u.pdf", "a.pdf", "a.pdf", "b.c.pdf", "empty.pdf", "other.pdf", "p%20q é[1].pdf", "z.pdf"]
    assert names(found) == all_names
    assert names(list_prefix(spark, f"{folder}/raw/su")) == ["a.pdf", "b.c.pdf", "p%20q é[1].pdf"]
    assert names(list_prefix(spark, f"{folder}/raw/")) == sorted([n for n in all_names if n != "other.pdf"] + ["U.PDF", "n.txt"])
    for literal in ("raw/sub/deep er/p%20q é[1]", "raw/sub/deep er/p%20q é["):
        assert names(list_prefix(spark, f"{folder}/{literal}")) == ["p%20q é[1].pdf"]
    for pattern in ("ra*", "raw/sub/[a-z]", "raw/{a,n}", "missing", "raw/sub/deep er/p%20q é[1].pdfx"):
        assert list_prefix(spark, f"{folder}/{pattern}").count() == 0


@pytest.fixture
def odd_folder(tmp_path):
    for name, data in {"a": b"1", "b": b"22", "zero": b"", ".h": b"333", "_u": b"4", "x[1]/q": b"55555"}.items():
        (tmp_path / "odd" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "odd" / name).write_bytes(data)
    return tmp_path / "odd"


def test_every_file_is_found_under_its_literal_name(spark, odd_folder):
    found = extract_elements(scan_documents(spark, str(odd_folder), ""))
    assert extraction_metrics(found).first().total_files == 6
    assert [r["path"].rsplit("/", 1)[1] for r in scan_documents(spark, f"{odd_folder}/x[1]", "").collect()] == ["q"]
    assert names(list_files(spark, f"{odd_folder}/x[1]")) == ["q"]
    assert names(list_files(spark, f"{odd_folder}/x[1]/q")) == ["q"]
    assert list_files(spark, f"{odd_folder}/x*").count() == 0


@pytest.mark.parametrize("entries", [1, 3, 20_000])
def test_rounds_of_listing_find_all_however_small(spark, tmp_path, entries):
    expected = set()
    for i in range(6):
        for j in range(4):
            place = tmp_path / "tree" / f"d{i}" / ("e" * (j + 1)) / f"f{j}"
            place.mkdir(parents=True)
            for k in range(i):
                (place / f"{k}.pdf").write_text("x" * k)
                expected.add((f"d{i}/{'e' * (j + 1)}/f{j}/{k}.pdf", k))
    (tmp_path / "tree" / "d0" / "loop").symlink_to(tmp_path / "tree")
    found = list_tree(spark, str(tmp_path / "tree"), task_entries=entries).collect()
    assert {(r.path.split("/tree/")[1], r.length) for r in found} == expected
    assert len(found) == len(expected) and {r.error for r in found} == {None}


def test_names_that_are_no_text(spark, tmp_path):
    (tmp_path / "n").mkdir()
    with open(bytes(tmp_path / "n") + b"/\xff.pdf", "wb") as file:
        file.write(b"x")
    row = scan_documents(spark, str(tmp_path / "n")).first()
    assert row.error == "the name is not valid UTF-8" and row.path.endswith("/\\udcff.pdf")


def test_times_and_sizes_equal_those_of_sparks_reader(spark, folder):
    raw = f"{folder}/raw/sub"
    ours = list_files(spark, raw, recursive=True).select("path", "length", "modificationTime")
    theirs = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(raw)
    assert sorted(ours.collect()) == sorted(theirs.select("path", "length", "modificationTime").collect())


def test_a_file_that_cannot_be_read_is_a_row_with_an_error(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "good.pdf").write_bytes(b"fine")
    (raw / "long.pdf").write_bytes(b"x" * 1001)
    (raw / "gone.pdf").symlink_to(tmp_path / "nothing")
    (raw / "sick.pdf").symlink_to("/proc/self/mem")  # opens but does not read
    (raw / "late.pdf").write_bytes(b"here when listed")
    files = scan_documents(spark, str(raw), max_bytes=1000)
    (raw / "late.pdf").unlink()
    rows = {r.path.rsplit("/", 1)[1]: r for r in files.collect()}
    assert {n for n, r in rows.items() if r.error is None} == {"good.pdf"}
    assert bytes(rows["good.pdf"].content) == b"fine"
    assert "1001 bytes are more than 1000" in rows["long.pdf"].error and rows["long.pdf"].content is None
    assert "FileNotFoundError" in rows["late.pdf"].error and "FileNotFoundError" in rows["gone.pdf"].error
    for parser in ("lines", lambda data: [data.decode()]):
        extracted = extract_elements(files, parser)
        assert extraction_metrics(extracted).first().asDict() == {
            "files_processed": 1, "total_files": 5, "failed_files": 4, "success_rate": "20.00%",
        }
        told = {r.path.rsplit("/", 1)[1]: r.error for r in extracted.collect()}
        assert told == {n: r.error for n, r in rows.items()}


def test_a_folder_that_cannot_be_listed_is_a_row_with_an_error(spark, folder):
    def open_fs(uri):
        if uri.endswith("/sub"):
            raise PermissionError("no")
        return open_by_uri(uri)

    rows = {r.path.split("/raw/")[1]: r.error for r in scan_documents(spark, f"{folder}/raw", open_fs=open_fs).collect()}
    assert rows == {
        ".h.pdf": None, "_u.pdf": None, "a.pdf": None, "empty.pdf": None, "k=v/z.pdf": None, "sub": "PermissionError: no",
    }


def test_schemes_that_only_hadoop_knows(spark, folder):
    """Listed on the driver, read by Spark; what its reader skips keeps a row."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.shelf.link./in", f"file://{folder}")
    root = "viewfs://shelf/in/raw"
    assert names(list_files(spark, root)) == [".h.pdf", "U.PDF", "_u.pdf", "a.pdf", "empty.pdf", "n.txt"]
    assert names(list_prefix(spark, f"{root}/su")) == ["a.pdf", "b.c.pdf", "p%20q é[1].pdf"]
    rows = {r.path.split("/raw/")[1]: r for r in scan_documents(spark, root).collect()}
    assert bytes(rows["a.pdf"].content) == b"top" and bytes(rows["empty.pdf"].content) == b""
    assert rows["_u.pdf"].error == rows[".h.pdf"].error == "skipped by Spark's reader"
    assert sum(r.error is None for r in rows.values()) == 6
    assert list_files(spark, "viewfs://shelf/in/missing").count() == 0


def test_large_folders_are_read_in_bounded_batches(spark, tmp_path):
    (tmp_path / "many").mkdir()
    for i in range(30):
        (tmp_path / "many" / f"{i}.pdf").write_bytes(bytes([i]) * (3 << 20))
    rows = scan_documents(spark, str(tmp_path / "many")).select("path", F.md5("content").alias("m"), "error").collect()
    assert len(rows) == 30 and {r.error for r in rows} == {None}
    assert {r.m for r in rows} == {hashlib.md5(bytes([i]) * (3 << 20)).hexdigest() for i in range(30)}


def test_read_bytes(spark, folder):
    assert bytes(read_bytes(spark, str(folder / "raw/sub/a.pdf")).first()["content"]) == b"below"
    with pytest.raises(AnalysisException):
        read_bytes(spark, str(folder / "nope.pdf"))


def test_read_json(spark, tmp_path):
    docs = [{"stem": "Ł", "n": 1, "tags": ["a"]}, {"stem": "b", "extra": {"z": 1, "a": None}}]
    for i, doc in enumerate(docs):
        (tmp_path / f"{i}.json").write_text(json.dumps(doc, indent=2), encoding="utf-8")
    typed = read_json_documents(spark, str(tmp_path), "stem STRING, n INT")
    assert {tuple(r) for r in typed.collect()} == {("Ł", 1), ("b", None)}
    anything = read_json_documents(spark, str(tmp_path)).select(F.to_json("document").alias("j"))
    assert sorted((json.loads(r["j"]) for r in anything.collect()), key=str) == sorted(
        docs, key=str
    )
    (tmp_path / "bad.json").write_text("{bad")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|malformed"):
        read_json_documents(spark, str(tmp_path), "stem STRING, n INT").collect()


def test_write_extracted_replaces_same_stem(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = [
        ("x/a.pdf", "a.pdf", "old", "2024-01-01T00:00:00"),
        ("y/a.pdf", "a.pdf", "new Ł", "2024-01-01T00:00:00"),
        ("b.pdf", "b.pdf", "line\nline", "2024-01-01T00:00:00"),
    ]
    df = spark.createDataFrame(
        rows, "path string, filename string, content string, extraction_date string"
    )
    for _ in range(2):
        write_extracted(df, out)
        back = read_json_documents(spark, out, EXTRACTED, one_per_file=False).collect()
        assert {(r["stem"], r["content"]) for r in back} == {("a", "new Ł"), ("b", "line\nline")}


def test_write_structured(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.sql(
        """SELECT * FROM VALUES ('a.pdf', '1', '{"title":"x"}'), ('a.pdf', '2', '{"title":null}'),
           ('b.c.pdf', '1', '{}') AS t(filename, path, j)"""
    ).withColumn("answer", F.parse_json("j"))
    write_structured(df, out)
    back = read_json_documents(spark, out, one_per_file=False).select(F.to_json("document"))
    found = {json.loads(r[0])["name"]: json.loads(r[0])["json_data"] for r in back.collect()}
    assert found == {"a_structured": {"title": None}, "b.c_structured": {}}


def test_write_dataset(spark, tmp_path):
    lines = spark.createDataFrame([("a",), ("é",)], "value string")
    write_dataset(lines, str(tmp_path / "t"), "text")
    assert {r["value"] for r in spark.read.text(str(tmp_path / "t")).collect()} == {"a", "é"}
    with pytest.raises(ValueError):
        write_dataset(lines, str(tmp_path / "p"), "parquet")


def spark_writes(df, path):
    df.write.option("maxRecordsPerFile", "1").text(path)


def contents(path):
    return sorted(p.read_bytes() for p in path.glob("part-*.txt"))


def test_one_file_per_row_is_what_sparks_writer_makes(spark, tmp_path):
    texts = ["a", "a", "é\nb", "", None, "x" * 100_000] * 7
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    spark_writes(df, str(tmp_path / "theirs"))
    for _ in range(2):  # the second write replaces the first
        assert write_dataset(df, f"{tmp_path}/o d[1]/ours", "text", maxRecordsPerFile="1") == f"{tmp_path}/o d[1]/ours"
        assert contents(tmp_path / "o d[1]/ours") == contents(tmp_path / "theirs") == sorted(f"{t or ''}\n".encode() for t in texts)
    assert len(list((tmp_path / "o d[1]/ours").iterdir())) == len(texts) + 2  # _SUCCESS and its checksum
    assert [p.name for p in (tmp_path / "o d[1]").iterdir()] == ["ours"]
    empty = spark.createDataFrame([], "text string")
    write_dataset(empty, str(tmp_path / "empty"), "text", maxRecordsPerFile="1")
    assert contents(tmp_path / "empty") == [] and spark.read.text(str(tmp_path / "empty")).count() == 0


def test_a_failing_write_of_single_rows_leaves_what_was_there(spark, tmp_path):
    out = str(tmp_path / "out")
    write_dataset(spark.range(4).select(F.col("id").cast("string")), out, "text", maxRecordsPerFile="1")
    bad = spark.range(4).select(F.when(F.col("id") < 3, "new").otherwise(F.raise_error(F.lit("no"))).alias("t"))
    with pytest.raises(Exception, match="no"):
        write_dataset(bad, out, "text", maxRecordsPerFile="1")
    assert contents(tmp_path / "out") == [b"0\n", b"1\n", b"2\n", b"3\n"]
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    with pytest.raises(AnalysisException):
        write_dataset(spark.range(2), str(tmp_path / "numbers"), "text", maxRecordsPerFile="1")


def test_a_task_run_again_names_its_rows_alike(spark):
    texts = ["b", None, "a", "b", ""]
    made = [
        _line_files(spark.createDataFrame([(t,) for t in some], "t string").coalesce(1), "/x").collect()
        for some in (texts, texts[::-1])
    ]
    one, two = ([(r.path.split("-")[1], bytes(r.data)) for r in rows] for rows in made)
    assert one == two and len(dict(one)) == 5


def test_single_rows_go_to_schemes_that_only_hadoop_knows(spark, tmp_path):
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.apart.link./in", f"file://{tmp_path}")
    write_dataset(spark.createDataFrame([("a",), ("b",)], "t string"), "viewfs://apart/in/out", "text", maxRecordsPerFile="1")
    assert [t for t in contents(tmp_path / "out") if t] == [b"a\n", b"b\n"]


def test_a_task_writes_thousands_of_files_in_seconds(spark, tmp_path):
    df = spark.range(0, 3000, 1, 1).select(F.col("id").cast("string"))
    write_dataset(df.limit(3), str(tmp_path / "out"), "text", maxRecordsPerFile="1")
    begun = time.monotonic()
    write_dataset(df, str(tmp_path / "out"), "text", maxRecordsPerFile="1")
    assert time.monotonic() - begun < 15  # by Spark's writer 36
    assert len(contents(tmp_path / "out")) == 3000


def test_reading_tasks_are_bounded_in_files(spark, tmp_path, monkeypatch):
    for i in range(50):
        (tmp_path / f"{i}.pdf").write_bytes(b"%d" % i)
    monkeypatch.setattr(sources_files, "TASK_FILES", 4)
    found = scan_documents(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == 13
    assert sorted(bytes(r.content) for r in found.collect()) == sorted(b"%d" % i for i in range(50))


def extracted(spark, rows):
    return spark.createDataFrame(
        [(f"p/{s}", s and f"{s}.pdf", c, "d") for s, c in rows],
        "path string, filename string, content string, extraction_date string",
    )


def stems(spark, out):
    return {r["stem"]: r["content"] for r in read_json_documents(spark, out, EXTRACTED, one_per_file=False).collect()}


def test_a_second_write_leaves_the_other_stems(spark, tmp_path):
    out = str(tmp_path / "out")
    write_extracted(extracted(spark, [(f"s{i}", "old") for i in range(300)] + [("é/ü=%", "odd")]), out)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("part-*")}
    write_extracted(extracted(spark, [("s7", "new"), ("fresh", "new")]), out, buckets=8)
    found = stems(spark, out)
    assert len(found) == 302
    assert {k for k, v in found.items() if v == "new"} == {"s7", "fresh"}
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("part-*")}
    assert len(before.items() - after.items()) <= 2  # the folders of other stems are not touched
    write_extracted(extracted(spark, [(None, "no name")]), out)
    assert len(stems(spark, out)) == 303
    write_extracted(extracted(spark, [("only", "one")]), out, keep_others=False)
    assert stems(spark, out) == {"only": "one"}


def test_an_older_layout_is_taken_over(spark, tmp_path):
    out = str(tmp_path / "out")
    write_extracted(extracted(spark, [("a", "1"), ("b", "1")]), out, keep_others=False)
    write_extracted(extracted(spark, [("b", "2"), ("c", "2")]), out)
    assert stems(spark, out) == {"a": "1", "b": "2", "c": "2"}
    write_extracted(extracted(spark, [("a", "3")]), out)
    assert stems(spark, out) == {"a": "3", "b": "2", "c": "2"}


def test_answers_of_other_names_stay(spark, tmp_path):
    out = str(tmp_path / "out")
    for rows in ("('a.pdf', '1', '{\"t\":[1,null]}'), ('b.pdf', '1', '{}')", "('b.pdf', '2', '{\"t\":2}')"):
        df = spark.sql(f"SELECT * FROM VALUES {rows} AS t(filename, path, j)").withColumn("answer", F.parse_json("j"))
        write_structured(df, out)
    back = read_json_documents(spark, out, "name STRING, json_data VARIANT", one_per_file=False)
    assert {r["name"]: r["json_data"].toPython() for r in back.collect()} == {
        "a_structured": {"t": [1, None]}, "b_structured": {"t": 2},
    }


OBJECTS = [{"a": 1, "n": {"deep": [{"x": "}\n{"}, {}]}}, {"t": "é \" ] ,"}, {"l": []}]


@pytest.mark.parametrize("layout", ["one after another", "list", "one line", "windows"])
def test_pretty_printed_objects(spark, tmp_path, layout):
    made = [json.dumps(o, indent=4, ensure_ascii=False) for o in OBJECTS]
    indent = ""
    if layout == "list":
        text, indent = json.dumps(OBJECTS, indent=4, ensure_ascii=False) + "\n", "    "
    elif layout == "one line":
        (tmp_path / "1.json").write_text(json.dumps(OBJECTS[1]) + "\n", encoding="utf-8")
        made = [made[0], made[2]]
        text = "\n".join(made)
    else:
        text = "\n".join(made) + "\n"
    data = text.replace("\n", "\r\n") if layout == "windows" else text
    (tmp_path / "0.json").write_bytes(data.encode())
    rows = read_json_objects(spark, str(tmp_path), indent=indent).collect()
    assert sorted(json.dumps(r["document"].toPython(), sort_keys=True) for r in rows) == sorted(
        json.dumps(o, sort_keys=True) for o in OBJECTS
    )
    assert {r["error"] for r in rows} == {None}


def test_broken_objects_are_rows_with_an_error(spark, tmp_path):
    (tmp_path / "0.json").write_text('{\n  "a": 1\n}\n{\n  "a": oops\n}\n{\n  "b": 2\n}\n{\n  "cut": ')
    (tmp_path / "1.json").write_text("")
    rows = read_json_objects(spark, str(tmp_path)).collect()
    assert [r["document"].toPython() for r in rows if r["error"] is None] == [{"a": 1}, {"b": 2}]
    assert sorted(r["text"] for r in rows if r["error"]) == ['{\n  "a": oops', '{\n  "cut": ']


def test_a_large_file_of_objects_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "big.json").write_text("\n".join(json.dumps({"i": i, "t": "x" * 50}, indent=2) for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = read_json_objects(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 8
        found = df.select(F.variant_get("document", "$.i", "int").alias("i")).agg(F.count("i"), F.sum("i")).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tuple(found) == (20_000, sum(range(20_000)))

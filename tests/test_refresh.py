"""The whole pipeline on a small folder."""

import json

from pyspark.sql import functions as F

from leafmill.operators.query import fetch_records
from leafmill.plans.refresh import refresh


def model(messages):
    text = messages[-1]["content"].rsplit("Paper content: ", 1)[1]
    if text.startswith("refuse"):
        raise ConnectionError("refused")
    if text.startswith("garble"):
        return "{bad"
    return json.dumps({"title": text, "keywords": ["Ł"], "future_work": None})


def test_refresh(spark, tmp_path):
    raw = tmp_path / "raw"
    contents = {
        "a.pdf": b"older",
        "sub/a.pdf": b"newer",
        "z/a.pdf": b"refuse this",  # fails, so the earlier file of that name stays
        "b.c.pdf": b"only",
        "g.pdf": b"garble",
        "bad.pdf": b"\xff",
        "n.txt": b"not a document",
    }
    for name, data in contents.items():
        (raw / name).parent.mkdir(parents=True, exist_ok=True)
        (raw / name).write_bytes(data)

    done = refresh(
        spark,
        str(raw),
        parser="lines",
        extractor=model,
        table="refreshed",
        work_path=str(tmp_path / "work"),
        table_path=str(tmp_path / "table"),
        extracted_path=str(tmp_path / "extracted"),
        structured_path=str(tmp_path / "structured"),
    )

    assert done.extraction.first().asDict() == {
        "files_processed": 5,
        "total_files": 6,
        "failed_files": 1,
        "success_rate": "83.33%",
    }
    assert done.structure.first().asDict() == {
        "documents_processed": 2,
        "success_rate": "40.00%",
    }
    assert done.load == {"rows_inserted": 2, "table_name": "refreshed"}
    assert [r["filename"] for r in done.extraction_errors.collect()] == ["bad.pdf"]
    assert {r["error"] for r in done.structure_errors.collect()} == {
        "ConnectionError: refused",
        "not a JSON object",
    }
    assert done.documents.select("doc_uid").distinct().count() == 5

    records = fetch_records(spark, "SELECT * FROM refreshed ORDER BY document_id", max_rows=None)
    assert [(r["document_id"], r["title"], r["keywords"]) for r in records] == [
        ("a.pdf", "newer", '["Ł"]'),
        ("b.c.pdf", "only", '["Ł"]'),
    ]
    assert all(r["future_work"] is None and r["abstract"] == "" for r in records)
    dates = json.loads(records[0]["metadata"])
    assert list(dates) == ["extraction_date", "processing_date"] and all(dates.values())

    stems = spark.read.json(str(tmp_path / "extracted"), schema="stem string, content string")
    assert {tuple(r) for r in stems.drop("bucket").collect()} == {
        ("a", "refuse this"),
        ("b.c", "only"),
        ("g", "garble"),
    }
    names = spark.read.json(str(tmp_path / "structured"), schema="name string")
    assert {r["name"] for r in names.collect()} == {"a_structured", "b.c_structured"}

    done.forget()
    assert not (tmp_path / "work").exists()
    assert spark.table("refreshed").count() == 2 and names.count() == 2


def test_unreadable_files_are_counted_and_the_rest_is_loaded(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "good.pdf").write_text("fine")
    (raw / "gone.pdf").symlink_to(tmp_path / "nothing")
    (raw / "sick.pdf").symlink_to("/proc/self/mem")
    done = refresh(
        spark, str(raw), parser="lines", table="partly_read",
        work_path=str(tmp_path / "work"), table_path=str(tmp_path / "table"),
    )
    assert done.extraction.first().asDict() == {
        "files_processed": 1, "total_files": 3, "failed_files": 2, "success_rate": "33.33%",
    }
    assert {r["filename"] for r in done.extraction_errors.collect()} == {"gone.pdf", "sick.pdf"}
    assert [r["title"] for r in spark.table("partly_read").collect()] == ["fine"]


def test_a_second_refresh_leaves_datasets_of_other_documents(spark, tmp_path):
    for name, text in (("a", "one"), ("b", "two")):
        raw = tmp_path / name
        raw.mkdir()
        (raw / f"{name}.pdf").write_text(text)
        refresh(
            spark, str(raw), parser="lines", table="in_turn", table_path=str(tmp_path / "table"),
            extracted_path=str(tmp_path / "extracted"), structured_path=str(tmp_path / "structured"),
        ).forget()
    stems = spark.read.json(str(tmp_path / "extracted"), schema="stem string, content string").select("stem", "content")
    assert {tuple(r) for r in stems.collect()} == {("a", "one"), ("b", "two")}
    names = spark.read.json(str(tmp_path / "structured"), schema="name string")
    assert {r["name"] for r in names.collect()} == {"a_structured", "b_structured"}


def test_refresh_of_an_empty_folder(spark, tmp_path):
    done = refresh(
        spark,
        str(tmp_path / "missing"),
        parser="lines",
        table="refreshed_empty",
        work_path=str(tmp_path / "work"),
        table_path=str(tmp_path / "table"),
    )
    assert done.extraction.first()["total_files"] == 0
    assert done.structure.first()["success_rate"] == "0%"
    assert done.load["rows_inserted"] == 0
    assert spark.table("refreshed_empty").count() == 0


def test_model_is_asked_once_per_document(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    for i in range(8):
        (tmp_path / "raw" / f"{i}.pdf").write_text(str(i))
    calls = spark.sparkContext.accumulator(0)

    def counting(messages):
        calls.add(1)
        return "{}"

    done = refresh(
        spark,
        str(tmp_path / "raw"),
        parser="lines",
        extractor=counting,
        table="asked_once",
        work_path=str(tmp_path / "work"),
        table_path=str(tmp_path / "table"),
        structured_path=str(tmp_path / "structured"),
    )
    assert done.structure.first()["documents_processed"] == 8
    assert done.structure_errors.count() == 0
    assert done.answers.select(F.to_json("answer").alias("j")).distinct().first()["j"] == "{}"
    assert calls.value == 8

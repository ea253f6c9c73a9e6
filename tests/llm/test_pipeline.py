"""Each stage against a brute-force version on the stage's own input."""

import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from leafmill.llm.language import UNKNOWN, WINDOW, learn_languages
from tests.llm.brute import contaminated, drop_lines, groups

SF_DIR = "/root/testdata/sf0.001"


def known(text, model):
    """Whether a language is recognised, by plain convolution window by window."""
    if not re.search(r"[^\W\d_]", text or ""):
        return False
    data, total = text.encode(), 0.0
    for at in range(0, len(data), WINDOW):
        part = np.frombuffer(data[at : at + WINDOW], np.uint8)
        inputs = model.embedding[np.append(part, np.zeros(WINDOW - len(part), np.uint8))]
        peaks = []
        for kernel in model.filters:
            span = WINDOW - len(kernel) + 1
            peaks.append(sum(inputs[k : k + span] @ kernel[k] for k in range(len(kernel))).max(axis=0))
        score = np.concatenate(peaks) @ model.weights + model.bias
        chance = np.exp(score - score.max())
        total = total + len(part) * chance / chance.sum()
    best = int(total.argmax())
    return model.languages[best] != UNKNOWN and total[best] / len(data) >= 0.5


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = spark.createDataFrame(
        [(900_001, None, "en", "s", 0), (900_002, "12 34 ...", None, None, None), (900_003, "", "en", "s", 0),
         (900_004, "qzx wvk jpt fgh bdz zqk xcv " * 30, "en", "s", 0)],
        docs.schema,
    )
    docs = docs.unionByName(extra)
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, SF_DIR)
        path = str(tmp_path / f"{number}-{name}")
        out.write.parquet(path)
        after = spark.read.parquet(path)
        if name != "packing":
            assert after.columns == docs.columns
            found = {r.doc_id: r.text for r in after.collect()}
        if name == "language":
            model = learn_languages(docs, with_none=True)
            assert set(found) == {i for i, t in before if known(t, model)}
            assert not {900_001, 900_002, 900_003, 900_004} & set(found) and len(found) >= 0.97 * (len(before) - 4)
        elif name == "lines":
            expected = drop_lines([t for _, t in before], 10, distinct_texts=True)
            assert found == {i: e[2] for (i, _), e in zip(before, expected, strict=True)}
        elif name == "near_duplicates":
            expected = groups(before, 5)
            assert set(found) == {i for (i, _), (n, c) in zip(before, expected, strict=True) if not n or c == i}
        elif name == "decontaminate":
            assert set(found) == {i for i, t in before if not contaminated(t, items, 10)[1]}
        else:
            tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            pieces = {(r.doc_id, r.start): r for r in after.collect()}
            rows = 0
            for i, t in before:
                ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
                at = 0
                while at < len(ids):
                    piece = pieces[i, at]
                    assert piece.ids_crc32 == zlib.crc32(ids[at : at + piece.length].tobytes())
                    at, rows = at + piece.length, rows + 1
                assert at == len(ids)
            assert rows == len(pieces)
        docs = after
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "lines", "near_duplicates", "decontaminate", "packing",
    ]


def test_an_empty_table_stays_empty(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == 0


@pytest.mark.parametrize("number", range(4))
def test_columns_of_any_name_pass_unchanged(spark, number):
    names = ["__text_key", "__id_key", "key", "id_key", "doc", "__found", "lang_pred", "score", "text_key", "code", "node", "n"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40)
    for name in names:
        docs = docs.selectExpr("*", f"concat('{name}', doc_id) AS `{name}`")
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    out = corpus_pipeline.STAGES[number][1](spark, docs, SF_DIR)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) > 20
    assert all(r[name] == f"{name}{r.doc_id}" for r in rows for name in names)


def test_a_run_leaves_the_last_stage_alone_and_equals_the_stages(spark):
    base = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in base.iterdir()}
    found = corpus_pipeline.run(spark, SF_DIR)
    left = sorted(p.name.rsplit("-", 1)[0] for p in base.iterdir() if p.name not in before)
    assert left == ["corpus", "packing"]
    corpus = next(p for p in base.iterdir() if p.name not in before and p.name.startswith("corpus"))
    assert [p.name for p in corpus.iterdir()] == ["4-decontaminate"]
    kept = spark.read.parquet(str(corpus / "4-decontaminate"))
    assert {r.doc_id for r in found.collect()} == {r.doc_id for r in kept.collect()}

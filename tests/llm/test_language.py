import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm.language import (
    UNKNOWN, WIDTHS, LanguageModel, identify_language, known_language, learn_languages, pooled, _gradients,
)

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return learn_languages(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2"))


def test_looked_up_responses_equal_convolution():
    rng = np.random.default_rng(1)
    made = LanguageModel(
        ["a"], rng.normal(size=(256, 8)), [rng.normal(size=(w, 8, 5)) for w in WIDTHS], None, None
    )
    windows = rng.integers(0, 256, (6, 40)).astype(np.uint8)
    expected = []
    for kernel in made.filters:
        w = len(kernel)
        inputs = np.stack([made.embedding[windows[:, k : 40 - w + 1 + k]] for k in range(w)])
        expected.append(np.einsum("kntd,kdf->ntf", inputs, kernel).max(1))
    assert np.allclose(pooled(windows, made.tables()), np.concatenate(expected, 1), atol=1e-3)


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    params = [rng.normal(size=(256, 8))] + [rng.normal(size=(w, 8, 24)) for w in WIDTHS]
    params += [rng.normal(size=(72, 3)) * 0.3, np.zeros(3)]
    x, y = rng.integers(0, 256, (4, 30)).astype(np.uint8), np.array([0, 1, 2, 1])

    def loss():
        e, *filters, weights, bias = params
        features = []
        for kernel in filters:
            w = len(kernel)
            inputs = np.stack([e[x[:, k : 30 - w + 1 + k]] for k in range(w)])
            features.append(np.einsum("kntd,kdf->ntf", inputs, kernel).max(1))
        z = np.concatenate(features, 1) @ weights + bias
        z = z - z.max(1, keepdims=True)
        return -(z - np.log(np.exp(z).sum(1, keepdims=True)))[np.arange(4), y].mean()

    for p, g in zip(params, _gradients(params, x, y), strict=True):
        for at in rng.integers(0, p.size, 6):
            if p.ndim == 2 and p.shape[0] == 256 and not np.isin(at // p.shape[1], x):
                continue
            index = np.unravel_index(at, p.shape)
            old, step = p[index], 1e-5
            p[index] = old + step
            up = loss()
            p[index] = old - step
            down = loss()
            p[index] = old
            assert g[index] == pytest.approx((up - down) / (2 * step), abs=2e-3)


def test_held_out_accuracy(docs, model):
    held = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 4 = 2")
    rows = identify_language(held, model).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_hard_rows(hard, none, model):
    found = identify_language(hard, model)
    assert found.columns == [*hard.columns, "lang_pred", "score"]
    by_id = {r.doc_id: r for r in found.collect()}
    for i in (4, 5, 6):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[9].lang_pred in model.languages
    kept = known_language(hard, model)
    assert kept.columns == hard.columns
    assert not {4, 5, 6} & {r.doc_id for r in kept.collect()}
    assert identify_language(none, model).collect() == []


def test_without_labels(none, hard):
    model = learn_languages(none)
    assert {r.lang_pred for r in identify_language(hard, model).collect()} == {"und"}
    assert known_language(hard, model).count() == 12


def test_what_is_no_language_is_rejected_and_languages_are_kept(spark):
    """Held-out documents stay; the same with their characters shuffled, and other texts, go."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = learn_languages(docs.where(~held), with_none=True)
    clean = docs.where(held & (F.length("text") >= 100))
    assert known_language(clean, model).count() >= 0.99 * clean.count()
    mixed = clean.withColumn("text", F.expr("array_join(shuffle(split(text, '')), '')"))
    assert known_language(mixed, model).count() <= 0.06 * mixed.count()
    other = [
        "0a9f8e7d6c5b4a39 28170f1e2d3c4b5a " * 10, "QmFzZTY0IGVuY29kZWQgdGV4dCBsb29rcyBsaWtlIHRoaXM" * 8,
        "человек время дом рука слово жизнь день работа город " * 8, "的一是不了人我在有他这为之大来以个中上们到说国和地也子时道出" * 8,
        "qxz wvkj ptfg hbd zzqk xcvb mnrt lkjh gfds qwpx " * 8, "", None, "   ", "!!! ???",
    ]
    rows = spark.createDataFrame([(i, t, 5.0, "x") for i, t in enumerate(other)], "doc_id int, text string, score double, lang_pred string")
    assert known_language(rows, model).collect() == []
    assert known_language(rows.limit(0), model).columns == rows.columns


def test_the_class_of_no_language_is_left_out_unless_asked_for(spark):
    docs = spark.createDataFrame([(i, f"some words of text {i}", "en") for i in range(30)], "doc_id int, text string, lang string")
    assert learn_languages(docs).languages == ["en"]
    assert learn_languages(docs, with_none=True).languages == ["en", UNKNOWN]
    assert learn_languages(docs.limit(0), with_none=True).languages == []

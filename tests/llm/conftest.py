import pytest

from leafmill.llm.tables import Workspace

SCHEMA = "doc_id bigint, text string, lang string, source string, row int, code string, key string"


@pytest.fixture
def work(spark):
    return Workspace(spark, "test")


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls everywhere, empty and long texts, repeats, and columns named like inner ones."""
    long_text = " ".join(f"word{i % 977} thing{i}" for i in range(20_000))
    texts = [
        (1, "the quick brown fox jumps over the lazy dog and then runs home again", "en"),
        (2, "the quick brown fox jumps over the lazy dog and then runs home again", "en"),
        (2, "the quick brown fox jumps over the lazy dog and then runs home again", None),
        (3, "THE QUICK  brown fox\tjumps over the lazy dog and then runs home AGAIN", "en"),
        (4, "", "en"),
        (5, None, None),
        (None, "a text whose id is missing but which has some words of its own", "en"),
        (None, None, None),
        (6, " \n\t ", "en"),
        (7, "one", "en"),
        (8, "One", "en"),
        (9, long_text, "en"),
        (10, long_text + " more", "en"),
        (11, "zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich", "de"),
        (12, "日本語 の 文章 \U0001f600 ​ end", None),
        (13, "line\n\nline\nother line\n", "en"),
    ]
    return [(i, t, lang, None, 0, "c", "k") for i, t, lang in texts]


@pytest.fixture(scope="session")
def hard(spark, hard_rows):
    return spark.createDataFrame(hard_rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)

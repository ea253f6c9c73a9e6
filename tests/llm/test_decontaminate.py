import re

from leafmill.llm.decontaminate import (
    build_index, contamination, item_windows, proximity_matches, without_contaminated, _phrases,
)
from tests.llm.brute import contaminated

ITEMS = [
    (1, "Alpha, beta gamma: delta epsilon zeta eta theta iota kappa lambda mu!"),
    (2, "short one"),
    (2, "another text of the same item with more than ten words in it, really"),
    (3, ""),
    (4, None),
    (None, "nameless item"),
    (5, "short one"),
]
DOCS = [
    (1, "x alpha beta gamma delta epsilon zeta eta theta iota kappa lambda y"),
    (2, "ALPHA beta gamma delta epsilon zeta eta theta iota KAPPA lambda mu nu"),
    (3, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (4, "a short-one, short one; SHORT ONE nameless item"),
    (5, None),
    (6, "..."),
    (None, "nameless item"),
    (7, "short " * 3000 + "one"),
    (7, "short " * 3000 + "one"),
]


def frames(spark):
    docs = spark.createDataFrame([(*d, "n", 1) for d in DOCS], "doc_id bigint, text string, number string, row int")
    return docs, spark.createDataFrame(ITEMS, "item_id bigint, text string")


def test_hits_equal_brute_force(spark):
    docs, items = frames(spark)
    found = contamination(docs, items, width=10).collect()
    named = [(i, t) for i, t in ITEMS if i is not None]
    expected = []
    for i, text in DOCS:
        n, hit, _ = contaminated(text, ITEMS, 10)
        names = contaminated(text, named, 10)[2]
        expected.append((i, n, hit, names, hit > 0))
    key = repr
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


def test_plans_use_no_python(spark):
    docs, items = frames(spark)
    text = contamination(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|InArrow|InPandas|Cartesian|NestedLoop", text)


def test_clean_rows_stay_whole(spark):
    docs, items = frames(spark)
    kept = without_contaminated(docs, items, width=10)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 6]


def test_empty_inputs(spark):
    docs, items = frames(spark)
    assert contamination(docs.limit(0), items).collect() == []
    assert not any(r.contaminated for r in contamination(docs, items.limit(0)).collect())


def test_words_close_together_in_any_order(spark, work):
    docs = spark.createDataFrame(
        [(1, "one x three two"), (2, "one x x x x x x two three"), (3, "two three")],
        "doc_id bigint, text string",
    )
    items = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    windows = item_windows(items, 10, id_col="item_id", text_col="text")
    index = build_index(docs, work)
    found = proximity_matches(_phrases(windows, work), index, 3)
    rows = found.join(index.texts, "row").collect()
    assert {r.id for r in rows} == {1}

import itertools
import re

import pytest

from leafmill.llm.filter_audit import filter_audit, prefixes

LABELS = "doc_id bigint, quality int, toxic int, part string"
COLUMNS = [
    "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
    "toxic_lost", "shapley",
]


def fails(doc_id, text, table):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = ""
    out += "A" * (len(words) < 50)
    out += "B" * (100 * len(set(words)) < 65 * len(words))
    out += "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text))
    out += "D" * bool(re.search("[#$%&*|]", text))
    smaller = [i for i, t in table if t == text and i is not None and (doc_id is None or i < doc_id)]
    return out + "E" * bool(smaller)


def brute(rows, labels):
    table = [(i, t or "") for i, t, _ in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    docs = [(i, s or "", fails(i, t or "", table)) for i, t, s in rows]
    out = []
    for part in {s for _, s, _ in docs}:
        mine = [(i, f) for i, s, f in docs if s == part]
        shares = dict.fromkeys("ABCDE", 0)
        rows_here = []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, name in enumerate(order, 1):
                removed = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                shares[name] += len(removed)
                rows_here.append((
                    part, "".join(order), step, len(left), len(removed),
                    sum(name in f for _, f in mine) - len(removed), sum(f == name for _, f in mine),
                    sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed),
                ))
        out += [(*r, shares[r[1][r[2] - 1]]) for r in rows_here]
    return sorted(out)


def found(spark, rows, labels):
    docs = spark.createDataFrame(
        [(i, t, s, True, "f", 5) for i, t, s in rows],
        "doc_id bigint, text string, source string, A boolean, filter string, many int",
    )
    df = filter_audit(docs, spark.createDataFrame([(*r, "x") for r in labels], LABELS))
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def rows(hard_rows):
    plain = " ".join(f"w{i}" for i in range(60))
    more = [
        (20, plain, "s1"), (21, plain, "s1"), (22, plain, "s2"), (23, plain + " #", "s1"),
        (24, "a " * 60, "s1"), (25, plain.upper(), "s2"), (26, "A|" * 30, None), (26, "A|" * 30, "s2"),
        (None, plain, "s1"), (30, plain + " " + "word " * 33, "s1"), (31, "x\x0by\x0cz\xa0é " * 20, "s2"),
        (32, "\x1c\x85  " * 30, "s2"),
    ]
    hot = [(100 + i, plain + " A B C D E", "s3") for i in range(40)]
    return [(i, t, None if i == 6 else "s1") for i, t, *_ in hard_rows] + more + hot


def test_equals_brute_force(spark, rows):
    labels = [(i, i % 2, i % 3 % 2) for i in range(0, 140, 2)] + [
        (21, 1, 0), (21, 0, 1), (23, 1, None), (24, None, 1), (None, 1, 1), (9999, 1, 1),
    ]
    assert found(spark, rows, labels) == brute(rows, labels)


def test_no_labels_and_no_documents(spark, rows):
    assert found(spark, rows[:6], []) == brute(rows[:6], [])
    assert found(spark, [], [(1, 1, 1)]) == []


def test_prefixes_are_the_sets_of_other_filters():
    assert [len(prefixes(name)) for name in "ABCDE"] == [16] * 5
    assert all(not s >> "ABCDE".index(name) & 1 for name in "ABCDE" for s in prefixes(name))

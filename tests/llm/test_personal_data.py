import hashlib
import itertools
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from leafmill.llm.personal_data import (
    KINDS, LABELS, Field, added_spans, base_spans, find_personal_data, fit, learn_personal_data, links, marginals,
    mentions, passes_luhn, spans_text,
)
from leafmill.llm.queries import QUERIES

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
DOCS = [
    "Call +1 (487) 555-7209 or write ann.lee7@mail.example.com. Pay with 4539 5787 6362 1486.",
    "Host 248.40.198.62 answers, 12.300.1.1 does not. +49 30 1234567 rings.",
    "Nothing here: 2024-12-05, 4539 5787 6362 1487, version 1.2.3, a@b, +12.",
]


def luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                kind == 0
                or (kind == 1 and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == 2 and 12 <= len(digits) <= 19 and luhn(digits))
                or (kind == 3 and 9 <= len(digits) <= 15)
            )
            if good:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0123456789.-+ ()@aZ%_é", max_size=60))
def test_patterns_equal_brute_force(text):
    assert base_spans(text) == brute(text)


@pytest.mark.parametrize("text", ["1" * 400_000, "1." * 200_000, "a" * 400_000 + "@", "a@" * 200_000, "+1 (" * 100_000, "1 " * 200_000, "at " * 200_000, "x at y dot " * 40_000])
def test_time_is_linear(text):
    begun = time.time()
    mentions(text, base_spans(text))
    assert time.time() - begun < 8


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="0123456789", min_size=1, max_size=20))
def test_luhn(digits):
    assert passes_luhn(digits) == luhn(digits)


def enumerated(own, ends, between):
    total = np.zeros_like(own)
    for labels in itertools.product(range(LABELS), repeat=len(own)):
        score = sum(own[i, y] for i, y in enumerate(labels))
        score += sum(t[labels[a], labels[b]] for (a, b), t in zip(ends, between, strict=True))
        for i, y in enumerate(labels):
            total[i, y] += np.exp(score)
    return total / total.sum(axis=1, keepdims=True)


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**32), st.booleans())
def test_messages_give_exact_marginals_on_trees_and_close_ones_with_a_loop(seed, loop):
    draw = np.random.default_rng(seed)
    ends = [(0, 1), (1, 2), (1, 3)] + [(0, 3)] * loop
    own, between = draw.normal(size=(4, LABELS)), draw.normal(size=(len(ends), LABELS, LABELS)) * 0.5
    found = marginals(own, np.array(ends), between)
    assert np.abs(found - enumerated(own, ends, between)).max() < (0.05 if loop else 1e-3)


@pytest.fixture(scope="module")
def field():
    sample = []
    draw = np.random.default_rng(3)

    def number(n):
        return "".join(map(str, draw.integers(0, 10, n)))

    for _ in range(150):
        card = number(15)
        card += next(c for c in "0123456789" if luhn(card + c))
        wrong = card[:-1] + str((int(card[-1]) + 1) % 10)
        ip = ".".join(str(x) for x in draw.integers(10, 250, 4))
        sample.append([(3, f"+1 ({number(3)}) 555-{number(4)}", "the", 99), (2, card, "of", 200), (4, wrong, "and", 99)])
        sample.append([(0, f"user.{number(2)}@mail{number(1)}.example.com", "", 60), (1, ip, "on", 99)])
        sample.append([(4, f"{number(4)}-12-{number(2)}", "on", 99), (4, number(8), "order", 99)])
    return fit(sample)


def added(text, field):
    return [(KINDS[k], text[a:e]) for a, k, e, _ in added_spans(mentions(text, base_spans(text)), field)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("call +1 (487) 555-7209, later 487 555 7209 or 555-7209, not 555-1234",
         [("phone", "487 555 7209"), ("phone", "555-7209")]),
        ("call 555-7209 on 2024-12-05", []),
        ("card 4539 5787 6362 1486, mistyped 4539578763621487", [("card", "4539578763621487")]),
        ("numbers 4539578763621487 and 4539578763621487 and 4539578763621487", []),
        ("ann.lee7@mail.example.com is ann.lee7", [("email", "ann.lee7")]),
        ("only ann.lee7 here", []),
        ("host 248.40.198.62, in names 248-40-198-62", [("ip", "248-40-198-62")]),
        ("bob.1 [at] mail2.example.com", [("email", "bob.1 [at] mail2.example.com")]),
        ("a hash 9233A8ECF7C5B09FE5949719B6B82BC4 stays", []),
    ],
)
def test_distant_mentions_take_the_label_of_what_they_repeat(field, text, expected):
    assert added(text, field) == expected
    assert added("x " * 5000 + text.replace(",", " " + "word " * 400 + ","), field) == expected


def test_links_stay_linear_in_a_group():
    text = "+1 (487) 555-7209, " + "487 555 7209, " * 2000
    found = mentions(text, base_spans(text))
    assert len(found) == 2001
    assert len(links(found)) <= 4 * len(found)


def test_without_teaching_nothing_is_added():
    assert added("call (487) 555-7209", fit([])) == []
    assert added("call (487) 555-7209", Field.blank()) == []


def test_hard_rows(spark, hard, hard_rows, none, field):
    found = find_personal_data(hard, field)
    assert found.columns == ["doc_id", "found"]
    assert found.count() == len(hard_rows)
    assert find_personal_data(none, learn_personal_data(none)).collect() == []


def test_rows_and_repeats(spark, field):
    rows = [(i, t, "k") for i, t in enumerate([*DOCS, DOCS[0], None, "", "😀 +1 (487) 555-7209"])]
    df = spark.createDataFrame(rows, "doc_id int, text string, found string")
    got = {r.doc_id: r for r in find_personal_data(df, field).select("doc_id", "found", spans_text(spans()).alias("s")).collect()}
    for i, text, _ in rows:
        base = [(s.start, KINDS.index(s.kind), s.end) for s in got[i].found if s.certain]
        assert base == brute(text or "")
    assert got[0].s == got[3].s
    assert got[6].s == "phone:2:19"


def spans():
    from pyspark.sql import functions as F

    return F.col("found")


def test_query_equals_brute_force_and_adds_little(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op12_personal_data"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for row in rows:
        base = brute(texts[row.doc_id] or "")
        listed = [f"{KINDS[k]}:{a}:{e}" for a, k, e in base]
        assert tuple(row)[1:5] == tuple(sum(k == kind for _, k, _ in base) for kind in range(4))
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(row.spans.split(",")) | {""}
        if not re.search("[0-9@]", texts[row.doc_id] or ""):
            assert row.spans == ""

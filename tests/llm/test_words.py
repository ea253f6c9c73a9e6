import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from leafmill.llm.near_duplicates import near_duplicate_groups
from leafmill.llm.words import AS_IS, LOWER, hash_spans, text_bytes, word_spans


def thue_morse(n, a="a", b="b"):
    return "".join(b if i.bit_count() % 2 else a for i in range(n))


def codes(words, fold=AS_IS):
    data, starts = text_bytes(pa.array(words))
    return hash_spans(data, starts[:-1], starts[1:], fold).tolist()


def test_words_that_defeat_polynomials_are_told_apart():
    words = [thue_morse(n, *letters) for n in (1, 2, 64, 100, 128, 129, 1024, 2048) for letters in ("ab", "ba")]
    assert len(set(codes(words))) == len(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abAB é\x00", max_size=300), min_size=1, max_size=20))
def test_equal_hashes_mean_equal_bytes(words):
    for fold, same in ((AS_IS, str), (LOWER, lambda w: w.translate({65: 97, 66: 98}))):
        found = codes(words, fold)
        for a, x in zip(words, found, strict=True):
            for b, y in zip(words, found, strict=True):
                assert (x == y) == (same(a) == same(b))


def test_place_in_the_block_does_not_matter():
    data, starts = text_bytes(pa.array(["one two", "two  one", "x" * 200 + " two"]))
    spans = word_spans(data, starts)
    assert spans.code[0] == spans.code[3] and spans.code[1] == spans.code[2] == spans.code[5]
    assert np.unique(spans.code).size == 3


def test_thue_morse_documents_are_not_linked(spark):
    docs = [(1, " ".join([thue_morse(2048)] * 3)), (2, " ".join([thue_morse(2048, "b", "a")] * 3)),
            (3, f"{thue_morse(2048)} {thue_morse(2048, 'b', 'a')} {thue_morse(2048)} x")]
    rows = near_duplicate_groups(spark.createDataFrame(docs, "doc_id int, text string"), width=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {1: (1, 1, True), 2: (1, 2, True), 3: (3, 3, True)}

import hashlib

import numpy as np
import pytest

from leafmill.llm import line_dedup
from leafmill.llm.line_dedup import (
    CuckooFilter, add_documents, build_line_index, dedup_lines, drop_common_lines, remove_documents,
)
from tests.llm.brute import drop_lines


def test_cuckoo_filter_holds_what_was_put_in_and_forgets_what_was_taken_out():
    keys = np.random.default_rng(5).integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    filter_ = CuckooFilter.of(keys[:4000])
    assert filter_.contains(keys[:4000]).all()
    assert filter_.contains(keys[4000:]).mean() < 0.01
    for key in keys[:2000]:
        filter_.delete(key)
    assert filter_.contains(keys[2000:4000]).all()
    assert filter_.contains(keys[:2000]).mean() < 0.01
    assert (filter_.table != 0).sum() == 2000


def test_lines_equal_brute_force(spark, hard_rows):
    texts = [r[1] for r in hard_rows]
    texts += [f" Shared LINE \nown {i}\n\nshared line\r" for i in range(6)] + ["shared line"] * 3
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    for distinct in (False, True):
        found = dedup_lines(docs, min_docs=4, distinct_texts=distinct).orderBy("doc_id").collect()
        expected = drop_lines(texts, 4, distinct_texts=distinct)
        assert [(r.n_lines, r.n_dropped, r.text) for r in found] == expected


def test_other_columns_stay_and_empty_input_gives_nothing(hard, none):
    found = dedup_lines(hard, min_docs=2)
    assert found.columns == [*hard.columns, "n_lines", "n_dropped"]
    assert {r.key for r in found.collect()} == {"k"}
    assert dedup_lines(none).collect() == []


def test_adding_and_removing_is_reversible(spark, work):
    def docs(names):
        return spark.createDataFrame(
            [(f"common\n{n}\n{n[:1]} line",) for n in names], "text string"
        )

    def state(index):
        counts = sorted((bytes(r.key), r.n) for r in index.counts.collect())
        filters = {r.shard: bytes(r.filter) for r in index.filters.collect()}
        return counts, filters

    first = build_line_index(docs(["a1", "a2", "a3", "b1"]), work, min_docs=3)
    more = docs(["b2", "b3", "b4"])
    grown = add_documents(first, more, work)
    whole = build_line_index(docs(["a1", "a2", "a3", "b1", "b2", "b3", "b4"]), work, min_docs=3)
    assert state(grown)[0] == state(whole)[0]
    held = CuckooFilter(np.frombuffer(state(grown)[1][0], np.uint16))
    assert (held.table != 0).sum() == 3  # "common", "a line", "b line"
    back = remove_documents(grown, more, work)
    assert state(back)[0] == state(first)[0]
    held = CuckooFilter(np.frombuffer(state(back)[1][0], np.uint16))
    assert (held.table != 0).sum() == 2


def texts(spark, lines):
    return spark.createDataFrame([(t,) for t in lines], "text string")


def test_a_document_never_added_cannot_be_removed(spark, work):
    index = build_line_index(texts(spark, ["a\nb", "b"]), work, min_docs=2)
    with pytest.raises(ValueError, match="never added"):
        remove_documents(index, texts(spark, ["c"]), work)
    with pytest.raises(ValueError, match="never added"):
        remove_documents(index, texts(spark, ["a", "a"]), work)


def test_changes_touch_changed_keys_alone_and_shards_grow(spark, work, monkeypatch):
    """Layers of counts, filters of untouched shards left as they are, full ones and all built anew."""
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 40)
    made = [f"line {i}" for i in range(200)]
    index = build_line_index(texts(spark, ["\n".join(made)] * 2), work, min_docs=2)
    assert index.shards == 5

    def filters(index):
        return {r.shard: bytes(r.filter) for r in index.filters.collect()}

    def holds(index, lines):
        keys = {bytes(hashlib.md5(x.encode()).digest()) for x in lines}
        found = {bytes(r.key): r.n for r in index.counts.collect()}
        assert {k for k, n in found.items() if n >= 2} == keys
        assert sum(r.many for r in index.filters.collect()) == len(keys)
        kept = drop_common_lines(texts(spark, ["\n".join([*lines, "own line"])]), index).first()
        assert (kept.text, kept.n_dropped) == ("own line", len(lines))

    before = filters(index)
    one = add_documents(index, texts(spark, ["new one", "new one"]), work)
    holds(one, [*made, "new one"])
    assert sum(before[k] != v for k, v in filters(one).items()) == 1 and one.layers == 1
    back = remove_documents(one, texts(spark, ["new one"]), work)
    holds(back, made)
    more = [f"more {i}" for i in range(170)]
    grown = add_documents(back, texts(spark, ["\n".join(more)] * 2), work)
    assert grown.shards == 5
    holds(grown, made + more)
    last = [f"last {i}" for i in range(100)]
    wide = add_documents(grown, texts(spark, ["\n".join(last)] * 3), work)
    assert wide.shards == 12
    holds(wide, made + more + last)
    for i in range(6):
        wide = add_documents(wide, texts(spark, [f"step {i}"] * 2), work)
    assert wide.layers < line_dedup.LAYERS
    holds(wide, made + more + last + [f"step {i}" for i in range(6)])
    small = remove_documents(wide, texts(spark, ["\n".join(made)] * 2 + ["\n".join(last)] * 2), work)
    holds(small, more + [f"step {i}" for i in range(6)])

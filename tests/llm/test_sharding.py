import hashlib
import re
import zlib
from collections import Counter

from leafmill.llm.sharding import shard_documents


def capacity(sizes, shards):
    """The smallest capacity, tried one by one in halves."""
    def fits(limit):
        used, free = 1, limit
        for size in sizes:
            if size > limit:
                return False
            if size > free:
                used, free = used + 1, limit
            free -= size
        return used <= shards

    low, high = 1, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def check(rows, found, shards):
    texts = [t or "" for _, t in rows]
    assert sorted(repr(r.doc_id) for r in found) == sorted(repr(i) for i, _ in rows)
    assert Counter((r["size"], r.text_crc32) for r in found) == Counter(
        (len(t.encode()) + 1, zlib.crc32(t.encode())) for t in texts
    )
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    homes = {}
    for r in found:
        homes.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(len(h) == 1 for h in homes.values())
    sums = Counter()
    for t in texts:
        sums[hashlib.sha256(t.encode()).hexdigest()] += len(t.encode()) + 1
    load = Counter()
    for r in found:
        load[r.shard] += r["size"]
    assert max(load.values()) <= capacity([sums[k] for k in sorted(sums)], shards)
    return load


def test_hard_rows(spark, hard, hard_rows):
    check([(r[0], r[1]) for r in hard_rows], shard_documents(hard, 4).collect(), 4)


def test_even_loads_and_a_group_of_a_third(spark):
    rows = [(i, f"text {i} " * (i % 13 + 1)) for i in range(600)]
    load = check(
        rows,
        shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), 8).collect(),
        8,
    )
    assert min(load.values()) > 0.9 * max(load.values())
    rows += [(1000 + i, "the hot text that is copied " * 2) for i in range(400)]
    load = check(
        rows,
        shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), 8).collect(),
        8,
    )
    assert len(load) >= 7


def test_no_python_and_empty_input(hard, none):
    text = shard_documents(hard, 3)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|InArrow|InPandas|Cartesian|NestedLoop", text)
    assert shard_documents(none, 3).collect() == []

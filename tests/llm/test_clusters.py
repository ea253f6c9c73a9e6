import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from leafmill.llm.clusters import SIZE, Curve, candidates, cluster_vectors, hilbert_keys, nearest_of, whole_vectors

SCHEMA = "vec_id bigint, embedding array<double>, id string, vec int, cluster int, key string"


def rows_of(pairs):
    return [(i, v, "x", 1, 2, "k") for i, v in pairs]


def brute(pairs, k=16, rounds=3):
    """Plain loops over Python integers."""
    kept = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in pairs if fits(v)]
    named = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centres = [list(v) for _, v in named[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        found = [nearest(v)[1] for _, v in kept]
        for j in range(len(centres)):
            mine = [v for (_, v), f in zip(kept, found, strict=True) if f == j]
            if mine:
                centres[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    out = [(i, *nearest(v)[::-1]) for i, v in kept]
    by = {j: sum(d for _, c, d in out if c == j) for j in range(len(centres))}
    sha = {j: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for j, c in enumerate(centres)}
    return [(i, c, d, by[c], sum(by.values()), sha[c]) for i, c, d in out]


def fits(v):
    return v is not None and len(v) == SIZE and all(x is not None and np.isfinite(x) for x in v)


def place(row):
    return (row[0] is None, row[0] or 0, *row[1:])


def hard_vectors():
    draw = np.random.default_rng(5)
    pairs = [(i, (draw.normal(size=SIZE) + 5 * (i % 5)).tolist()) for i in range(300)]
    hot = draw.normal(size=SIZE).tolist()
    pairs += [(1000 + i, hot) for i in range(200)]  # one vector of a third of all rows
    pairs += [(7, hot), (7, hot), (None, hot), (None, draw.normal(size=SIZE).tolist())]
    pairs += [(2000, None), (2001, []), (2002, [0.0] * 63), (2003, [0.0] * 65), (2004, [None] + [0.0] * 63)]
    pairs += [(2005, [float("nan")] + [0.0] * 63), (2006, [float("inf")] + [0.0] * 63), (2007, [-0.001] * SIZE)]
    return pairs


@pytest.mark.parametrize("batch", ["7", "10000"])
def test_equals_brute_force(spark, batch):
    pairs = hard_vectors()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    found = cluster_vectors(spark.createDataFrame(rows_of(pairs), SCHEMA)).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    assert sorted(map(tuple, found), key=place) == sorted(brute(pairs), key=place)


def test_few_vectors_and_none(spark):
    few = [(i, [float(i % 2)] * SIZE) for i in range(5)]
    found = cluster_vectors(spark.createDataFrame(rows_of(few), SCHEMA)).collect()
    assert sorted(map(tuple, found), key=place) == sorted(brute(few), key=place)
    none = cluster_vectors(spark.createDataFrame([], SCHEMA))
    assert none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert none.count() == 0


def test_large_components(spark):
    pairs = [(i, [float((i * 37 + d) % 11 - 5) * 2e5 for d in range(SIZE)]) for i in range(40)]
    pairs.append((99, [1e30] + [0.0] * 63))  # its squares would leave 64 bits: not a vector that counts
    found = cluster_vectors(spark.createDataFrame(rows_of(pairs), SCHEMA)).collect()
    assert sorted(map(tuple, found), key=place) == sorted(brute(pairs[:-1]), key=place)


def test_sums_beyond_64_bits_are_null(spark):
    pairs = [(i, [(-1.0) ** i * 2e6] * SIZE) for i in range(40)]
    found = cluster_vectors(spark.createDataFrame(rows_of(pairs), SCHEMA), k=1, rounds=0).collect()
    expected = brute(pairs, k=1, rounds=0)
    assert expected[0][4] >= 1 << 63
    assert {row.inertia for row in found} == {None}
    assert sorted(r[:3] for r in expected) == sorted(tuple(r)[:3] for r in found)


def test_whole_vectors_floor(spark):
    df = spark.createDataFrame([(1, [-0.001] * 63 + [0.9999])], "vec_id int, embedding array<float>")
    row = whole_vectors(df, "vec_id", "embedding").first()
    assert row.vec == [-1] * 63 + [63]


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (5, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = hilbert_keys(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)
    assert set(steps) == {1}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 6), st.sampled_from([3, 100, 1 << 24]))
def test_bounds_keep_every_nearest_centroid(seed, k, size):
    draw = np.random.default_rng(seed)
    centres = draw.integers(-size, size, (k, SIZE))
    rows = centres[draw.integers(0, k, 50)] + draw.integers(-size // 3, size // 3 + 1, (50, SIZE))
    possible = candidates(rows.min(0)[None], rows.max(0)[None], centres)[0]
    first, distance = nearest_of(rows, centres)
    assert possible[first].all()
    ours = np.flatnonzero(possible)
    again, same = nearest_of(rows, centres[ours])
    assert (ours[again] == first).all() and (same == distance).all()


def test_blocks_of_separate_groups_have_few_candidates():
    draw = np.random.default_rng(1)
    centres = draw.integers(-400, 400, (16, SIZE))
    rows = centres[np.arange(6400) % 16] + draw.integers(-30, 30, (6400, SIZE))
    ordered = rows[np.argsort(Curve(rows[:2000]).keys(rows.astype(float)), kind="stable")].reshape(-1, 64, SIZE)
    possible = candidates(ordered.min(axis=1), ordered.max(axis=1), centres)
    assert possible.sum(axis=1).mean() < 3


def test_no_pass_over_whole_rows_shuffles(spark):
    """Vectors move once, into blocks; rounds move sums alone."""
    df = cluster_vectors(spark.createDataFrame(rows_of(hard_vectors()), SCHEMA))
    plan = df.select(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "SortMergeJoin" not in plan

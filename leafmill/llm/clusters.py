"""Centroid clustering over zone maps along a space-filling curve, in exact integers.

Vectors of whole numbers are put in the order of a Hilbert curve through their leading
directions and stored as blocks of neighbours, each with the smallest and largest value of every
component and the sum of its vectors. In a round, bounds on distances over a block's box put
centroids out for the block before a vector is looked at. Those left, its candidates, are compared
with all vectors of the blocks that share them at once. A block that has one candidate alone adds
its stored sum.

The bounds only leave out what cannot be nearest, so the result does not depend on the blocks, the
curve or the sample behind its directions. Centroids are a table of bounded size (``k`` vectors) on
the driver; vectors, blocks and assignments never come there.
"""

from __future__ import annotations

import decimal
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F, types as T

from leafmill.llm.tables import Workspace

SIZE = 64
SCALE = 64
K = 16
ROUNDS = 3
# Vectors of a block. A block never spans two tasks.
BLOCK = 64
# Vectors that a task orders; bounds its memory.
RANGE = 1 << 18
# Components below this size keep every squared distance below 2**63.
LARGEST = 1 << 27
# Components below this size keep every product and sum exact in doubles.
EXACT_IN_DOUBLES = 1 << 21
# The curve runs through this many directions of a sample of this many vectors.
DIRECTIONS, BITS, SAMPLE = 8, 7, 4096


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions along the Hilbert curve of grid cells (rows of ``bits``-bit numbers).

    Skilling's transposition ("Programming the Hilbert curve", 2004) for all rows at once.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for i in range(dims):
            set_here = (x[i] & bit) != 0
            swapped = np.where(set_here, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(set_here, below, swapped)
            x[i] ^= swapped
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] & (1 << level)) != 0, (1 << level) - 1, 0)
    x ^= turn
    keys = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            keys = (keys << 1) | ((x[i] >> level) & 1)
    return keys


class Curve:
    """Directions in which a sample spreads most, and the grid along them."""

    def __init__(self, sample: np.ndarray):
        rows = sample.astype(np.float64)
        self.centre = rows.mean(axis=0) if len(rows) else np.zeros(SIZE)
        _, _, axes = np.linalg.svd(rows - self.centre, full_matrices=False)
        self.axes = axes[:DIRECTIONS].T
        along = (rows - self.centre) @ self.axes
        spread = along.std(axis=0) if len(rows) else np.ones(self.axes.shape[1])
        self.step = np.where(spread > 0, spread, 1.0) * 6 / (1 << BITS)

    def keys(self, rows: np.ndarray) -> np.ndarray:
        if not self.axes.shape[1]:
            return np.zeros(len(rows), np.int64)
        along = (rows - self.centre) @ self.axes / self.step + (1 << BITS) / 2
        return hilbert_keys(np.clip(along, 0, (1 << BITS) - 1), BITS)


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, vec)`` of the vectors that count: whole components, floor(scale * x).

    A vector counts if it is not null and has exactly ``SIZE`` components, none of them null, not
    a number, infinite, or so large that squared distances would leave 64 bits.
    """
    scaled = F.transform(F.col(vector_col), lambda x: F.lit(float(SCALE)) * x.cast("double"))
    fits = F.forall("scaled", lambda x: F.coalesce(F.abs(x) < float(LARGEST), F.lit(False)))
    return (
        vectors.where(F.size(vector_col) == SIZE)
        .select(F.col(id_col).alias("id"), F.inline(F.array(F.struct(scaled.alias("scaled")))))
        .where(fits)
        .select("id", F.transform("scaled", lambda x: F.floor(x).cast("int")).alias("vec"))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of whole vectors as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, SIZE)


def _along(curve: Curve):
    @F.arrow_udf("bigint")
    def key(column: pa.Array) -> pa.Array:
        return pa.array(curve.keys(_matrix(column).astype(np.float64)), pa.int64())

    return key


def _blocks(id_type: pa.DataType):
    """Arrow partition function: ordered ``(id, vec)`` rows to blocks."""

    def fold(ids: pa.Array, rows: np.ndarray) -> pa.RecordBatch:
        begins = list(range(0, len(rows), BLOCK))
        parts = [rows[a : a + BLOCK] for a in begins]
        wide = [part.astype(np.int64).sum(axis=0) for part in parts]
        return pa.record_batch(
            [
                pa.ListArray.from_arrays(pa.array([*begins, len(rows)], pa.int32()), ids),
                pa.array([part.astype("<i4").tobytes() for part in parts], pa.binary()),
                pa.array([part.min(axis=0).astype("<i4").tobytes() for part in parts], pa.binary()),
                pa.array([part.max(axis=0).astype("<i4").tobytes() for part in parts], pa.binary()),
                pa.array([total.astype("<i8").tobytes() for total in wide], pa.binary()),
            ],
            names=["ids", "rows", "low", "high", "total"],
        )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = pa.array([], id_type), np.zeros((0, SIZE), np.int32)
        for batch in batches:
            ids = pa.concat_arrays([ids, batch.column(0)])
            rows = np.concatenate([rows, _matrix(batch.column(1))])
            full = len(rows) // BLOCK * BLOCK
            if full:
                yield fold(ids.slice(0, full), rows[:full])
                ids, rows = pa.concat_arrays([ids.slice(full)]), rows[full:]
        if len(rows):
            yield fold(ids, rows)

    return gather


def _unpacked(column: pa.Array, kind: str) -> np.ndarray:
    values = np.frombuffer(b"".join(column.to_pylist()), kind)
    return values.reshape(len(column), SIZE)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """For each block (row) which centroids (columns) may be nearest to one of its vectors.

    A centroid is out if at every point of the box another is nearer: the difference of both
    squared distances is linear, so its bound over the box is a sum of bounds by component. The
    other is the centroid nearest to the middle of the box. One that may be as near stays in.
    """
    low, high, centroids = (x.astype(np.int64) for x in (low, high, centroids))
    size = np.square(centroids).sum(axis=1)
    # Which one is nearest to the middle need not be exact.
    near = ((low + high).astype(np.float64) @ -centroids.T.astype(np.float64) + size).argmin(axis=1)
    possible = np.zeros((len(low), len(centroids)), bool)
    for j, centre in enumerate(centroids):
        slope = 2 * (centre - centroids[near])
        most = np.maximum(low * slope, high * slope).sum(axis=1) + size[near] - size[j]
        possible[:, j] = most >= 0
    return possible


def nearest_of(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the first of the nearest centroids, and the squared distance to it."""
    size = max(np.abs(rows).max(initial=0), np.abs(centroids).max(initial=0))
    if size < EXACT_IN_DOUBLES:
        a, b = rows.astype(np.float64), centroids.astype(np.float64)
        found = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
        found = found.astype(np.int64)
    else:
        a, b = rows.astype(np.int64), centroids.astype(np.int64)
        found = np.stack([((a - c) ** 2).sum(axis=1) for c in b], axis=1)
    first = found.argmin(axis=1)
    return first, found[np.arange(len(rows)), first]


def _by_candidates(batch: pa.RecordBatch, options: np.ndarray):
    """Blocks with the same candidates, compared together: ``(candidates, places, rows)``."""
    offsets = batch["ids"].offsets.to_numpy()
    begins = offsets - offsets[0]
    sets, group = np.unique(options, axis=0, return_inverse=True)
    for number, possible in enumerate(sets):
        blocks = np.flatnonzero(group.reshape(-1) == number)
        places = np.concatenate([np.arange(begins[i], begins[i + 1]) for i in blocks])
        packed = b"".join(batch["rows"][int(i)].as_py() for i in blocks)
        yield np.flatnonzero(possible), places, np.frombuffer(packed, "<i4").reshape(-1, SIZE)


def _options(batch: pa.RecordBatch, centroids: np.ndarray) -> np.ndarray:
    return candidates(_unpacked(batch["low"], "<i4"), _unpacked(batch["high"], "<i4"), centroids)


def _sums(centroids: np.ndarray):
    """Arrow partition function: blocks to ``(cluster, dim, total, many)`` of the whole task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(centroids), SIZE), object)
        many = np.zeros(len(centroids), np.int64)
        for batch in batches:
            options = _options(batch, centroids)
            alone = options.sum(axis=1) == 1
            sizes = np.diff(batch["ids"].offsets.to_numpy())
            stored = _unpacked(batch["total"], "<i8")
            for i in np.flatnonzero(alone):
                cluster = int(options[i].argmax())
                totals[cluster] += stored[i]
                many[cluster] += sizes[i]
            read = batch.filter(pa.array(~alone))
            for ours, _, rows in _by_candidates(read, options[~alone]):
                first, _ = nearest_of(rows, centroids[ours])
                for place, cluster in enumerate(ours.tolist()):
                    mine = rows[first == place]
                    totals[cluster] += mine.sum(axis=0, dtype=np.int64)
                    many[cluster] += len(mine)
        filled = np.flatnonzero(many)
        values = [int(x) for cluster in filled for x in totals[cluster]]
        yield pa.record_batch(
            [
                pa.array(np.repeat(filled, SIZE), pa.int32()),
                pa.array(np.tile(np.arange(SIZE), len(filled)), pa.int32()),
                pa.array([decimal.Decimal(x) for x in values], pa.decimal128(38, 0)),
                pa.array(np.repeat(many[filled], SIZE), pa.int64()),
            ],
            names=["cluster", "dim", "total", "many"],
        )

    return add


def _assign(centroids: np.ndarray):
    """Arrow partition function: blocks to ``(id, cluster, distance)``."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["ids"].flatten()
            clusters, distances = np.zeros(len(ids), np.int32), np.zeros(len(ids), np.int64)
            for ours, places, rows in _by_candidates(batch, _options(batch, centroids)):
                first, distances[places] = nearest_of(rows, centroids[ours])
                clusters[places] = ours[first]
            yield pa.record_batch(
                [ids, pa.array(clusters), pa.array(distances)], names=["id", "cluster", "distance"]
            )

    return assign


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: exact floors of the means; empty ones stay."""
    sums = (
        blocks.select("ids", "rows", "low", "high", "total")
        .mapInArrow(_sums(centroids), "cluster int, dim int, total decimal(38,0), many bigint")
        .groupBy("cluster", "dim")
        .agg(F.sum("total").alias("total"), F.sum("many").alias("many"))
    )
    after = centroids.copy()
    for row in sums.collect():  # k * SIZE rows
        after[row.cluster, row.dim] = int(row.total) // row.many
    return after


def zone_blocks(kept: DataFrame, curve: Curve, work: Workspace) -> DataFrame:
    """Store ``(id, vec)`` rows as blocks along the curve, with box and sum each.

    Rows are dealt by ranges of the curve and a draw, so that one vector which is a third of all
    rows is spread over many tasks.
    """
    id_type = _arrow_type(kept.schema["id"].dataType)
    parts = max(1, -(-kept.count() // RANGE), kept.sparkSession.sparkContext.defaultParallelism)
    ordered = (
        kept.withColumn("key", _along(curve)("vec"))
        .withColumn("draw", F.rand(13))
        .repartitionByRange(parts, "key", "draw")
        .sortWithinPartitions("key", "draw")
        .select("id", "vec")
    )
    schema = T.StructType(
        [
            T.StructField("ids", T.ArrayType(kept.schema["id"].dataType)),
            *[T.StructField(name, T.BinaryType()) for name in ("rows", "low", "high", "total")],
        ]
    )
    return work.put(ordered.mapInArrow(_blocks(id_type), schema), "blocks")


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def cluster_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per vector that counts: id, ``cluster, distance, cluster_inertia, inertia,
    centroid_sha256``.

    Which vectors count says ``whole_vectors``; others have no row. Centroids start as the ``k``
    vectors with the smallest lower-case hex SHA-256 of ``1:<id>``, in that order, and fewer where
    there are fewer vectors. A null id reads as empty; of rows with equal ids the smallest vector
    comes first. Equal vectors each count. Of equally near centroids the smaller number wins, and a
    centroid without vectors stays where it is. Sums of distances beyond 64 bits are null. No
    vectors give no rows. Other columns of the input play no part, whatever their names.
    """
    work = Workspace(vectors.sparkSession, "clusters")
    kept = work.put(whole_vectors(vectors, id_col, vector_col), "kept")
    named = F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    drawn = (
        kept.select(F.sha2(named, 256).alias("draw"), "vec")
        .orderBy("draw", "vec")
        .limit(max(SAMPLE, k))
        .collect()
    )
    drawn = np.array([row.vec for row in sorted(drawn, key=_place)], np.int64).reshape(-1, SIZE)
    blocks = zone_blocks(kept, Curve(drawn), work)
    centroids = drawn[:k].copy()
    for _ in range(rounds if len(drawn) else 0):
        centroids = _moved(blocks, centroids)
    id_type = kept.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.LongType()),
        ]
    )
    placed = work.put(
        blocks.select("ids", "rows", "low", "high").mapInArrow(_assign(centroids), schema), "placed"
    )
    work.drop(kept, blocks)
    totals = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    by_cluster = {row.cluster: row.s for row in totals.collect()}  # k rows at most
    told = [
        Row(
            number=c,
            cluster_inertia=_in_64_bits(by_cluster[c]),
            inertia=_in_64_bits(sum(by_cluster.values())),
            centroid_sha256=hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest(),
        )
        for c in sorted(by_cluster)
    ]
    about = placed.sparkSession.createDataFrame(
        told, "number int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return placed.join(F.broadcast(about), F.col("cluster") == F.col("number")).select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _place(row: Row) -> tuple:
    return row.draw, row.vec


def _in_64_bits(total) -> int | None:
    return int(total) if total < 1 << 63 else None

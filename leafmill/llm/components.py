"""Connected components of a graph by union-find within tasks and exchange between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leafmill.llm.tables import Workspace


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the links of this task; one link from each node to its smallest peer comes out.

    Each batch is joined on its own, which bounds the memory; what it leaves of its links
    has the same components.
    """
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        names, places = np.unique(np.concatenate([a, b]), return_inverse=True)
        parent = list(range(len(names)))

        def top(x: int, parent: list[int] = parent) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        ends = places.tolist()
        for x, y in zip(ends[: len(a)], ends[len(a) :], strict=True):
            x, y = top(x), top(y)
            if x < y:
                parent[y] = x
            elif y < x:
                parent[x] = y
        roots = np.array([top(x) for x in range(len(names))], np.int64)
        moved = np.flatnonzero(roots != np.arange(len(names)))
        yield pa.record_batch(
            [pa.array(names[moved]), pa.array(names[roots[moved]])], names=["a", "b"]
        )


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One exchange: every node hands the smallest of its peers to the others.

    ``small``: peers smaller than the node (and the node gets linked to the smallest);
    else larger ones. Alternating both ends in one star per component (Kiveris et al.,
    2014). Links are (a, b) with a > b.
    """
    if small:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    else:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    lowest = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    handed = around.join(lowest, "u")
    if small:
        out = handed.select(F.explode(F.array("v", "u")).alias("a"), F.col("m").alias("b"))
    else:
        out = handed.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.where("a > b").distinct()


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """``node, root`` for every linked node that is not the smallest of its component.

    ``links`` has two columns ``a, b`` of numbers. Each round is written to the workspace;
    the number of rounds grows with the logarithm of the longest chain.
    """
    ordered = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    before, last = None, None
    while True:
        source = ordered if last is None else last
        joined = source.mapInArrow(_union, "a bigint, b bigint")
        now = work.put(_star(_star(joined, small=False), small=True), "stars")
        seen = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if last is not None:
            work.drop(last)
        if tuple(seen) == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, last = tuple(seen), now

"""Shards of near equal size: minimax partition of ordered, atomic groups.

Documents of equal text form a group that stays together. Groups are ordered by the SHA-256
of their text, and shards are stretches of that order. The smallest shard capacity for which
a greedy pass fits everything into the shards is found by binary search; several halvings go
into one pass, as the capacities that they may ask for are checked together. Every question
of a greedy pass (how far does a shard of this capacity reach from here) is an aggregate over
the stored running sums of the groups, filtered to the stretch that can answer it.

A document's shard follows from its own digest and the cuts between shards alone, so no join
of documents with groups is needed and a group of any size spreads over any number of tasks.
Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from leafmill.llm.tables import Workspace

# Halvings of the capacity range that one pass answers: 2 ** HALVINGS - 1 capacities.
HALVINGS = 5
# Digits of the digest by which the order is split for running sums: 16 ** 3 buckets.
BUCKET_DIGITS = 3
# Rows that get their places within a shard together.
CHUNK_ROWS = 1 << 14


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus one; a null text has none."""
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("bigint")


def _running_sums(rows: DataFrame, work: Workspace) -> DataFrame:
    """One row per group in order: digest, size and the size of all groups up to it."""
    bucket = F.substring("digest", 1, BUCKET_DIGITS)
    groups = rows.groupBy(bucket.alias("bucket"), "digest").agg(F.sum("size").alias("size"))
    within = work.put(
        groups.withColumn(
            "sum", F.sum("size").over(Window.partitionBy("bucket").orderBy("digest"))
        ),
        "groups",
    )
    # At most 16 ** BUCKET_DIGITS rows, whatever the input.
    before = within.groupBy("bucket").agg(F.sum("size").alias("total")).withColumn(
        "before",
        F.coalesce(
            F.sum("total").over(
                Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    )
    return work.put(
        within.join(before, "bucket").select(
            "digest", "size", (F.col("sum") + F.col("before")).alias("upto")
        ),
        "running-sums",
    )


def _reach(sums: DataFrame, limits: list[int], largest: int) -> list[int]:
    """For each limit the largest running sum not above it, or 0."""
    asked = sorted(set(limits))
    column = F.col("upto")
    answers = sums.where((column > asked[0] - largest) & (column <= asked[-1])).agg(
        *[F.max(F.when(column <= limit, column)).alias(str(i)) for i, limit in enumerate(asked)]
    ).first()
    reached = {limit: answer or 0 for limit, answer in zip(asked, answers, strict=True)}
    return [reached[limit] for limit in limits]


def smallest_capacity(sums: DataFrame, total: int, largest: int, shards: int) -> int:
    """The smallest capacity with which a greedy pass needs at most ``shards`` shards."""
    low, high = max(largest, -(-total // shards)), -(-total // shards) + largest
    while low < high:
        parts = 1 << HALVINGS
        asked = sorted({low + (high - low) * k // parts for k in range(parts)} - {high})
        ends = [0] * len(asked)
        for _ in range(shards):
            going = [i for i, end in enumerate(ends) if end < total]
            if not going:
                break
            reached = _reach(sums, [min(ends[i] + asked[i], total) for i in going], largest)
            for i, end in zip(going, reached, strict=True):
                ends[i] = end
        fits = [end >= total for end in ends]
        first = fits.index(True) if True in fits else len(asked)
        high = asked[first] if first < len(asked) else high
        low = asked[first - 1] + 1 if first else low
    return high


def _cuts(sums: DataFrame, total: int, largest: int, shards: int, capacity: int) -> list[int]:
    """Where each shard but the last ends: as even as the capacity allows.

    Going back from the end gives the earliest end of each shard that leaves the rest room;
    going forward, a shard ends as near as it can to its even share of what is left, but not
    before that.
    """
    earliest = [total]
    for _ in range(shards - 1):
        least = max(earliest[0] - capacity, 0)
        found = sums.where((F.col("upto") >= least) & (F.col("upto") <= least + largest)).agg(
            F.min("upto")
        ).first()[0]
        earliest.insert(0, 0 if least == 0 else found)
    ends, at = [], 0
    for k in range(shards - 1):
        even = at + -(-(total - at) // (shards - k))
        limit = min(max(even, earliest[k]), at + capacity, total)
        upto = F.col("upto")
        below, above = sums.where((upto >= limit - largest) & (upto <= limit + largest)).agg(
            F.max(F.when((upto <= limit) & (upto > at), upto)),
            F.min(F.when((upto >= limit) & (upto > at) & (upto <= at + capacity), upto)),
        ).first()
        near = [end for end in (below, above) if end is not None]
        # A group larger than the even share is taken whole, not left to an empty shard.
        at = min(near, key=lambda end: abs(end - even)) if near else at
        ends.append(at)
    return ends


def shard_documents(
    docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id, ``size, text_crc32, shard, slot``.

    ``size`` is the UTF-8 bytes of the text plus one; null texts count as empty and, like all
    equal texts, share a shard. ``slot`` counts the rows of a shard from 0 without gaps. No
    shard is larger than the smallest capacity that any cut of the order into ``shards``
    stretches needs. Repeated rows are separate documents. Empty input gives no rows.
    """
    work = Workspace(docs.sparkSession, "shards")
    text = F.coalesce(text_col, F.lit(""))
    rows = work.put(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            text_size(F.col(text_col)).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text, 256).alias("digest"),
        ),
        "rows",
    )
    sums = _running_sums(rows, work)
    total, largest = sums.agg(F.max("upto"), F.max("size")).first()
    cuts: list[str] = []
    if total:
        capacity = smallest_capacity(sums, total, largest, shards)
        ends = _cuts(sums, total, largest, shards, capacity)
        firsts = sums.agg(
            *[
                F.min(F.when(F.col("upto") > end, F.col("digest"))).alias(str(i))
                for i, end in enumerate(ends)
            ]
        ).first() if ends else []
        # "g" sorts after every digest: nothing follows that cut.
        cuts = [digest if digest is not None else "g" for digest in firsts]
    shard = sum((F.when(F.col("digest") >= cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    placed = rows.withColumns(
        {"shard": shard.cast("int"), "chunk": F.expr(f"row div {CHUNK_ROWS}")}
    )
    counts = placed.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("count"))
    before = F.sum("count").over(
        Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select("shard", "chunk", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("row")) - 1
    return (
        placed.withColumn("place", place)
        .join(offsets, ["shard", "chunk"])
        .select(
            F.col("id").alias(id_col),
            "size",
            "text_crc32",
            "shard",
            (F.col("before") + F.col("place")).cast("bigint").alias("slot"),
        )
    )

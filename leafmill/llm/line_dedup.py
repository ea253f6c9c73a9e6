"""Lines that many documents share, with state that takes documents in and out again.

State (``LineIndex``) is two tables. ``counts`` is exact: for each line key the number of
documents holding it. ``filters`` has, per shard of the key space, a cuckoo filter (Fan et
al., 2014) of the keys that enough documents hold. Adding documents raises counts and inserts
keys that reach the threshold; removing documents lowers counts and deletes keys that fall
below it, which a cuckoo filter can do and a Bloom filter cannot. Removing what was added
gives back the state of before.

To apply it, lines go to the shard of their key and are tested against its filter; positives
are confirmed against the exact counts. A shard's lines are dealt over many tasks, each with
its own copy of that shard's filter, so a line that a third of the documents hold is spread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from leafmill.llm.tables import Workspace, fresh, text_key

BLANKS = "\t\n\x0b\x0c\r "
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Keys that one filter is meant for; their number settles the number of shards.
SHARD_KEYS = 1 << 16
# Copies of a shard's filter, times the shuffle partitions of the session.
DEALS = 4
# Changes after which counts are written as one table again.
LAYERS = 8
FILTER = "shard bigint, filter binary, many bigint"
SLOTS = 4
LOAD = 0.84
KICKS = 500


def normal_line(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z lower-cased; its MD5 is its key."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


class CuckooFilter:
    """A set of 16-byte keys as 16-bit fingerprints in buckets of four.

    A key may stand in two buckets; the second follows from the first and the fingerprint.
    Zero marks a free slot. ``insert`` makes the table twice as large when it gets too full,
    which needs the keys again, so it returns False and the caller rebuilds.
    """

    def __init__(self, table: np.ndarray):
        self.table = table.reshape(-1, SLOTS)
        self.mask = np.uint64(len(self.table) - 1)

    @classmethod
    def empty(cls, keys: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * LOAD < keys:
            buckets *= 2
        return cls(np.zeros(buckets * SLOTS, np.uint16))

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        made = cls.empty(len(keys))
        while not all(made.insert(key) for key in keys):
            made = cls.empty(int(len(made.table) * SLOTS * LOAD) + 1)
        return made

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and both buckets of keys, given as rows of two 64-bit numbers."""
        prints = (keys[:, 0] >> np.uint64(48)).astype(np.uint16)
        prints = np.maximum(prints, np.uint16(1))
        first = keys[:, 1] & self.mask
        return prints, first, self._other(first, prints)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        step = prints.astype(np.uint64) * np.uint64(0x5BD1E995)
        return (bucket ^ (step ^ (step >> np.uint64(15)))) & self.mask

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self.places(keys)
        wanted = prints[:, None]
        return (self.table[first] == wanted).any(1) | (self.table[second] == wanted).any(1)

    def insert(self, key: np.ndarray) -> bool:
        prints, first, second = self.places(key[None, :])
        for bucket in (int(first[0]), int(second[0])):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = prints[0]
                return True
        bucket, held = int(second[0]), prints.copy()
        for kick in range(KICKS):
            slot = kick % SLOTS
            held[0], self.table[bucket, slot] = self.table[bucket, slot], held[0]
            bucket = int(self._other(np.array([bucket], np.uint64), held)[0])
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = held[0]
                return True
        return False

    def delete(self, key: np.ndarray) -> None:
        """Take out a key that was inserted."""
        prints, first, second = self.places(key[None, :])
        for bucket in (int(first[0]), int(second[0])):
            found = np.flatnonzero(self.table[bucket] == prints[0])
            if len(found):
                self.table[bucket, found[0]] = 0
                return


def _pairs(keys: pa.Array) -> np.ndarray:
    """16-byte keys as rows of two 64-bit numbers."""
    return np.frombuffer(b"".join(keys.to_pylist()), ">u8").astype(np.uint64).reshape(-1, 2)


def _build_filter(key: tuple, rows: pa.Table) -> pa.Table:
    """The filter of one shard from all of its keys."""
    keys = _pairs(rows["key"].combine_chunks())
    return _filter_row(key[0].as_py(), CuckooFilter.of(keys), len(keys))


def _filter_row(shard: int, made: CuckooFilter | None, many: int) -> pa.Table:
    table = made.table.tobytes() if made is not None else None
    return pa.table(
        {"shard": pa.array([shard], pa.int64()), "filter": pa.array([table], pa.binary()), "many": pa.array([many], pa.int64())}
    )


def _update_filter(key: tuple, rows: pa.Table) -> pa.Table:
    """The filter of one shard after some keys have come (sign 1) and gone (-1).

    One row (sign 0) holds the old filter, if there is one. No filter comes out where the keys no
    longer fit into the table.
    """
    signs = rows["sign"].to_numpy()
    keys = _pairs(rows["key"].combine_chunks())
    old = rows["filter"].drop_null()
    many = int(signs.sum()) + sum(m or 0 for m in rows["many"].to_pylist())
    if not len(old):
        return _filter_row(key[0].as_py(), CuckooFilter.of(keys[signs > 0]), many)
    made = CuckooFilter(np.frombuffer(old[0].as_py(), np.uint16).copy())
    for gone in keys[signs < 0]:
        made.delete(gone)
    whole = all(made.insert(new) for new in keys[signs > 0])
    return _filter_row(key[0].as_py(), made if whole else None, many)


@dataclass
class LineIndex:
    """``counts`` (key, n), ``filters`` (shard, filter, many) and what they were made with.

    ``counts`` is a stored table with up to ``LAYERS`` layers of later changes over it.
    """

    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    min_chars: int
    distinct_texts: bool
    layers: int = 0


def _document_keys(
    docs: DataFrame, text_col: str, min_chars: int, distinct_texts: bool
) -> DataFrame:
    """One row per document (or per distinct text) and distinct key that is long enough."""
    lines = F.split(F.coalesce(text_col, F.lit("")), "\n")
    keys = (
        docs.select(
            text_key(F.col(text_col)).alias("text_key"),
            F.explode(F.array_distinct(F.transform(lines, normal_line))).alias("line"),
        )
        .where(F.length("line") >= min_chars)
        .select("text_key", F.unhex(F.md5("line")).alias("key"))
    )
    return (keys.distinct() if distinct_texts else keys).select("key")


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards))


def build_line_index(
    docs: DataFrame,
    work: Workspace,
    *,
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    distinct_texts: bool = False,
) -> LineIndex:
    """Count line keys over all documents and put those of ``min_docs`` or more into filters.

    With ``distinct_texts`` copies of one text count as one document; such a state takes
    whole groups of copies in and out.
    """
    keys = _document_keys(docs, text_col, min_chars, distinct_texts)
    counts = work.put(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "counts")
    common = counts.where(F.col("n") >= min_docs)
    shards = max(1, -(-common.count() // SHARD_KEYS))
    filters = work.put(_built(common, shards), "filters")
    return LineIndex(counts, filters, shards, min_docs, min_chars, distinct_texts)


def _built(common: DataFrame, shards: int) -> DataFrame:
    return common.select(_shard(shards).alias("shard"), "key").groupBy("shard").applyInArrow(_build_filter, FILTER)


def _changed(index: LineIndex, docs: DataFrame, text_col: str, sign: int, work: Workspace) -> LineIndex:
    """The state after documents have come (1) or gone (-1).

    Written are the counts of their keys alone, as a layer over the others, and the filters of the
    shards in which a key reaches the threshold or falls below it; such a filter gets those keys
    alone. A filter is built anew only where its table is full, and all are, over more shards, when
    they hold twice the keys they are meant for.
    """
    keys = _document_keys(docs, text_col, index.min_chars, index.distinct_texts)
    change = keys.groupBy("key").agg((F.count(F.lit(1)) * sign).alias("change"))
    touched = work.put(
        work.put(change, "change")
        .join(index.counts.withColumnRenamed("n", "before"), "key", "left")
        .select(
            "key",
            F.coalesce("before", F.lit(0)).alias("before"),
            (F.coalesce("before", F.lit(0)) + F.col("change")).alias("n"),
        ),
        "touched",
    )
    if touched.where("n < 0").limit(1).count():
        raise ValueError("documents are to be removed that were never added")
    counts = index.counts.join(touched.select("key"), "key", "left_anti").unionByName(
        touched.where("n > 0").select("key", "n")
    )
    layers = (index.layers + 1) % LAYERS
    if not layers:
        counts = work.put(counts, "counts")
    was, now = F.col("before") >= index.min_docs, F.col("n") >= index.min_docs
    moves = work.put(
        touched.where(was != now).select(
            _shard(index.shards).alias("shard"), "key", F.when(now, 1).otherwise(-1).alias("sign")
        ),
        "moves",
    )
    filters, shards = index.filters, index.shards
    grown = sum(r[0] or 0 for r in (filters.agg(F.sum("many")).first(), moves.agg(F.sum("sign")).first()))
    common = counts.where(F.col("n") >= index.min_docs)
    if grown > 2 * SHARD_KEYS * shards:
        shards = -(-grown // SHARD_KEYS)
        filters = work.put(_built(common, shards), "filters")
    elif moves.limit(1).count():
        stirred = moves.select("shard").distinct()
        old = filters.join(stirred, "shard", "left_semi")
        rows = moves.withColumns({"filter": F.lit(None).cast("binary"), "many": F.lit(None).cast("bigint")}).unionByName(
            old.withColumns({"key": F.lit(b"\0" * 16), "sign": F.lit(0)})
        )
        made = work.put(rows.groupBy("shard").applyInArrow(_update_filter, FILTER), "updated")
        full = made.where("filter IS NULL").select("shard")
        again = common.withColumn("shard", _shard(shards)).join(full, "shard", "left_semi")
        filters = work.put(
            filters.join(stirred, "shard", "left_anti")
            .unionByName(made.where("filter IS NOT NULL"))
            .unionByName(again.groupBy("shard").applyInArrow(_build_filter, FILTER)),
            "filters",
        )
    return LineIndex(counts, filters, shards, index.min_docs, index.min_chars, index.distinct_texts, layers)


def add_documents(index: LineIndex, docs: DataFrame, work: Workspace, *, text_col: str = "text") -> LineIndex:
    """The state after more documents have come in."""
    return _changed(index, docs, text_col, 1, work)


def remove_documents(index: LineIndex, docs: DataFrame, work: Workspace, *, text_col: str = "text") -> LineIndex:
    """The state without documents that were added before; others are a ``ValueError``."""
    return _changed(index, docs, text_col, -1, work)


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines whose key the filter before them in this partition may hold."""
    held: CuckooFilter | None = None
    shown = (-1, -1)
    for batch in batches:
        table = pa.Table.from_batches([batch])
        shard, deal = table["shard"].to_numpy(), table["deal"].to_numpy()
        filters = table["filter"]
        change = np.flatnonzero((shard[1:] != shard[:-1]) | (deal[1:] != deal[:-1])) + 1
        for a, b in zip([0, *change.tolist()], [*change.tolist(), len(shard)], strict=True):
            if a == b:
                continue
            part = table.slice(a, b - a)
            if filters[a].is_valid:
                held = CuckooFilter(np.frombuffer(filters[a].as_py(), np.uint16))
                shown = (int(shard[a]), int(deal[a]))
                part = part.slice(1)
            if held is None or shown != (int(shard[a]), int(deal[a])) or not part.num_rows:
                continue
            part = part.select(["text_key", "line_no", "key"]).combine_chunks()
            hits = held.contains(_pairs(part["key"].combine_chunks()))
            yield from part.filter(pa.array(hits)).to_batches()


def common_lines(docs: DataFrame, index: LineIndex, *, text_col: str = "text") -> DataFrame:
    """``text_key, dropped``: per distinct text the numbers of its common lines, ascending."""
    deals = DEALS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deals = max(1, deals // index.shards)
    lines = (
        docs.select(
            text_key(F.col(text_col)).alias("text_key"),
            F.posexplode(F.split(F.coalesce(text_col, F.lit("")), "\n")).alias("line_no", "line"),
        )
        .withColumn("line", normal_line(F.col("line")))
        .where(F.length("line") >= index.min_chars)
        .select("text_key", "line_no", F.unhex(F.md5("line")).alias("key"))
    )
    nothing = F.lit(None).cast("binary")
    dealt = lines.select(
        _shard(index.shards).alias("shard"),
        F.pmod(F.xxhash64("text_key", "line_no"), F.lit(deals)).alias("deal"),
        nothing.alias("filter"),
        "text_key", "line_no", "key",
    )
    copies = index.filters.select(
        "shard",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(deals - 1).cast("bigint"))).alias("deal"),
        "filter",
        nothing.alias("text_key"),
        F.lit(None).cast("int").alias("line_no"),
        nothing.alias("key"),
    )
    tested = (
        dealt.unionByName(copies)
        .repartition("shard", "deal")
        .sortWithinPartitions("shard", "deal", F.col("filter").desc_nulls_last())
        .mapInArrow(_probe, "text_key binary, line_no int, key binary")
    )
    common = index.counts.where(F.col("n") >= index.min_docs).select("key")
    confirmed = tested.join(common, "key", "left_semi").select("text_key", "line_no").distinct()
    return confirmed.groupBy("text_key").agg(
        F.array_sort(F.collect_list("line_no")).alias("dropped")
    )


@F.arrow_udf(StringType())
def _without(texts: pa.Array, dropped: pa.Array) -> pa.Array:
    kept = []
    for text, numbers in zip(texts.to_pylist(), dropped.to_pylist(), strict=True):
        if text is None:
            kept.append(None)
            continue
        gone = set(numbers)
        kept.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone))
    return pa.array(kept, pa.string())


def drop_common_lines(docs: DataFrame, index: LineIndex, *, text_col: str = "text") -> DataFrame:
    """``docs`` with common lines taken out of the text, plus ``n_lines`` and ``n_dropped``.

    Lines are separated by \\n and compared by key; a line whose key is shorter than the
    index's ``min_chars`` always stays. A null text is one empty line and becomes an empty
    text. All other columns stay as they are; columns named ``n_lines`` and ``n_dropped``
    are replaced.
    """
    key, dropped, own = (fresh(c, [*docs.columns, "n_lines", "n_dropped"]) for c in ("__text_key", "__dropped", "__cut"))
    found = common_lines(docs, index, text_col=text_col).withColumnsRenamed({"text_key": key, "dropped": dropped})
    marked = docs.withColumns(
        {key: text_key(F.col(text_col)), text_col: F.coalesce(text_col, F.lit(""))}
    ).join(found, key, "left")
    n_lines = F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"))) + 1
    some = F.col(dropped).isNotNull()
    # Only texts that lose lines go to Python.
    cut = _without(F.when(some, F.col(text_col)), F.col(dropped))
    counted = marked.withColumns(
        {
            "n_lines": n_lines.cast("bigint"),
            "n_dropped": F.coalesce(F.size(dropped), F.lit(0)).cast("bigint"),
            own: cut,
        }
    )
    names = [*docs.columns, *[c for c in ("n_lines", "n_dropped") if c not in docs.columns]]
    return counted.withColumn(text_col, F.coalesce(own, text_col)).select(*names)


def dedup_lines(
    docs: DataFrame,
    *,
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    distinct_texts: bool = False,
) -> DataFrame:
    """Drop every line that at least ``min_docs`` documents hold, in all of them.

    See ``drop_common_lines``. Repeated rows are separate documents unless
    ``distinct_texts``, where copies count once, so that lines of a text that is merely
    copied stay; a line repeated within one document counts once. Empty input gives no rows.
    """
    work = Workspace(docs.sparkSession, "lines")
    index = build_line_index(
        docs,
        work,
        text_col=text_col,
        min_docs=min_docs,
        min_chars=min_chars,
        distinct_texts=distinct_texts,
    )
    return drop_common_lines(docs, index, text_col=text_col)

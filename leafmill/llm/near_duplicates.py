"""Near-duplicate documents: SuperMinHash signatures, banding, exact checks, union-find.

1. Every document gets its set of word shingles and a SuperMinHash signature (Ertl, 2017):
   each element draws, step by step, a random rank and the next place of a random
   permutation of the slots, and a slot keeps the smallest rank. Ranks of later steps are
   larger, so a document stops as soon as every slot has a rank of an earlier step.
2. Bands of ``ROWS`` neighbouring slots are hashed; documents sharing a band meet in a bucket.
3. A bucket links its members to its smallest one, after the exact check on full shingle sets.
4. Where that leaves a bucket with members of several groups, groups with members of similar
   signatures form a family. All pairs across the groups of a family that sizes and signatures
   allow are checked on full sets, in squares of bounded size, so no link is lost; what comes
   out of a square are the groups that it joins, not pairs.
5. Checked links are joined into groups by union-find: each task joins the links that it
   holds, and rounds of exchange between tasks follow until nothing changes.

Copies of one text are one node throughout, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leafmill.llm.components import components
from leafmill.llm.tables import Workspace, row_key, text_key
from leafmill.llm.words import BASE, mix, shingles, slices

# A pair at 80 % misses all bands once in a million; unlike pairs hardly ever meet.
BANDS = 35
ROWS = 5
# Bytes of text whose signatures are made together: each word needs a byte per slot.
SLICE_BYTES = 1 << 20
# Slots of which one byte is kept to compare signatures.
SKETCH = 128
UNSET = np.int64(1 << 62)


def signatures(code: np.ndarray, doc: np.ndarray, n_docs: int, slots: int) -> np.ndarray:
    """SuperMinHash of each document's set; rank in the upper, random bits in the lower half.

    ``(code, doc)`` are distinct and sorted by document. Rows of documents without elements
    stay unset. At most 256 slots.
    """
    values = np.full(n_docs * slots, UNSET)
    lives = doc
    at, order = code, None
    base = doc * slots
    step = 0
    while len(at):
        random = mix(at + BASE * np.arange(step + 1, step + 2, dtype=np.uint64))
        rank = (np.int64(step) << np.int64(32)) | (random >> np.uint64(32)).astype(np.int64)
        low = random & np.uint64(0xFFFFFFFF)
        place = step + ((low * np.uint64(slots - step)) >> np.uint64(32)).astype(np.int64)
        if order is None:
            slot = place
        else:
            rows = np.arange(len(at))
            slot = order[rows, place].astype(np.int64)
            order[rows, place] = order[:, step]
            order[:, step] = slot
        np.minimum.at(values, base + slot, rank)
        step += 1
        if step == slots:
            break
        full = values.reshape(n_docs, slots).max(1) < np.int64(step) << np.int64(32)
        go_on = ~full[lives]
        if order is None:
            at, lives, base, place = at[go_on], lives[go_on], base[go_on], place[go_on]
            order = np.tile(np.arange(slots, dtype=np.uint8), (len(at), 1))
            rows = np.arange(len(at))
            order[rows, place] = 0
            order[:, 0] = place
        elif not go_on.all():
            at, lives, base, order = at[go_on], lives[go_on], base[go_on], order[go_on]
    return values.reshape(n_docs, slots)


def band_codes(values: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One hash per band of each signature."""
    parts = values.view(np.uint64).reshape(len(values), bands, rows)
    code = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(rows):
        code = mix(code * BASE + parts[:, :, k])
    return code.view(np.int64)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _sketches(width: int):
    """Arrow function: texts to (set size, band hashes, one byte per slot)."""
    slots = BANDS * ROWS
    kind = pa.struct([("n", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])

    @F.arrow_udf("struct<n:bigint,bands:array<bigint>,sketch:binary>")
    def sketch(texts: pa.Array) -> pa.Array:
        parts = []
        for part in slices(texts, SLICE_BYTES):
            code, doc = shingles(part, width)
            size = np.bincount(doc, minlength=len(part)).astype(np.int64)
            values = signatures(code, doc, len(part), slots)
            some = size > 0
            bytes_ = (values[:, :SKETCH] & 0xFF).astype(np.uint8)
            ends = (np.arange(len(part) + 1) * SKETCH).astype(np.int32)
            parts.append(
                pa.StructArray.from_arrays(
                    [
                        pa.array(size),
                        _lists(band_codes(values)[some].ravel(), np.where(some, BANDS, 0)),
                        pa.Array.from_buffers(
                            pa.binary(),
                            len(part),
                            [None, pa.py_buffer(ends), pa.py_buffer(bytes_.tobytes())],
                        ),
                    ],
                    fields=list(kind),
                )
            )
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return sketch


def _sets(width: int):
    """Arrow function: texts to their whole shingle sets."""

    @F.arrow_udf("array<bigint>")
    def sets(texts: pa.Array) -> pa.Array:
        parts = []
        for part in slices(texts):
            code, doc = shingles(part, width)
            parts.append(_lists(code.view(np.int64), np.bincount(doc, minlength=len(part))))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))

    return sets


# Members that are compared with as many others in one go, and the shingles that count as one
# member where full sets are compared: a side of a square has about two million.
SQUARE = 512
MEMBER_SHINGLES = 4096


def _by_square(work_on):
    """Arrow partition function that hands the rows of each square to ``work_on``.

    Rows come sorted by square, ``(name, low, high)``; ``work_on`` returns pairs of groups.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def result(part: pa.Table) -> pa.RecordBatch:
            a, b = work_on(part.combine_chunks())
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            keys = np.stack([held[name].to_numpy() for name in ("name", "low", "high")])
            starts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            at = 0
            for end in starts.tolist():
                yield result(held.slice(at, end - at))
                at = end
            held = held.slice(at)
        if held is not None and held.num_rows:
            yield result(held)

    return run


def _joined_groups(percent: int, exact: bool):
    """Work on one square: pairs of groups that have members that may be (``exact``: are) linked.

    Members of different groups are compared unless sizes rule out a link or too few slots
    are equal: five standard deviations below what a pair at the threshold has. Groups
    joined once are one from then on.
    """
    share = percent / 100
    cut = share * SKETCH - 5 * (share * (1 - share) * SKETCH) ** 0.5

    def work_on(rows: pa.Table) -> tuple[list[int], list[int]]:
        names, group = np.unique(rows["root"].to_numpy(), return_inverse=True)
        if len(names) < 2:
            return [], []
        size, own = rows["n"].to_numpy(), rows["own"].to_numpy()
        sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8)
        sketch = sketch.reshape(len(size), SKETCH)
        if exact:
            sets = rows["members"].combine_chunks()
            flat = sets.flatten().to_numpy().view(np.uint64)  # the order they are sorted in
            ends = np.concatenate([[0], np.cumsum(size)])
        across = rows["low"][0].as_py() != rows["high"][0].as_py()
        found_a, found_b = [], []
        for i in range(len(size) - 1):
            fits = group[i + 1 :] != group[i]
            fits &= 100 * np.minimum(size[i + 1 :], size[i]) >= percent * np.maximum(size[i + 1 :], size[i])
            if across:
                fits &= own[i + 1 :] != own[i]
            others = np.flatnonzero(fits) + i + 1
            if len(others):
                others = others[(sketch[others] == sketch[i]).sum(1) >= cut]
            if exact and len(others):
                mine = flat[ends[i] : ends[i + 1]]
                theirs = np.concatenate([flat[ends[j] : ends[j + 1]] for j in others])
                at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
                sums = np.concatenate([[0], np.cumsum(mine[at] == theirs)])
                cuts = np.concatenate([[0], np.cumsum(size[others])])
                common = sums[cuts[1:]] - sums[cuts[:-1]]
                others = others[100 * common >= percent * (size[i] + size[others] - common)]
            for j in others.tolist():
                old, new = group[j], group[i]
                if old != new:
                    found_a.append(int(names[new]))
                    found_b.append(int(names[old]))
                    group[group == old] = new
        return found_a, found_b

    return _by_square(work_on)


def _squares(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members (``name, node, root`` and more) of each name dealt into squares, sorted."""
    parts = F.ceil(F.col("many") / SQUARE).cast("int")
    return (
        members.join(sizes, "name")
        .withColumn("own", F.pmod(F.xxhash64("node"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
        .drop("other", "many")
        .repartition("name", "low", "high")
        .sortWithinPartitions("name", "low", "high")
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets overlap enough."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    joined = pairs.join(left, "a").join(right, "b")
    return joined.where(F.lit(100) * common >= F.lit(percent) * union).select("a", "b")


def near_duplicate_texts(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row per distinct text: ``key, n_shingles, component_id, kept_row``.

    ``component_id`` is the smallest id whose text can be reached over links, which are
    pairs of texts with ``100 * |common shingles| >= percent * |all shingles|``; words are
    runs of bytes other than white space, A-Z lower-cased. ``kept_row`` is the ``row_key``
    of the row that stands for the group. Texts without words (and null) form no links:
    each such row stands for itself, so their ``component_id`` and ``kept_row`` are null.
    Null ids are never the smallest unless a group has no other.
    """
    work = Workspace(docs.sparkSession, "near-duplicates")
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")
    ).withColumn("key", text_key(F.col("text")))
    sketched = rows.select("id", "key", _sketches(width)("text").alias("s")).select(
        "id", "key", "s.n", F.struct("s.bands", "s.sketch").alias("marks")
    )
    # One node per distinct text, numbered once and for all by the written table.
    nodes = work.put(
        sketched.groupBy("key")
        .agg(F.min("id").alias("id"), F.max("n").alias("n"), F.any_value("marks").alias("marks"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    banded = nodes.select("node", F.explode("marks.bands").alias("code"))
    shared = (
        banded.groupBy("code")
        .agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("size"))
        .where("size > 1")
    )
    members = work.put(banded.join(shared, "code"), "members")
    candidates = members.select("node").distinct()
    wanted = nodes.join(candidates, "node", "left_semi").select("node", "key", "id")
    sets = work.put(
        rows.join(
            wanted.select("node", "key", F.col("id").alias("first")),
            ["key"],
        )
        .where(F.col("id").eqNullSafe(F.col("first")))
        .groupBy("node")
        .agg(F.any_value("text").alias("text"))
        .select("node", _sets(width)("text").alias("members")),
        "sets",
    )
    stars = members.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b"))
    links = work.put(_verified(stars.distinct(), sets, percent), "links")
    groups = components(links, work)

    # Groups that share a bucket and look alike; a square hands on at most one pair per group.
    placed = members.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = (
        placed.where("size > 2")
        .groupBy(F.col("code").alias("name"))
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("many"))
        .where("low < high")
        .select("name", "many")
    )
    marked = nodes.select("node", "n", F.col("marks.sketch").alias("sketch"))
    alike = work.put(
        _squares(
            placed.select(F.col("code").alias("name"), "node", "root").join(marked, "node"), mixed
        )
        .mapInArrow(_joined_groups(percent, exact=False), "a bigint, b bigint")
        .distinct(),
        "alike",
    )
    families = components(alike, work)
    named = alike.select(F.explode(F.array("a", "b")).alias("root")).distinct().join(
        families.select(F.col("node").alias("root"), F.col("root").alias("name")), "root", "left"
    ).withColumn("name", F.coalesce("name", "root"))
    relatives = work.put(
        placed.select("node", "root").distinct().join(named, "root"), "relatives"
    )
    # Squares of long documents have fewer members, so that their sets fit.
    large = F.ceil(F.sum("n") / MEMBER_SHINGLES)
    many = (
        relatives.join(nodes.select("node", "n"), "node")
        .groupBy("name")
        .agg(F.greatest(F.count(F.lit(1)), large).alias("many"))
    )
    more = work.put(
        _squares(relatives.join(marked, "node").join(sets, "node"), many).mapInArrow(
            _joined_groups(percent, exact=True), "a bigint, b bigint"
        ),
        "more-links",
    )
    groups = components(links.unionByName(more), work)

    named = nodes.join(groups, "node", "left").select(
        "key", "n", "id", F.coalesce("root", "node").alias("root")
    )
    # Null ids come last: the smallest of (is null, id).
    first = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("key").alias("key"))
    heads = named.where("n > 0").groupBy("root").agg(F.min(first).alias("first")).select(
        "root",
        F.col("first.id").alias("component_id"),
        F.col("first.key").alias("kept_key"),
    )
    result = work.put(
        named.join(heads, "root", "left").select(
            "key",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).alias("component_id"),
            F.when(F.col("n") > 0, F.col("kept_key")).alias("kept_key"),
        ),
        "groups",
    )
    work.drop(nodes, members, sets, links, alike, relatives, more)
    return result


def near_duplicate_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row per document: its id, ``n_shingles, component_id, kept``.

    See ``near_duplicate_texts`` for links. A document without words is a group of its own.
    ``kept`` marks documents whose id is their ``component_id``; a null id is kept where
    its group has no other. Empty input gives no rows.
    """
    texts = near_duplicate_texts(
        docs, id_col=id_col, text_col=text_col, width=width, percent=percent
    )
    rows = docs.select(F.col(id_col).alias(id_col), text_key(F.col(text_col)).alias("__key"))
    found = rows.join(texts.withColumnRenamed("key", "__key"), "__key")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(id_col))
    return found.select(
        id_col,
        "n_shingles",
        component.alias("component_id"),
        F.col(id_col).eqNullSafe(component).alias("kept"),
    )


def keep_one_per_group(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """The rows of ``docs`` without near duplicates, one of each group, all columns as they are.

    The row with the smallest id stands for its group (of rows with that id, the one whose
    text has the smallest key; of full repeats, one). Rows without words all stay. Columns may have
    any names; an empty table stays empty.
    """
    texts = near_duplicate_texts(
        docs, id_col=id_col, text_col=text_col, width=width, percent=percent
    )
    heads = texts.where("n_shingles > 0 AND key = kept_key").select(
        row_key(F.col("component_id"), F.lit("")).alias("id_key"), "key"
    )
    empty = texts.where("n_shingles = 0").select("key")
    # The row's own columns are kept apart from the keys, whatever their names.
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        text_key(F.col(text_col)).alias("key"),
        row_key(F.col(id_col), F.lit("")).alias("id_key"),
    )
    kept = marked.join(heads, ["key", "id_key"], "left_semi").dropDuplicates(["key", "id_key"])
    wordless = marked.join(empty, "key", "left_semi")
    return kept.unionByName(wordless).select("doc.*")

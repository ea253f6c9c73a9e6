"""Packing token sequences: bounded-space online best-fit.

Texts become token ids of a public vocabulary, each document ended by a separator id;
documents longer than a sequence are cut into full pieces, of which the first may be
shorter. Pieces then go into sequences in the order in which they come: each into the open
sequence that it leaves with the least free space. Open sequences are held by their free
space, with a bitset of the values in use, so the best one is found by one shift. Their
number is fixed; when one more is needed, the fullest is closed.

Each task packs the pieces it reads. What its open sequences hold at the end are units that
are packed again, in groups of bounded size that are drawn anew each round, until what still
has room is one group or a round saves nothing. Every piece is placed in any case.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from leafmill.llm.tables import Workspace
from leafmill.llm.words import text_bytes, worker_cache

LENGTH = 2048
SEPARATOR = 0
OPEN = 4096
# Units that are packed together in one task when open sequences are packed again.
GROUP_UNITS = 1 << 16
# The end of the vocabulary's pattern: a run of white space leaves its last character to what
# follows. Looking ahead makes matching slow, and on long runs overflows its stack, so runs are
# found here and the rest is split without.
RUN_RULE, ONE_BLANK = r"|\s+(?!\S)|\s+", r"|\s"
# White space as the pattern has it.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUN = re.compile(f"[{WHITE}]{{2,}}")
ASCII_BLANK = np.zeros(256, bool)
ASCII_BLANK[[9, 10, 11, 12, 13, 32]] = True
WIDE_LEAD = np.zeros(256, bool)
WIDE_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def may_have_runs(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each text (its bytes begin at ``starts``) whether white space may follow white space.

    True also for bytes with which white space outside of ASCII begins.
    """
    blank = ASCII_BLANK[data]
    at = np.flatnonzero((blank[1:] & blank[:-1]) | WIDE_LEAD[data[1:]])
    out = np.zeros(len(starts) - 1, bool)
    out[np.searchsorted(starts, at + 1, "right") - 1] = True
    first = data[starts[:-1][starts[:-1] < starts[1:]]]
    out[starts[:-1] < starts[1:]] |= WIDE_LEAD[first]
    return out


def byte_bpe(path: str) -> Callable[..., bytes]:
    """A function from a text to its ids (little-endian, four bytes each).

    ``path`` is a vocabulary file: pairs of a base64 byte string and its rank. A text is
    encoded whole; a table of words seen before costs more than it saves. The function's second
    argument may say that the text has no runs of white space, which saves looking for them.
    """
    held = worker_cache(f"byte-bpe {path}")
    if "encode" in held:
        return held["encode"]
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    if not public_tokenizers.PATTERN.endswith(RUN_RULE):
        raise ValueError("the vocabulary splits white space in another way")
    own = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN.removesuffix(RUN_RULE) + ONE_BLANK,
        mergeable_ranks=ranks,
        special_tokens={},
    )

    def encode(text: str, runs: bool = True) -> bytes:
        run = RUN.search(text) if runs else None
        if not run:
            return array("I", own.encode_ordinary(text)).tobytes()
        ids, at = [], 0
        while run:
            end = run.end() - (run.end() < len(text))
            ids += own.encode_ordinary(text[at : run.start()])
            ids += own._encode_single_piece(text[run.start() : end])
            at = end
            run = RUN.search(text, run.end())
        ids += own.encode_ordinary(text[at:])
        return array("I", ids).tobytes()

    held["encode"] = encode
    return encode


def _pieces(path: str, length: int, separator: int, with_ids: bool):
    """Arrow function: texts to lists of pieces."""
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    ddl = "piece:int,start:bigint,length:bigint,ids_crc32:bigint"
    if with_ids:
        fields.append(("ids", pa.binary()))
        ddl += ",ids:binary"
    end = np.asarray([separator], "<u4").tobytes()

    @F.arrow_udf(f"array<struct<{ddl}>>")
    def pieces(texts: pa.Array) -> pa.Array:
        encode = byte_bpe(path)
        counts, columns = [0], [[] for _ in fields]
        runs = may_have_runs(*text_bytes(texts)).tolist()
        for text, some in zip(texts, runs, strict=True):
            ids = encode(text.as_py() or "", some) + end
            total = len(ids) // 4
            bounds = [0, *range(total - (total - 1) // length * length, total + 1, length)]
            for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                part = ids[4 * a : 4 * b]
                row = (k, a, b - a, zlib.crc32(part), part)
                for column, value in zip(columns, row, strict=False):
                    column.append(value)
            counts.append(len(columns[0]))
        values = pa.StructArray.from_arrays(
            [pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)],
            fields=[pa.field(*f) for f in fields],
        )
        return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), values)

    return pieces


class OpenSequences:
    """A fixed number of open sequences, found by free space; see the module's text."""

    def __init__(self, length: int, most_open: int):
        self.length, self.most_open = length, most_open
        self.by_free: list[list[list]] = [[] for _ in range(length + 1)]
        self.mask = 0
        self.count = 0

    def add(self, item, size: int) -> list[list]:
        """Put an item in; returns the sequences that this closes, each ``[used, items]``."""
        closed = []
        fitting = self.mask >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            if self.count == self.most_open:
                closed.append(self._take((self.mask & -self.mask).bit_length() - 1))
            free, sequence = self.length, [0, []]
        sequence[1].append((item, sequence[0]))
        sequence[0] += size
        free -= size
        if free:
            self.by_free[free].append(sequence)
            self.mask |= 1 << free
            self.count += 1
        else:
            closed.append(sequence)
        return closed

    def _take(self, free: int) -> list:
        sequence = self.by_free[free].pop()
        if not self.by_free[free]:
            self.mask &= ~(1 << free)
        self.count -= 1
        return sequence

    def rest(self) -> list[list]:
        return [sequence for group in self.by_free for sequence in group]


def _pack(length: int, most_open: int):
    """Arrow partition function: rows get ``sequence``, ``offset``, ``used`` and ``open``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenSequences(length, most_open)
        number = TaskContext.get().partitionId() << 33
        done: list[tuple] = []
        names = None

        def put(sequence: list, left: bool) -> None:
            nonlocal number
            for row, offset in sequence[1]:
                done.append((*row, number, offset, sequence[0], left))
            number += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            done.clear()
            kinds = [*types, pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            return pa.record_batch(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                names=[*names, "sequence", "offset", "used", "open"],
            )

        for batch in batches:
            names, types = batch.schema.names, batch.schema.types
            lengths = batch.column(names.index("length")).to_pylist()
            rows = zip(*[column.to_pylist() for column in batch.columns], strict=True)
            for row, size in zip(rows, lengths, strict=True):
                for sequence in bins.add(row, size):
                    put(sequence, False)
            if done:
                yield flush()
        for sequence in bins.rest():
            put(sequence, True)
        if done:
            yield flush()

    return pack


def _merge_group(length: int):
    """Pack the units of one group again, largest first, all sequences open."""

    def merge(rows: pa.Table) -> pa.Table:
        units, used = rows["unit"].to_pylist(), rows["used"].to_pylist()
        bins = OpenSequences(length, len(units) + 1)
        done = []
        for size, unit in sorted(zip(used, units, strict=True), reverse=True):
            done += bins.add(unit, size)
        done += bins.rest()
        out = [(unit, s[1][0][0], offset, s[0]) for s in done for unit, offset in s[1]]
        columns = list(zip(*out, strict=True))
        return pa.table(
            [pa.array(c, pa.int64()) for c in columns], names=["unit", "into", "shift", "used"]
        )

    return merge


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    separator: int = SEPARATOR,
    most_open: int = OPEN,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, ``piece, start, length, ids_crc32, sequence_id, offset``.

    ``start`` counts the document's ids before the piece, ``offset`` those before it in its
    sequence; offsets of a sequence have no gaps. ``with_ids`` adds the ids themselves. A
    null or empty text is the separator alone. Repeated rows are packed each. Empty input
    gives no rows.
    """
    work = Workspace(docs.sparkSession, "packing")
    cut = docs.select(
        F.col(id_col).alias("id"),
        _pieces(vocabulary, length, separator, with_ids)(F.col(text_col)).alias("pieces"),
    )
    pieces = work.put(cut.select("id", F.inline("pieces")), "pieces")
    layout = pieces.select("id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout.schema)
    packed = work.put(
        layout.mapInArrow(
            _pack(length, most_open), f"{kinds}, sequence bigint, offset bigint, used bigint, open boolean"
        ),
        "packed",
    )
    moves = _merged(packed, work, length)
    return packed.join(
        moves.withColumnRenamed("unit", "sequence"), "sequence", "left"
    ).select(
        F.col("id").alias(id_col),
        *layout.columns[1:],
        F.coalesce("into", "sequence").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )


def _merged(packed: DataFrame, work: Workspace, length: int) -> DataFrame:
    """``unit, into, shift``: where each sequence that was open at the end of a task goes."""
    units = packed.where("open").groupBy(F.col("sequence").alias("unit")).agg(
        F.max("used").alias("used")
    )
    moves = work.put(
        units.select("unit", F.col("unit").alias("into"), F.lit(0).cast("bigint").alias("shift"), "used"),
        "units",
    )
    left, salt = None, 0
    while True:
        heads = moves.where("unit = into").select(F.col("into").alias("unit"), "used")
        least, many = heads.agg(F.min("used"), F.count(F.lit(1))).first()
        if left is not None and many >= left:
            break
        left = many
        # What not even the smallest unit fits into is final.
        loose = heads.where(F.col("used") <= F.lit(length - (least or 0)))
        groups = -(-loose.count() // GROUP_UNITS)
        if not groups:
            break
        step = work.put(
            loose.withColumn("group", F.pmod(F.xxhash64("unit", F.lit(salt)), F.lit(groups)))
            .groupBy("group")
            .applyInArrow(_merge_group(length), "unit bigint, into bigint, shift bigint, used bigint"),
            "merges",
        )
        moved = step.select(
            F.col("unit").alias("old"), F.col("into").alias("new"), "shift", F.col("used").alias("filled")
        )
        moves = work.put(
            moves.select("unit", F.col("into").alias("old"), F.col("shift").alias("own"), "used")
            .join(moved, "old", "left")
            .select(
                "unit",
                F.coalesce("new", "old").alias("into"),
                (F.col("own") + F.coalesce("shift", F.lit(0))).alias("shift"),
                F.coalesce("filled", "used").alias("used"),
            ),
            "moves",
        )
        if groups == 1:
            break
        salt += 1
    return moves.select("unit", "into", "shift")

"""Stage 1: files to text."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from leafmill.functions.text import (
    file_name,
    file_stem,
    iso_text,
    line_elements,
    markup_elements,
)
from leafmill.operators.shaping import error_text, once, plain_text, stored
from leafmill.settings import shared_dir

Parser = Callable[[bytes], Iterable[object]]

# Text a parser worker gathers before handing it on.
HELD_CHARS = 16_000_000
# Bytes after which a run of joined elements ends, and the most that one value can have (Spark's
# limit is 2 GB, of which some is for its own use).
RUN_BYTES = 8 << 20
MAX_BYTES = (1 << 31) - (1 << 16)

BUILT_IN = {"lines": line_elements, "markup": markup_elements}


def extract_elements(
    files: DataFrame,
    parser: str | Parser = "lines",
    *,
    key: str = "path",
    content: str = "content",
) -> DataFrame:
    """Turn each file into its ordered text elements: ``(key, elements, error)``.

    ``parser`` is "lines" or "markup" (expressions only, no Python worker) or a
    function from the file's bytes to its elements, for formats that need a library.
    A file that cannot be parsed keeps its row with ``error`` set and no elements, and so does one
    that already came with an ``error``, which is kept; the parser is not called for it. One row
    per file, so no shuffle is needed to put a document together again.
    """
    earlier = F.col("error") if "error" in files.columns else F.lit(None).cast("string")
    files = files.select(key, content, earlier.alias("error"))
    if callable(parser):
        return _parse_in_python(files, parser, key, content)
    raw = F.col(content)
    if isinstance(files.schema[content].dataType, T.BinaryType):
        text = F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string"))
    else:
        text = raw
    error = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(raw.isNull(), F.lit("no content"))
        .when(text.isNull(), F.lit("not valid UTF-8"))
    )
    elements = F.when(F.col("error").isNull() & text.isNotNull(), BUILT_IN[parser](text))
    return once(files, elements=elements, error=error).select(
        key, "elements", "error"
    )


def _parse_in_python(files: DataFrame, parser: Parser, key: str, content: str) -> DataFrame:
    schema = T.StructType(
        [
            files.schema[key],
            T.StructField("elements", T.ArrayType(T.StringType())),
            T.StructField("error", T.StringType()),
        ]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begun, lists, errors, held = 0, [], [], 0
            for i in range(batch.num_rows):
                elements, error = None, batch.column(2)[i].as_py()
                if error is None:
                    try:
                        elements = [plain_text(str(e)) for e in parser(batch.column(1)[i].as_py())]
                        held += sum(map(len, elements))
                    except Exception as problem:  # one bad file must not stop the others
                        elements, error = None, error_text(problem)
                lists.append(elements)
                errors.append(error)
                if held > HELD_CHARS or i + 1 == batch.num_rows:
                    # The key stays in its Arrow column, whatever its type.
                    yield pa.record_batch(
                        [
                            batch.column(0).slice(begun, len(lists)),
                            pa.array(lists, pa.list_(pa.string())),
                            pa.array(errors, pa.string()),
                        ],
                        names=schema.names,
                    )
                    begun, lists, errors, held = i + 1, [], [], 0

    return files.mapInArrow(parse, schema)


def explode_elements(extracted: DataFrame, key: str = "path") -> DataFrame:
    """One row per element: ``(key, seq, text, error)``; a file without any keeps one row."""
    return extracted.select(
        key, "error", F.posexplode_outer("elements").alias("seq", "text")
    ).select(key, "seq", "text", "error")


def join_elements(elements: str | Column = "elements") -> Column:
    """A document's text from its element list; NULL when there is no list."""
    return F.array_join(elements, "\n")


def assemble_runs(
    elements: DataFrame,
    key: str,
    seq: str,
    text: str = "text",
    *,
    run_length: int = 4096,
    run_bytes: int = RUN_BYTES,
) -> DataFrame:
    """Join elements in order within runs: ``(key, run, text)``.

    A run has at most ``run_length`` positions, and ends with the element that brings it to
    ``run_bytes``, so it is no longer than that and one element. The positions of a document are
    spread over tasks, whatever its share of the rows. Joined by newline in run order the runs
    are the document; use them as they are where a document is too long for one value.
    """
    block = F.floor(F.col(seq) / run_length)
    placed = elements.select(key, block.alias("_block"), F.col(seq).alias("_seq"), F.col(text).alias("text"))
    earlier = Window.partitionBy(key, "_block").orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1)
    so_far = F.coalesce(F.sum(_size("text")).over(earlier), F.lit(0))
    # The number of a run orders the runs of a document; it has gaps.
    run = F.shiftleft("_block", 32) + F.floor(so_far / run_bytes)
    cut = placed.withColumn("run", run)
    return cut.groupBy(key, "_block", "run").agg(_ordered_join("text", "_seq").alias("text")).drop("_block")


def assemble_text(
    elements: DataFrame,
    key: str,
    seq: str,
    text: str = "text",
    *,
    run_length: int = 4096,
    run_bytes: int = RUN_BYTES,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """Join each document's elements, in order, by newline: ``(key, content, error)``.

    Positions are whole numbers from 0, unique within a document. Runs bounded by positions and
    bytes are joined first, so the last step only puts together as many values as the document has
    runs. A document without elements gets ''. One of more than ``max_bytes`` has no content and
    an ``error`` instead of stopping the others; such are found, when this is called, by one pass
    over the sizes that moves no text, and ``assemble_runs`` still gives their runs.
    """
    total = F.sum(_size(text)) - 1
    long = stored(
        elements.groupBy(F.col(key).alias("_key")).agg(total.alias("_bytes")).where(F.col("_bytes") > max_bytes),
        shared_dir(elements.sparkSession, "long"),
    )
    some_long = long.limit(1).count() > 0
    fitting = elements.join(long, F.col(key).eqNullSafe(F.col("_key")), "left_anti") if some_long else elements
    runs = assemble_runs(fitting, key, seq, text, run_length=run_length, run_bytes=run_bytes)
    joined = runs.groupBy(key).agg(
        F.coalesce(_ordered_join("text", "run"), F.lit("")).alias("content"),
        F.lit(None).cast("string").alias("error"),
    )
    if not some_long:
        return joined
    told = F.concat("_bytes", F.lit(f" bytes are more than {max_bytes}"))
    return joined.unionAll(long.select("_key", F.lit(None).cast("string"), told))


def _size(text: str) -> Column:
    """Bytes that an element adds to its document, with the newline; a NULL one adds nothing."""
    return F.coalesce(F.octet_length(text) + 1, F.lit(0)).cast("bigint")


def _ordered_join(text: str, order: str) -> Column:
    return F.expr(f"listagg(`{text}`, '\\n') WITHIN GROUP (ORDER BY `{order}`)")


def assign_ids(df: DataFrame, column: str = "doc_uid") -> DataFrame:
    """Give each row a random id. Write the result before branching from it."""
    return df.withColumn(column, F.expr("uuid()"))


def with_file_names(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Add ``filename`` and ``stem`` taken from a path."""
    return df.withColumn("filename", file_name(F.col(path_col))).withColumn(
        "stem", file_stem(F.col("filename"))
    )


def with_extraction_date(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Add ``extraction_date`` as ISO text, by default the time of the query."""
    moment = F.current_timestamp() if at is None else at
    return df.withColumn("extraction_date", iso_text(moment))


def split_failures(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without and with an ``error``.

    Both frames come from ``df``: where it holds a Python hook, write it first so the
    hook runs once.
    """
    return df.where(F.col("error").isNull()), df.where(F.col("error").isNotNull())

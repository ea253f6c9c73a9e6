"""Folder scans: what files there are, and what they hold.

Any URI works that Arrow or Hadoop knows (``file:``, ``s3a:``, ``hdfs:`` ...). Names are literal and
the suffix is matched case-sensitively. Empty files and names that start with ``.`` or ``_`` count
like all others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from leafmill.functions.text import file_name
from leafmill.operators.shaping import error_text
from leafmill.schemas import FILES, LISTING
from leafmill.sources.listing import OpenFs, list_tree, open_by_uri, opens_in_tasks, qualified

# Bytes and number of files that a reading task is given, and bytes that a worker holds before it
# hands them on.
TASK_BYTES = 256 << 20
TASK_FILES = 10_000
HELD_BYTES = 32 << 20
LONGEST = "spark.sql.sources.binaryFile.maxLength"


def _with_suffix(files: DataFrame, suffix: str | None) -> DataFrame:
    return files.where(F.endswith("path", F.lit(suffix))) if suffix else files


def scan_documents(
    spark: SparkSession,
    path: str,
    suffix: str = ".pdf",
    *,
    max_bytes: int | None = None,
    open_fs: OpenFs | None = None,
) -> DataFrame:
    """All files under ``path``, at any depth, whose name ends in ``suffix``, with their contents.

    Columns are those of ``FILES``; a missing folder gives no rows. A file that is too long (over
    ``max_bytes``, by default Spark's own limit), cannot be read or has vanished since it was
    listed keeps its row, with the reason in ``error`` and no content; so does a folder that
    cannot be listed. Files are listed when this is called and opened when the result is used.
    """
    files = _with_suffix_or_error(list_tree(spark, path, open_fs=open_fs), suffix)
    return read_contents(files, max_bytes=max_bytes, open_fs=open_fs, root=qualified(spark, path))


def _with_suffix_or_error(files: DataFrame, suffix: str | None) -> DataFrame:
    """The files of that suffix, and folders that could not be listed (they have no length)."""
    if not suffix:
        return files
    return files.where(F.endswith("path", F.lit(suffix)) | (F.col("error").isNotNull() & F.col("length").isNull()))


def read_contents(
    files: DataFrame,
    *,
    max_bytes: int | None = None,
    open_fs: OpenFs | None = None,
    root: str | None = None,
) -> DataFrame:
    """Open every listed file within a task: the rows of ``list_tree`` with ``content``.

    Rows are dealt out by number so that a task has about ``TASK_BYTES`` to read, and no more than
    about ``TASK_FILES`` files. A worker holds one file and ``HELD_BYTES`` more. ``root`` is the URI that was listed; where Arrow has no file
    system for it and ``open_fs`` is not given, Spark's own reader fetches the contents and a file
    it skips keeps its row.
    """
    spark = files.sparkSession
    most = max_bytes if max_bytes is not None else int(spark.conf.get(LONGEST))
    listed = files.select("path", "modificationTime", "length", "error")
    if open_fs is None and root is not None and not opens_in_tasks(root):
        return _read_by_spark(listed, root, most)
    open_one = open_fs or open_by_uri

    def fetch(path: str, length: int | None) -> bytes:
        if length is not None and length > most:
            raise OverflowError(f"{length} bytes are more than {most}")
        fs, base = open_one(path)
        with fs.open_input_stream(base) as stream:
            data = stream.read(most + 1)
        if len(data) > most:
            raise OverflowError(f"the file has more than {most} bytes")
        return data

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begun, contents, errors, held = 0, [], [], 0
            for i in range(batch.num_rows):
                content, error = None, batch.column(3)[i].as_py()
                if error is None:
                    try:
                        content = fetch(batch.column(0)[i].as_py(), batch.column(2)[i].as_py())
                        held += len(content)
                    except Exception as problem:  # one bad file must not stop the others
                        error = error_text(problem)
                contents.append(content)
                errors.append(error)
                if held > HELD_BYTES or i + 1 == batch.num_rows:
                    told = batch.slice(begun, len(contents))
                    yield pa.record_batch(
                        [*told.columns[:3], pa.array(contents, pa.binary()), pa.array(errors, pa.string())],
                        names=FILES.names,
                    )
                    begun, contents, errors, held = i + 1, [], [], 0

    total, many = listed.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    cores = spark.sparkContext.defaultParallelism
    tasks = max(1, min(many, max(cores, -(-total // TASK_BYTES), -(-many // TASK_FILES))))
    return listed.repartition(tasks).mapInArrow(read, FILES)


def _read_by_spark(listed: DataFrame, root: str, most: int) -> DataFrame:
    literal = re.sub(r"([\\*?\[\]{}])", r"\\\1", root)
    reader = listed.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true")
    held = reader.load(literal).where(F.col("length") <= most).select(F.col("path").alias("of"), "content")
    told = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("length") > most, F.concat("length", F.lit(f" bytes are more than {most}")))
        .when((F.col("length") > 0) & F.col("content").isNull(), F.lit("skipped by Spark's reader"))
    )
    content = F.when(F.col("length") == 0, F.lit(bytearray())).otherwise(F.col("content"))
    joined = listed.join(held, F.col("path") == F.col("of"), "left")
    return joined.select("path", "modificationTime", "length", content.alias("content"), told.alias("error"))


def list_files(
    spark: SparkSession,
    path: str,
    suffix: str | None = None,
    recursive: bool = False,
    *,
    open_fs: OpenFs | None = None,
) -> DataFrame:
    """Files in a folder as ``(name, path, length, modificationTime)``, contents unread.

    ``name`` is relative to the folder. Without ``recursive`` only the files of the folder itself
    are listed. A missing folder gives no rows; one that cannot be listed has none either, and
    ``list_tree`` tells why.
    """
    base = qualified(spark, path).rstrip("/")
    listed = _with_suffix(list_tree(spark, path, recursive=recursive, open_fs=open_fs), suffix)
    name = F.when(F.col("path") == base, file_name(F.col("path"))).otherwise(
        F.substring("path", len(base) + 2, 1 << 30)
    )
    return listed.where(F.col("length").isNotNull()).select(
        name.alias("name"), "path", "length", "modificationTime"
    )


def list_prefix(
    spark: SparkSession, prefix: str, suffix: str | None = None, *, open_fs: OpenFs | None = None
) -> DataFrame:
    """Files whose full path begins with ``prefix``, at any depth, as object stores list them.

    The prefix is literal. Sub-folders of its folder that do not begin with it are not entered.
    """
    if prefix.endswith("/"):
        whole = qualified(spark, prefix) + "/"
        listed = list_tree(spark, prefix, open_fs=open_fs)
    else:
        whole = qualified(spark, prefix)
        above, _, start = whole.rpartition("/")
        listed = list_tree(spark, f"{above}/", open_fs=open_fs, start=start)
    files = _with_suffix(listed.where(F.startswith("path", F.lit(whole))), suffix)
    return files.where(F.col("length").isNotNull()).select(
        file_name(F.col("path")).alias("name"), "path", "length", "modificationTime"
    ).to(LISTING)


def read_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Contents of one file, of a folder or of a glob as ``(path, content)``.

    Unlike the scans, a path that does not exist is an error.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(path).select("path", "content")

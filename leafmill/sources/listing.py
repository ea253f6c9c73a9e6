"""Folder listings made in tasks.

Spark lists folders on the driver, leaves out empty files and names that start with ``.`` or ``_``,
and reads ``[``, ``{`` and ``*`` in a folder's name as a pattern. Here each task lists the folders
it is given through the file system itself and goes down into what it finds, up to a number of
entries; folders left over are dealt out again. So a tree of any shape is spread over the cluster
in a few rounds, the driver sees counts alone, and every file is found under its literal name.

Tasks open file systems by URI with Arrow (local files, S3, GCS, HDFS, Azure). For a scheme that
Arrow does not have, give ``open_fs``; without one, Hadoop's file system lists on the driver.
"""

from __future__ import annotations

import datetime
import itertools
import os
import re
import stat
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from leafmill.operators.shaping import error_text
from leafmill.settings import shared_dir

# A function from a URI to an Arrow file system and the path in it; it runs on the executors.
OpenFs = Callable[[str], tuple[pafs.FileSystem, str]]

# Entries that a task lists before it hands on the folders that it has not come to.
TASK_ENTRIES = 20_000
# Rows that a worker, or the driver where it has to list, holds at a time.
HELD_ROWS = 5_000
FOUND = "folder boolean, path string, modificationTime timestamp, length bigint, error string"
COLUMNS = ("path", "modificationTime", "length", "error")


def qualified(spark: SparkSession, path: str) -> str:
    """The full URI of a path as Hadoop writes it, special characters left as they are."""
    if not re.match("/|[A-Za-z][A-Za-z0-9+.-]*:", path):
        raise ValueError(f"not an absolute path or URI: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()


def open_by_uri(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a URI, and the path in it.

    The path is taken apart by hand: unlike in a true URI its special characters are not escaped.
    """
    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        return pafs.LocalFileSystem(), re.sub("^//[^/]*", "", rest)
    host, _, path = rest.removeprefix("//").partition("/")
    known = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    fs, base = pafs.FileSystem.from_uri(f"{known}://{host}/")
    return fs, f"{base.rstrip('/')}/{path}"


def _moment(nanoseconds: int | None) -> datetime.datetime | None:
    """A time stamp in whole milliseconds, as file systems of all kinds have it."""
    if nanoseconds is None:
        return None
    return datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc) + datetime.timedelta(
        milliseconds=nanoseconds // 1_000_000
    )


def _entries(fs: pafs.FileSystem, base: str) -> Iterator[tuple[str, bool, int | None, int | None, str | None]]:
    """``(name, is a folder, time, length, error)`` of what a folder holds.

    Local folders are read entry by entry: that also shows links that lead nowhere. Links to
    folders are left out, as they may lead back up.
    """
    if not isinstance(fs, pafs.LocalFileSystem):
        for info in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)):
            folder = info.type == pafs.FileType.Directory
            yield info.base_name, folder, info.mtime_ns, max(info.size or 0, 0), None
        return
    with os.scandir(base) as entries:
        for entry in entries:
            if entry.is_dir():
                if not entry.is_symlink():
                    yield entry.name, True, None, None, None
                continue
            try:
                told = entry.stat()
            except OSError as problem:
                yield entry.name, False, None, 0, error_text(problem)
                continue
            regular = stat.S_ISREG(told.st_mode)
            yield entry.name, False, told.st_mtime_ns, told.st_size, None if regular else "not a regular file"


def _lister(open_fs: OpenFs, recursive: bool, entries: int, held: int, root: str, start: str):
    """Arrow partition function: folder paths to rows of ``FOUND``.

    In the root only entries whose names begin with ``start`` count.
    """

    def look(folder: str) -> Iterator[tuple]:
        fs, base = open_fs(folder)
        info = fs.get_file_info(base)
        if info.type == pafs.FileType.NotFound:
            return
        if info.type == pafs.FileType.File:
            yield False, folder, _moment(info.mtime_ns), info.size, None
            return
        for name, is_folder, at, length, error in _entries(fs, base):
            if folder == root and not name.startswith(start):
                continue
            path = f"{folder.rstrip('/')}/{name}"
            if is_folder and not recursive:
                continue
            try:
                path.encode()
            except UnicodeEncodeError:
                path = path.encode("utf-8", "backslashreplace").decode()
                is_folder, length, error = False, length or 0, "the name is not valid UTF-8"
            yield is_folder, path, None if is_folder else _moment(at), None if is_folder else length, error

    def visit(folder: str) -> Iterator[tuple]:
        try:
            yield from look(folder)
        except Exception as problem:  # one folder must not stop the others
            yield False, folder, None, None, error_text(problem)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.bool_(), pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.string()]
        names = ["folder", *COLUMNS]
        waiting: list[str] = []
        seen = 0

        def rows() -> Iterator[tuple]:
            nonlocal seen
            for batch in batches:
                waiting.extend(batch.column(0).to_pylist())
                # Every folder given is listed, so that each round gets on.
                given = len(waiting)
                while waiting and (given > 0 or seen < entries):
                    for row in visit(waiting.pop(0) if given > 0 else waiting.pop()):
                        seen += 1
                        if row[0]:
                            waiting.append(row[1])
                        else:
                            yield row
                    given -= 1
            for folder in waiting:
                yield True, folder, None, None, None

        made = rows()
        while part := list(itertools.islice(made, held)):
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)], names=names)

    return run


def opens_in_tasks(root: str) -> bool:
    """Whether Arrow can open file systems of this scheme."""
    try:
        open_by_uri(root)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def list_tree(
    spark: SparkSession,
    path: str,
    *,
    recursive: bool = True,
    open_fs: OpenFs | None = None,
    task_entries: int = TASK_ENTRIES,
    start: str = "",
) -> DataFrame:
    """Every file below a folder as ``(path, modificationTime, length, error)``.

    With ``start`` only entries of the folder count whose names begin with it.
    A path to a file gives that file, one that does not exist no rows. A folder that cannot be
    listed, or an entry that is gone by then, is one row with an ``error``. Links to folders are
    not entered. The rows are stored; reading them again lists nothing.
    """
    root = qualified(spark, path)
    place = shared_dir(spark, "listing")
    if open_fs is None and not opens_in_tasks(root):
        return _listed_on_driver(spark, root, recursive, start, place)
    run = _lister(open_fs or open_by_uri, recursive, task_entries, HELD_ROWS, root, start)
    cores = spark.sparkContext.defaultParallelism
    folders, many, rounds = spark.createDataFrame([(root,)], "path string"), 1, 0
    while many:
        found = folders.repartition(min(many, 4 * cores)).mapInArrow(run, FOUND)
        found.write.parquet(f"{place}/{rounds}")
        stored = spark.read.schema(FOUND).parquet(f"{place}/{rounds}")
        folders = stored.where("folder").select("path")
        many, rounds = folders.count(), rounds + 1
    rows = spark.read.schema(FOUND).parquet(*[f"{place}/{i}" for i in range(rounds)])
    return rows.where("NOT folder").select(*COLUMNS)


def _listed_on_driver(spark: SparkSession, root: str, recursive: bool, start: str, place: str) -> DataFrame:
    """The same rows by Hadoop's file system, folder by folder, written out as they come."""
    jvm = spark._jvm
    first = jvm.org.apache.hadoop.fs.Path(root)
    fs = first.getFileSystem(spark._jsc.hadoopConfiguration())
    waiting, held, parts = [first], [], 0

    def put(force: bool) -> None:
        nonlocal held, parts
        if held and (force or len(held) >= HELD_ROWS):
            spark.createDataFrame(held, FOUND).write.parquet(f"{place}/{parts}")
            held, parts = [], parts + 1

    while waiting:
        folder = waiting.pop()
        if not fs.exists(folder):
            continue
        entries = fs.listStatusIterator(folder)
        while entries.hasNext():
            entry = entries.next()
            if folder is first and not entry.getPath().getName().startswith(start):
                continue
            if entry.isDirectory():
                if recursive:
                    waiting.append(entry.getPath())
                continue
            at = datetime.datetime.fromtimestamp(entry.getModificationTime() / 1000, datetime.timezone.utc)
            held.append((False, entry.getPath().toString(), at, entry.getLen(), None))
            put(False)
    put(True)
    if not parts:
        return spark.createDataFrame([], FOUND).select(*COLUMNS)
    return spark.read.schema(FOUND).parquet(*[f"{place}/{i}" for i in range(parts)]).select(*COLUMNS)

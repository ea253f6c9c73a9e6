"""Dataset sinks.

One file per document does not scale, so a folder of JSON files becomes a JSON Lines dataset
with the would-be file name as a column. Its rows lie in a fixed number of folders by the hash of
that name; writing again replaces the documents that come again and leaves the others, and
touches only the folders in which something changes.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from leafmill.functions.text import file_stem
from leafmill.operators.shaping import stored
from leafmill.operators.structure import keep_last
from leafmill.settings import remove_folder, shared_dir
from leafmill.sources.listing import OpenFs, open_by_uri, opens_in_tasks


# Folders of a dataset that is replaced name by name.
BUCKETS = 64


def write_dataset(df: DataFrame, path: str, fmt: str = "json", **options: str) -> str:
    """Write a frame as ``json`` (one object per row) or ``text`` (one string column).

    Text with ``maxRecordsPerFile`` of 1 and no other option is one file per row. Where Arrow can
    open the file system, tasks write those files themselves: Spark's writer takes some 20 ms for
    each, and its commit moves them one by one on the driver.
    """
    if fmt not in ("json", "text"):
        raise ValueError(f"format must be json or text, not {fmt!r}")
    apart = {name: str(value) for name, value in options.items()} == {"maxRecordsPerFile": "1"}
    if fmt == "text" and apart and [kind for _, kind in df.dtypes] == ["string"]:
        if _write_lines_apart(df, path):
            return path
    df.write.mode("overwrite").options(**options).format(fmt).save(path)
    return path


def _write_lines_apart(df: DataFrame, path: str) -> bool:
    """Write a folder of one file per row, unless Arrow has no file system for it.

    The folder is written in full beside the old one, which it then replaces.
    """
    spark = df.sparkSession
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = new_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    place = fs.makeQualified(new_path(path))
    if place.getParent() is None or not opens_in_tasks(place.toString()):
        return False
    aside = new_path(place.getParent(), f"_writing-{uuid.uuid4().hex}")
    try:
        write_files(_line_files(df, aside.toString()))
        fs.create(new_path(aside, "_SUCCESS"), True).close()
    except Exception:
        remove_folder(spark, aside.toString())
        raise
    fs.delete(place, True)
    if not fs.rename(aside, place):
        raise OSError(f"{path} could not be put in place; it is whole in {aside.toString()}")
    return True


def _line_files(df: DataFrame, folder: str) -> DataFrame:
    """Each row's line, and a ``path`` by its number among the sorted rows of its task.

    A task that is run again and gets its rows in another order so writes the same files.
    """
    rows = df.toDF("line").sortWithinPartitions("line")
    ending = f"-{uuid.uuid4()}.txt"
    path = F.concat(F.lit(f"{folder}/part-"), F.monotonically_increasing_id(), F.lit(ending))
    line = F.concat(F.coalesce("line", F.lit("")), F.lit("\n"))
    return rows.select(path.alias("path"), line.cast("binary").alias("data"))


def write_files(df: DataFrame, open_fs: OpenFs = open_by_uri) -> int:
    """Write each row's ``data`` to the file named by its ``path``, and return how many.

    Bytes go out within tasks as they are, under literal names; folders are made as needed. A
    file that is there is replaced, so a task that is run again does no harm.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: set[str] = set()
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, place = open_fs(path if re.match("[A-Za-z][A-Za-z0-9+.-]*:", path) else f"file:{path}")
                folder = place.rpartition("/")[0]
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                with fs.open_output_stream(place) as file:
                    file.write(data or b"")
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], names=["written"])

    rows = df.select("path", "data").mapInArrow(write, "written bigint")
    return rows.agg(F.coalesce(F.sum("written"), F.lit(0))).first()[0]


def replace_named(df: DataFrame, path: str, name: str, buckets: int = BUCKETS, **options: str) -> str:
    """Write rows as JSON below ``path``: those of names that are there are replaced, others stay.

    ``name`` holds one row per name. The folders are those of the first write, whatever ``buckets``
    says later: take as many as make a folder a few gigabytes, since a write reads and writes whole
    folders. A folder has as many files as its size asks for. When something is there, the new
    contents of all touched folders are written aside first and then put in place by one dynamic
    partition overwrite, so a write that fails before leaves all as it was. A dataset without such
    folders is taken over and laid out anew.
    """
    spark = df.sparkSession
    folders = _subfolders(spark, path)
    known = [m for f in folders or () if (m := re.fullmatch(r"bucket=\d+-of-(\d+)", f))]
    if known:
        buckets = int(known[0][1])
    number = F.pmod(F.xxhash64(name), F.lit(buckets)).cast("string")
    bucket = F.concat(number, F.lit(f"-of-{buckets}")).alias("bucket")
    new = df.select("*", bucket)
    if folders is None:
        _write_buckets(new, path, "static", options)
        return path
    aside = shared_dir(spark, "named")
    new = stored(new, f"{aside}/new")
    reader = spark.read.option("mode", "FAILFAST").option("maxStringLen", str((1 << 31) - 1))
    if known:
        touched = [row.bucket for row in new.select("bucket").distinct().collect()]  # ``buckets`` at most
        old = reader.schema(new.schema).json(path).where(F.col("bucket").isin(touched))
    else:
        old = reader.schema(df.schema).json(path).select("*", bucket)
    names = new.select(F.col(name).alias("_new"))
    old = old.join(names, F.col(name).eqNullSafe(F.col("_new")), "left_anti")
    merged = stored(old.unionByName(new), f"{aside}/merged")
    _write_buckets(merged, path, "dynamic" if known else "static", options)
    remove_folder(spark, aside)
    return path


def _write_buckets(df: DataFrame, path: str, how: str, options: dict[str, str]) -> None:
    """One JSON folder per bucket; Spark joins small ones in a task and splits large ones."""
    writer = df.hint("rebalance", "bucket").write.partitionBy("bucket").mode("overwrite")
    writer.option("partitionOverwriteMode", how).options(**options).json(path)


def _subfolders(spark: SparkSession, path: str) -> list[str] | None:
    """Names in a folder, of which a dataset has as many as buckets; None if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    return [entry.getPath().getName() for entry in fs.listStatus(folder)]


def write_extracted(
    df: DataFrame, path: str, order: str = "path", *, keep_others: bool = True, **options: str
) -> str:
    """Write extracted documents, the last by ``order`` for each stem.

    Documents of other stems that are there stay, unless ``keep_others`` is off.
    """
    named = df.withColumn("stem", file_stem(F.col("filename")))
    last = keep_last(named, "stem", order).select("stem", "filename", "content", "extraction_date")
    if keep_others:
        return replace_named(last, path, "stem", **options)
    return write_dataset(last, path, "json", **options)


def write_structured(
    df: DataFrame, path: str, order: str = "path", *, keep_others: bool = True, **options: str
) -> str:
    """Write the answers alone, each named ``{stem}_structured``, the last for each name.

    Answers of other names that are there stay, unless ``keep_others`` is off.
    """
    named = df.select(
        F.concat(file_stem(F.col("filename")), F.lit("_structured")).alias("name"),
        F.col("answer").alias("json_data"),
        F.col(order).alias("_order"),
    )
    last = keep_last(named, "name", "_order").select("name", "json_data")
    if keep_others:
        return replace_named(last, path, "name", **options)
    return write_dataset(last, path, "json", **options)

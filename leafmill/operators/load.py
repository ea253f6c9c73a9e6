"""Stage 3: structured answers to a table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from leafmill.functions.answers import json_field, metadata_json, string_field
from leafmill.functions.text import iso_text
from leafmill.operators.shaping import stored
from leafmill.schemas import ANSWER, TABLE_COLUMNS, TABLE_NAME, spark_type
from leafmill.settings import remove_folder, shared_dir


def flatten_record(
    df: DataFrame,
    key: str = "filename",
    answer: str = "answer",
    schema: T.StructType = ANSWER,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One flat record per answer: ``document_id``, ``filename``, then the schema's fields.

    Text fields are '' when missing and NULL when null; all others are JSON text, '[]'
    when missing and 'null' when null.
    """
    value = F.col(answer)
    columns = [
        (string_field if isinstance(f.dataType, T.StringType) else json_field)(value, f.name)
        .alias(f.name)
        for f in schema.fields
    ]
    return df.select(
        F.col(key).alias("document_id"), F.col(key).alias("filename"), *columns, *carry
    )


def with_metadata(
    df: DataFrame,
    extraction_date: str = "extraction_date",
    processed_at: Column | None = None,
) -> DataFrame:
    """Add ``metadata``, JSON text holding the extraction and processing dates."""
    found = F.col(extraction_date) if extraction_date in df.columns else F.lit(None)
    moment = F.current_timestamp() if processed_at is None else processed_at
    return df.withColumn("metadata", metadata_json(found.cast("string"), iso_text(moment)))


def align_to_schema(
    df: DataFrame, mapping: Mapping[str, str | T.DataType] = TABLE_COLUMNS, *, strict: bool = True
) -> DataFrame:
    """Exactly the mapping's columns, in its order: missing ones NULL, surplus ones dropped.

    Types are column type names or Spark's own types. A value that does not convert stops the load, unless ``strict`` is off: it is then NULL.
    """
    nested = (T.ArrayType, T.StructType, T.MapType, T.VariantType)
    columns = []
    for name, declared in mapping.items():
        dtype = spark_type(declared) if isinstance(declared, str) else declared
        is_text = dtype == T.StringType() or (isinstance(dtype, str) and dtype.upper() == "STRING")
        if name not in df.columns:
            value = F.lit(None).cast(dtype)
        else:
            value = F.col(f"`{name}`")
            if is_text and isinstance(df.schema[name].dataType, nested):
                value = F.to_json(value)
            value = value.cast(dtype) if strict else value.try_cast(dtype)
        columns.append(value.alias(name))
    return df.select(*columns)


def _qualified(spark: SparkSession, name: str) -> str:
    """Quoted name with its schema, so that a temporary view of that name is not meant."""
    parts = name.split(".")
    if len(parts) == 1:
        parts = [spark.catalog.currentDatabase(), *parts]
    return ".".join(_quoted(part) for part in parts)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _create(spark: SparkSession, target: str, mapping: Mapping[str, str], folder: str | None) -> None:
    """A new table; its rows are what the folder, if one is given, holds."""
    columns = ", ".join(f"{_quoted(name)} {spark_type(kind)}" for name, kind in mapping.items())
    place = ""
    if folder:
        escaped = folder.replace("\\", "\\\\").replace("'", "\\'")
        place = f" LOCATION '{escaped}'"
    spark.sql(f"CREATE TABLE {target} ({columns}) USING parquet{place}")


def _swap(spark: SparkSession, staging: str, name: str) -> None:
    """Put a finished table in the place of another."""
    target = _qualified(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.sql(f"ALTER TABLE {_qualified(spark, staging)} RENAME TO {target}")


def recreate_table(
    spark: SparkSession,
    name: str = TABLE_NAME,
    mapping: Mapping[str, str] = TABLE_COLUMNS,
    location: str | None = None,
) -> None:
    """Drop a table if it is there and create it anew, without rows, from a column map.

    Below ``location`` the table gets a folder of its own, new each time. The new table is
    made first, so where that fails the old one is still there.
    """
    run = uuid.uuid4().hex
    staging = f"{name}_load_{run}"
    folder = f"{location.rstrip('/')}/load-{run}" if location else None
    _create(spark, _qualified(spark, staging), mapping, folder)
    _swap(spark, staging, name)


def append_records(df: DataFrame, name: str = TABLE_NAME) -> int:
    """Append records to a table by column name and return how many.

    Columns the records lack become NULL, surplus ones are left out. The records are written once,
    into a hidden folder inside the table's own, and counted there by their file footers: the
    number is theirs alone whatever else writes, and the cost does not grow with the table. Then
    the finished files are moved into the table, which changes names only; if that fails, those
    moved go back. Tables of another format, or with partitions, get the counted records inserted.
    """
    spark = df.sparkSession
    target = _qualified(spark, name)
    schema = spark.table(target).schema
    records = align_to_schema(df, {field.name: field.dataType for field in schema.fields})
    place = _plain_folder(spark, target)
    if place is None:
        batch = shared_dir(spark, "append")
        held = stored(records, batch)
        rows = held.count()
        held.write.insertInto(target)
        remove_folder(spark, batch)
        return rows
    batch = f"{place.rstrip('/')}/_append-{uuid.uuid4().hex}"
    try:
        records.write.parquet(batch)
        rows = spark.read.schema(schema).parquet(batch).count()
        _move_files(spark, batch, place)
    finally:
        remove_folder(spark, batch)
    spark.catalog.refreshTable(target)
    return rows


def _plain_folder(spark: SparkSession, target: str) -> str | None:
    """Where a parquet table without partitions has its files; None for any other table."""
    told = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect()}
    if "# Partition Information" in told or told.get("Provider", "").lower() != "parquet":
        return None
    return told.get("Location")


def _move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move a finished batch's files, as many as it had tasks, into a folder of the same store."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder = path(source)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    moved = []
    try:
        for entry in fs.listStatus(folder):
            file = entry.getPath()
            if not file.getName().startswith("part-"):
                continue
            place = path(path(target), file.getName())
            if not fs.rename(file, place):
                raise OSError(f"cannot move {file} to {place}")
            moved.append((file, place))
    except Exception:
        for file, place in moved:
            fs.rename(place, file)
        raise


def load_table(
    df: DataFrame,
    name: str = TABLE_NAME,
    mapping: Mapping[str, str] = TABLE_COLUMNS,
    location: str | None = None,
) -> dict[str, object]:
    """Replace a table's contents and columns by the given records.

    The records are written in full first; only then is the table swapped, so a record
    that cannot be loaded leaves the old table as it was. Below ``location`` each load
    gets its own folder and the swap moves no data. Without one the table is managed by
    Spark and the swap renames it; that wants a catalog that outlives the session, or the
    folder a former session left stands in the way. Returns the rows inserted and the
    table's name.
    """
    spark = df.sparkSession
    records = align_to_schema(df, mapping)
    run = uuid.uuid4().hex
    staging = f"{name}_load_{run}"
    target = _qualified(spark, staging)
    if location:
        folder = f"{location.rstrip('/')}/load-{run}"
        records.write.parquet(folder)
        _create(spark, target, mapping, folder)
    else:
        _create(spark, target, mapping, None)
        try:
            records.write.insertInto(target)
        except Exception:
            spark.sql(f"DROP TABLE {target}")
            raise
    rows = spark.table(target).count()
    _swap(spark, staging, name)
    return {"rows_inserted": rows, "table_name": name}

"""JSON documents: one object per file, one per line, or many pretty-printed ones in a file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from leafmill.functions.answers import marked_json, object_json
from leafmill.operators.shaping import once
from leafmill.settings import DUPLICATE_KEYS

ANY_COLUMN = "document"


def read_json_documents(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    *,
    one_per_file: bool = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Read JSON objects with a declared schema, never an inferred one.

    Without a schema every object becomes one VARIANT column, ``document``.
    ``one_per_file`` reads pretty-printed files; switch it off for JSON Lines, which
    Spark can split. Broken JSON stops the read unless ``mode`` says otherwise.
    """
    reader = (
        spark.read.option("multiLine", one_per_file)
        .option("mode", mode)
        .option("recursiveFileLookup", "true")
        # The largest that a value can be, so that any document written can be read.
        .option("maxStringLen", str((1 << 31) - 1))
    )
    if schema is None:
        reader = reader.option("singleVariantColumn", ANY_COLUMN)
    else:
        reader = reader.schema(schema)
    return reader.json(path)


def read_json_objects(spark: SparkSession, path: str, *, indent: str = "") -> DataFrame:
    """Pretty-printed objects, any number to a file, one row each: ``(document, error)``.

    The objects may follow one another or be the items of one list, and stand at ``indent`` (two
    blanks, say, in a list). A line that is the indent and a closing brace ends an object, as line
    ends within JSON strings are always escaped; so Spark splits a large file by these lines and
    reads it in many tasks. A file that holds one object in one line is read too. What is between
    and is no object has no document but an ``error`` and its ``text``. Of a repeated key the last
    value counts.
    """
    spark.conf.set(DUPLICATE_KEYS, "true")
    close = f"\n{indent}}}"
    pieces = (
        spark.read.option("lineSep", close)
        .option("recursiveFileLookup", "true")
        .text(path)
        .select(F.regexp_replace("value", r"\A[\s,\[\]]+", "").alias("piece"))
        .where("piece <> ''")
    )
    whole = F.concat("piece", F.lit(close))
    marked = once(pieces, _whole=marked_json(whole))
    # A piece at the end of a file has no closing line: it is whole as it stands, or nothing is.
    rest = F.regexp_replace("piece", r"[\s,\]]+\z", "")
    found = F.coalesce(object_json(whole, F.col("_whole")), object_json(rest, marked_json(rest)))
    return once(marked, document=found).select(
        "document",
        F.when(F.col("document").isNull(), F.lit("not a JSON object")).alias("error"),
        F.when(F.col("document").isNull(), F.col("piece")).alias("text"),
    )

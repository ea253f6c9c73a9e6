"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leafmill.settings import remove_folder, shared_dir


# Rows that go to a Python worker at a time: whole documents, so fewer than Spark's default.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
DEFAULT_ROWS = 10_000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's batch size for Python workers where it is still the default."""
    if int(spark.conf.get(BATCH_SETTING)) == DEFAULT_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


_collected: list[list[Workspace]] = []


@contextmanager
def scratch() -> Iterator[None]:
    """Delete, at its end, the tables of all operators that are called within.

    For results that are written within, as nothing reads those tables then.
    """
    made: list[Workspace] = []
    _collected.append(made)
    try:
        yield
    finally:
        _collected.remove(made)
        for work in made:
            remove_folder(work.spark, work.path)


class Workspace:
    """Tables that one operator writes on its way; each is written once and read back.

    Written tables cut the lineage: a lost executor repeats tasks of one stage only. They
    live under ``spark.checkpoint.dir``.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        small_batches(spark)
        self.spark = spark
        self.path = shared_dir(spark, purpose)
        self.count = 0
        if _collected:
            _collected[-1].append(self)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as a table and return what reads it."""
        self.count += 1
        path = f"{self.path}/{self.count}-{name}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._workspace_path = path
        return back

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for table in tables:
            remove_folder(self.spark, table._workspace_path)


def fresh(name: str, columns: list[str]) -> str:
    """A column name that none of ``columns`` has, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: Column) -> Column:
    """16 bytes that name a text; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def row_key(row_id: Column, text: Column) -> Column:
    """16 bytes that name an id together with a text; null ids are alike."""
    named = F.coalesce(F.concat(F.lit("="), row_id.cast("string")), F.lit("-"))
    return F.unhex(F.md5(F.concat(named, F.lit("\n"), F.coalesce(text, F.lit("")))))

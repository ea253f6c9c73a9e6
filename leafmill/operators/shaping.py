"""Helpers about where and when work happens, not what is computed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a frame and read it back, which cuts its lineage and settles its size."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add (or replace) columns that are costly and used several times later.

    Catalyst merges neighbouring projections and moves filters below them, which copies
    an expression into every place that mentions its column. Handing the values out of
    a one-item list puts a generator in between, so each is computed once per row, still
    in compiled code and without a shuffle.
    """
    kept = [name for name in df.columns if name not in columns]
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(values))).select(
        *df.columns, *[name for name in columns if name not in df.columns]
    )


def plain_text(value: str) -> str:
    """The text itself; raises for what cannot be stored as UTF-8 (a lone surrogate)."""
    value.encode("utf-8")
    return value


def error_text(problem: Exception) -> str:
    """What went wrong, as text that can be stored."""
    text = f"{type(problem).__name__}: {problem}"
    return text.encode("utf-8", "backslashreplace").decode("utf-8")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Redistribute a scan that has fewer splits than the cluster has cores.

    For costly work per row on a small input (few files, or files Spark cannot split).
    Larger inputs come back as they are, without a shuffle. ``df`` should be read
    straight from storage and ``key`` unique, so that the spread is even.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)

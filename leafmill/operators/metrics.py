"""Counts and rates of each stage.

They are computed from stored results, in one row each. The names of the files found
are as many as the files, so they are a frame of their own, ``file_outcomes``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from leafmill.functions.text import percent_text


def extraction_metrics(df: DataFrame) -> DataFrame:
    """Stage 1, from rows with an ``error`` column: one row.

    ``(files_processed, total_files, failed_files, success_rate)``; the rate is NULL
    when there are no files.
    """
    good = F.count_if(F.col("error").isNull())
    return df.agg(
        good.alias("files_processed"),
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("error").isNotNull()).alias("failed_files"),
        percent_text(good, F.count(F.lit(1))).alias("success_rate"),
    )


def file_outcomes(df: DataFrame, name: str = "filename") -> DataFrame:
    """Every file found with its outcome: ``(name, processed, error)``."""
    return df.select(name, F.col("error").isNull().alias("processed"), "error")


def structured_metrics(inp: DataFrame, out: DataFrame) -> DataFrame:
    """Stage 2, from the documents going in and the answers kept: one row.

    ``(documents_processed, success_rate)``. Answers are counted after ``keep_last``,
    documents before it, so files sharing a name lower the rate. Without documents the
    rate is '0%'.
    """
    sides = inp.select(F.lit(1).alias("n_in"), F.lit(0).alias("n_out")).unionAll(
        out.select(F.lit(0).alias("n_in"), F.lit(1).alias("n_out"))
    )
    total, kept = F.coalesce(F.sum("n_in"), F.lit(0)), F.coalesce(F.sum("n_out"), F.lit(0))
    return sides.agg(
        kept.alias("documents_processed"),
        F.coalesce(percent_text(kept, total), F.lit("0%")).alias("success_rate"),
    )


def load_metrics(df: DataFrame, table_name: str) -> DataFrame:
    """Stage 3, from the loaded table: one row ``(rows_inserted, table_name)``."""
    return df.agg(F.count(F.lit(1)).alias("rows_inserted"), F.lit(table_name).alias("table_name"))

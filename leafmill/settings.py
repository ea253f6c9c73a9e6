"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

# With it, a repeated key in an answer keeps its last value; ``parse_responses`` sets it.
DUPLICATE_KEYS = "spark.sql.variant.allowDuplicateKeys"

# What a session running the whole pipeline should set. None of them is needed
# for right results.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    DUPLICATE_KEYS: "true",
    # Rows handed to the Python hooks can hold whole files: keep batches small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
}


# Size that a shuffle partition should have; Spark merges smaller ones at run time but
# does not split larger ones, except in skewed joins.
SHUFFLE_PARTITION_BYTES = 256 << 20


def configure(
    spark: SparkSession,
    overrides: Mapping[str, str] | None = None,
    *,
    input_bytes: int | None = None,
) -> SparkSession:
    """Apply ``RECOMMENDED`` to a session, then any overrides.

    ``input_bytes`` is the size of the data to be shuffled, for the number of shuffle
    partitions: the default of 200 would make them half a terabyte each at 100 TB.
    """
    settings = dict(RECOMMENDED)
    if input_bytes is not None:
        partitions = max(
            spark.sparkContext.defaultParallelism, -(-input_bytes // SHUFFLE_PARTITION_BYTES)
        )
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(partitions)
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    for key, value in {**settings, **(overrides or {})}.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """Path of a new folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``. A local session without that setting
    (as in tests) gets a temporary folder; a cluster session must have it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="leafmill-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more, wherever Spark keeps it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

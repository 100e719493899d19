"""Session settings the jobs are written for, and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # All timestamps are zone-less; text with a zone is read as UTC.
    "spark.sql.session.timeZone": "UTC",
    # Re-planning at run time: partition counts, broadcast by measured size, skewed joins.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs another shuffle further on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


#: Of Parquet that jobs write: about two thirds of the bytes of Spark's own choice, for little more time.
CODEC = "zstd"


def apply_settings(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


#: Arrow batches end at so many bytes; a longer row is a batch of its own. Each task holds its batch several times outside the
#: heap, in buffers that double as they grow, and Spark's own limit is 64 MB.
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES, SPARKS_OWN = 7 << 20, f"{64 << 20}b"


def bound_batches(spark: SparkSession) -> None:
    """Let batches for Python workers end at BATCH_BYTES from now on, unless the session has a limit of its own.

    Frames are run after the call that made them, so the session keeps the limit; no result depends on it."""
    if spark.conf.get(BATCH_LIMIT) == SPARKS_OWN:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))


def scratch_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``, shared by all executors. A temporary folder
    stands in only where it is unset and Spark runs in local mode."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint folder and go on from there.

    Later steps read only the columns they need, know the real size of what they join, and
    survive the loss of executors without computing ``df`` again.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/dimflow-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=CODEC)
    return spark.read.schema(df.schema).parquet(path)

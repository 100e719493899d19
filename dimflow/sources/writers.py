"""Writes that can be repeated: a run only ever replaces its own output."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.session import CODEC
from dimflow.sources.readers import or_empty

RUN = "run_id"

#: Folders that a task writes at once; of more, it sorts the rest of its rows by folder.
OPEN_FOLDERS = 8
_OPEN = "spark.sql.maxConcurrentOutputFileWriters"


def write_snapshot(df: DataFrame, path: str) -> None:
    """Replace the whole folder. ``df`` must not read from it."""
    df.write.mode("overwrite").parquet(path, compression=CODEC)


def write_run(df: DataFrame, path: str, run: str, by: Sequence[str] = (), spread: bool = True) -> None:
    """Add the rows of one run to an append-only table, replacing an earlier try of the run.

    With ``by`` the rows are first spread so that each folder gets files of a good size, a
    folder with a large share of the rows being split over several tasks. Without ``spread``
    each task writes into all folders, which saves a shuffle where these are few.
    """
    if by and spread:
        df = df.hint("rebalance", *by)
    with open_folders(df.sparkSession):
        df.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/{RUN}={run}", compression=CODEC)


@contextmanager
def open_folders(spark: SparkSession) -> Iterator[None]:
    """For writes into folders: a task has a file open in each of up to ``OPEN_FOLDERS``.

    Spark would else sort all rows of a task by folder. Stored rows are packed so well that a split or a part of a
    shuffle holds millions of them, and such sorts spill."""
    before = spark.conf.get(_OPEN, None)
    spark.conf.set(_OPEN, str(OPEN_FOLDERS))
    try:
        yield
    finally:
        spark.conf.unset(_OPEN) if before is None else spark.conf.set(_OPEN, before)


def read_runs(
    spark: SparkSession, path: str, schema: T.StructType, required: bool = False
) -> DataFrame:
    """All runs of a table, with ``run_id`` (and other folder columns) as columns.

    A ``required`` table whose folder is gone is an error at once, not an empty table.
    """
    full = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
    read = spark.read.schema(full).parquet
    return read(path) if required else or_empty(lambda: read(path), spark, full)


def write_lines(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Text lines into folders; only folders that occur in ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).text(
        path
    )


def publish(spark: SparkSession, path: str, run: str) -> None:
    """Mark a run as complete. Called last: readers ignore runs that are not marked."""
    spark.createDataFrame([(run,)], f"{RUN} string").coalesce(1).write.mode("append").parquet(path)


def published_before(spark: SparkSession, path: str, run: str | None = None) -> list[str]:
    """Complete runs in order, those before ``run`` only when given: one short text per run."""
    marks = or_empty(lambda: spark.read.parquet(path), spark, f"{RUN} string").distinct()
    if run is not None:
        marks = marks.filter(F.col(RUN) < run)
    return sorted(row[RUN] for row in marks.collect())

"""Surrogate keys given so far, kept apart from the tables that hold them.

``last`` has one row a run, the largest key after it; ``keys`` has each natural key once, in the run that numbered it.
So a run learns where to go on from one row, and which keys exist from the buckets its own rows fall in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.sources.buckets import read_touched, write_bucketed
from dimflow.sources.writers import RUN, read_runs, write_run

_LAST = T.StructType([T.StructField("last_key", T.LongType())])


def last_key(spark: SparkSession, path: str, runs: list[str]) -> int:
    """The largest key after the last of ``runs``; 0 before the first run."""
    if not runs:
        return 0
    marks = read_runs(spark, f"{path}/last", _LAST, required=True)
    row = marks.filter(F.col(RUN) == runs[-1]).first()
    if row is None:
        raise ValueError(f"{path} has no last key for run {runs[-1]}")
    return row["last_key"]


def set_last_key(spark: SparkSession, path: str, run: str, keys: DataFrame, before: int) -> None:
    """Note the largest key after a run. ``keys`` has one column, the keys that the run gave."""
    largest = F.greatest(F.max(keys.columns[0]), F.lit(before)).cast("bigint")
    write_run(keys.agg(largest.alias("last_key")), f"{path}/last", run)


def known_keys(
    spark: SparkSession, path: str, natural: str, key: str, runs: list[str], rows: DataFrame
) -> DataFrame:
    """``natural, key`` of everything numbered by ``runs`` that may occur in ``rows``."""
    fields = [rows.schema[natural], T.StructField(key, T.LongType())]
    return read_touched(spark, f"{path}/keys", fields, runs, [natural], rows)


def register(
    spark: SparkSession, path: str, run: str, numbered: DataFrame, natural: str, key: str, before: int
) -> None:
    """Add the keys above ``before`` of a run's rows; the others are registered already."""
    new = numbered.filter(F.col(key) > before).select(natural, key)
    write_bucketed(new, f"{path}/keys", run, [natural])
    set_last_key(spark, path, run, new.select(key), before)

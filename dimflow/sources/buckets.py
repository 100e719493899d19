"""Append-only tables whose rows lie in folders by run and by hash of their key.

Who looks for some keys reads the folders those keys fall in and no others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.sources.writers import RUN, read_runs, write_run

BUCKET = "bucket"
BUCKETS = 64


def bucket_of(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def write_bucketed(df: DataFrame, path: str, run: str, keys: Sequence[str]) -> None:
    write_run(df.withColumn(BUCKET, bucket_of(keys)), path, run, [BUCKET])


def read_touched(
    spark: SparkSession,
    path: str,
    fields: Sequence[T.StructField],
    runs: Sequence[str],
    keys: Sequence[str],
    wanted: DataFrame,
) -> DataFrame:
    """Rows of ``runs`` in the buckets that the keys of ``wanted`` fall in. The list of these
    buckets is short, so the filter is on folder names and Spark lists no other files to read."""
    if not runs:
        return spark.createDataFrame([], T.StructType(list(fields)))
    touched = [r[0] for r in wanted.select(bucket_of(keys)).distinct().collect()]
    located = T.StructType([*fields, T.StructField(BUCKET, T.IntegerType())])
    rows = read_runs(spark, path, located, required=True)
    return rows.filter(F.col(RUN).isin(*runs) & F.col(BUCKET).isin(*touched)).drop(RUN, BUCKET)

"""Ranks over a whole frame without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimflow.session import cut_lineage


def ranked(df: DataFrame, measure: str, rank: str) -> DataFrame:
    """Add ``rank``: one more than the rows with a larger ``measure`` (NULLs come last, with one rank).

    Rows of one value have one rank, so only the distinct values are put in order: their counts are dealt
    to ranges of the value, summed up within each range, and what the ranges ahead hold is added, one
    number for each range. ``df`` is read twice: hand over a table rather than a long computation.
    """
    order = F.col(measure).desc_nulls_last()
    counts = df.groupBy(measure).agg(F.count(F.lit(1)).alias("_n"))
    # Written, since the number of a range has to stay the same for all that is read from it.
    counts = cut_lineage(counts.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("_part").agg(F.sum("_n").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead")
    )
    before = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    places = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(
        F.broadcast(parts), "_part"  # one row for each range
    )
    places = places.select(
        F.col(measure).alias("_value"), (1 + F.col("_ahead") + F.col("_before")).cast("bigint").alias(rank)
    )
    return df.join(places, F.col(measure).eqNullSafe(F.col("_value"))).drop("_value")

"""Surrogate keys, assigned in parallel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimflow.session import cut_lineage

# 16 ** 3 hash ranges. The only single-task step below is a prefix sum over this many rows.
HEX_DIGITS = 3


def assign_keys(
    rows: DataFrame,
    natural: Sequence[str],
    key: str,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Number ``rows`` upwards from the largest ``key`` in ``existing`` (or from 1).

    Rows are numbered by (hash range of the natural key, natural key). Natural keys are unique,
    so the ranges are even and no task sees more than its share; the order depends on nothing
    but the keys, so a task that runs again gives the same numbers. A range's offset is the
    number of rows in the ranges before it. ``rows`` is read twice, to count and to number:
    hand over a table rather than a long computation.
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in natural])
    ranged = rows.withColumn("_range", F.substring(F.md5(text), 1, HEX_DIGITS))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    if existing is not None:
        # '' sorts before every hash range: the keys in use come first.
        used = existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("_n"))
        sizes = sizes.unionByName(used.withColumn("_range", F.lit("")))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*natural))
    # At most 16 ** HEX_DIGITS + 1 offsets, so the broadcast is bounded.
    return (
        ranged.withColumn("_place", within)
        .join(F.broadcast(offsets), "_range")
        .withColumn(key, (F.col("_offset") + F.col("_place")).cast("bigint"))
        .drop("_range", "_offset", "_place")
    )


def stable_keys(
    rows: DataFrame,
    known: DataFrame,
    natural: Sequence[str],
    key: str,
    last: DataFrame | None = None,
) -> DataFrame:
    """Keep the key of every natural key in ``known``; number the others after them.

    ``known`` holds natural key and key of everything ever numbered, so a key is never given
    to a second natural key and a row that comes back gets its old one. With ``last``, a frame
    that holds the largest key, ``known`` may leave out what does not occur in ``rows``.
    """
    keys = known.groupBy(*natural).agg(F.min(key).alias(key))
    # Read three times below, so it is written once.
    matched = cut_lineage(rows.join(keys, list(natural), "left"))
    old = matched.filter(F.col(key).isNotNull())
    new = assign_keys(matched.filter(F.col(key).isNull()).drop(key), natural, key, known if last is None else last)
    return old.unionByName(new)

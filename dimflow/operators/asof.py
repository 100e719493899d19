"""As-of join by one sorted merge, linear however many rows a key has on either side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimflow.operators.scd2 import END, START
from dimflow.session import cut_lineage

_VERSION, _FACT = 0, 1


def as_of_join(
    facts: DataFrame, versions: DataFrame, key: str, at: str, attributes: Sequence[str]
) -> DataFrame:
    """Left join each fact to the last version of its key that starts at or before the fact's time,
    if that has not ended; the versions of a key must not overlap.

    Both sides go through one exchange into ranges of (key, time), so a key may fill any number of
    ranges. A fact takes the last version before it in its range. What the ranges before a range hold
    of its first key is one version, carried over from range to range: as many rows as there are ranges.
    No version is compared with a fact. Facts without key or time match nothing; of versions with one
    start the one that ends last counts.
    """
    timed = versions.filter(
        F.col(key).isNotNull() & F.col(START).isNotNull() & (F.col(END).isNull() | (F.col(END) > F.col(START)))
    )
    version = F.struct(F.col(END).alias("end"), *attributes)
    held = timed.select(
        F.col(key).alias("_key"), F.col(START).alias("_at"), F.lit(_VERSION).alias("_kind"), version.alias("_version"),
        F.lit(None).cast(facts.select(F.struct(*facts.columns)).schema[0].dataType).alias("_fact"),
    )
    matched = F.col(key).isNotNull() & F.col(at).isNotNull()
    asked = facts.filter(matched).select(
        F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(_FACT).alias("_kind"),
        F.lit(None).cast(held.schema["_version"].dataType).alias("_version"), F.struct(*facts.columns).alias("_fact"),
    )
    ranges = held.unionByName(asked).repartitionByRange("_key", "_at", "_kind")
    # Written, since the number of a range has to stay the same for all that is read from it.
    ranges = cut_lineage(ranges.withColumn("_range", F.spark_partition_id()))
    # A version without end sorts last among those that start together.
    order = [F.col("_at"), F.col("_kind"), F.col("_version.end").asc_nulls_last()]
    so_far = Window.partitionBy("_range", "_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    seen = ranges.withColumn("_last", F.last("_version", True).over(so_far)).filter(F.col("_kind") == _FACT)
    seen = seen.join(F.broadcast(carried(ranges)), ["_range", "_key"], "left")
    found = seen.select("_fact", "_at", F.coalesce("_last", "_carried").alias("_found"))
    valid = F.col("_found.end").isNull() | (F.col("_at") < F.col("_found.end"))
    told = found.select(
        "_fact.*", *[F.when(valid, F.col("_found")[name]).alias(name) for name in attributes]
    )
    alone = facts.filter(~matched).select(
        *facts.columns, *[F.lit(None).cast(versions.schema[name].dataType).alias(name) for name in attributes]
    )
    return told.unionByName(alone)


def carried(ranges: DataFrame) -> DataFrame:
    """``_range, _key, _carried``: the last version that earlier ranges hold of a range's first key.

    Only the last key of a range goes on in the next. Two rows for each range, of a few columns."""
    place = F.struct(F.col("_at"), F.col("_kind"), F.coalesce(F.unix_micros(F.col("_version.end").cast("timestamp")), F.lit((1 << 63) - 1)))
    last = F.max_by("_version", F.when(F.col("_kind") == _VERSION, place))
    edges = ranges.groupBy("_range", "_key").agg(last.alias("_edge"))
    keys = edges.groupBy("_range").agg(
        F.min("_key").alias("_first_key"), F.max("_key").alias("_last_key"), F.max_by("_edge", "_key").alias("_edge")
    )
    keys = cut_lineage(keys)
    nothing = F.lit(None).cast(ranges.schema["_version"].dataType)
    asks = keys.select(F.col("_first_key").alias("_key"), "_range", F.lit(0).alias("_turn"), nothing.alias("_edge"))
    gives = keys.select(F.col("_last_key").alias("_key"), "_range", F.lit(1).alias("_turn"), "_edge")
    before = Window.partitionBy("_key").orderBy("_range", "_turn").rowsBetween(Window.unboundedPreceding, -1)
    passed = asks.unionByName(gives).withColumn("_carried", F.last("_edge", True).over(before))
    return passed.filter("_turn = 0 AND _carried IS NOT NULL").select("_range", "_key", "_carried")

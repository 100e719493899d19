"""Keys that hold so many rows that one task should not take them whole.

A window over a key puts all its rows into one task. Here such keys are found first (one
aggregate over the key and time columns) and cut into slots of equal time; in the usual case
that there are none, plans stay as plain as without this module.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.session import cut_lineage

# A window group up to this size is left whole; a slot of a larger one aims at this size.
MANY_ROWS = 1_000_000

_KEY, _FIRST, _LAST, _SLOTS = "_heavy", "_first", "_last", "_slots"
WHOLE = -1


def seconds(at: Column) -> Column:
    """Whole seconds of a zone-less timestamp, independent of the session's time zone."""
    day = F.unix_date(at.cast("date")).cast("bigint")
    return day * 86400 + F.hour(at) * 3600 + F.minute(at) * 60 + F.floor(F.second(at))


def heavy_keys(
    df: DataFrame,
    key: str,
    at: str,
    more_than: int = MANY_ROWS,
    per_slot: int | None = None,
    **measures: Column,
) -> DataFrame | None:
    """Keys with more than ``more_than`` rows, their time range and number of slots; None when
    there are none. The usual case costs one count per key. Otherwise the keys are written, so
    that Spark knows the real size when it joins them."""
    timed = df.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
    largest = timed.groupBy(key).count().agg(F.max("count")).first()[0]
    if largest is None or largest <= more_than:
        return None
    counted = (
        timed.groupBy(F.col(key).alias(_KEY))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min(seconds(F.col(at))).alias(_FIRST),
            F.max(seconds(F.col(at))).alias(_LAST),
            *[column.alias(name) for name, column in measures.items()],
        )
        .filter(F.col("_n") > more_than)
    )
    slots = F.ceil(F.col("_n") / F.lit(per_slot or more_than)).cast("bigint")
    return cut_lineage(counted.withColumn(_SLOTS, slots).drop("_n"))


def with_heavy(df: DataFrame, key: Column, heavy: DataFrame) -> DataFrame:
    """Attach what is known about heavy keys, NULLs for the others."""
    return df.join(heavy, key == F.col(_KEY), "left")


def without_heavy(df: DataFrame, heavy: DataFrame) -> DataFrame:
    return df.drop(*heavy.columns)


def is_heavy() -> Column:
    return F.col(_KEY).isNotNull()


def slot_at(at: Column) -> Column:
    """Slot of a time within its key's range; times outside fall into the first or last one.

    Never decreases with time, which is all that the users below rely on.
    """
    span = F.greatest(F.col(_LAST) - F.col(_FIRST), F.lit(1))
    inside = F.least(F.greatest(seconds(at), F.col(_FIRST)), F.col(_LAST)) - F.col(_FIRST)
    return F.floor(inside * F.col(_SLOTS) / span).cast("int")


def with_neighbour(
    df: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    step: int,
    name: str,
    heavy: DataFrame | None,
) -> DataFrame:
    """Add ``name``: a struct of ``columns`` from the row before (``step=-1``) or after (``1``)
    in the order of ``at`` within the key; NULL where there is none.

    The rows of a heavy key are looked at slot by slot. What the neighbouring slots hold at
    their edges is one row per slot, passed on in a second, small window.
    """
    beside = F.lag if step < 0 else F.lead
    packed = F.struct(*columns)
    if heavy is None:
        return df.withColumn(name, beside(packed).over(Window.partitionBy(key).orderBy(at)))
    cut = without_heavy(
        with_heavy(df, F.col(key), heavy).withColumn(
            "_slot", F.when(is_heavy(), slot_at(F.col(at))).otherwise(WHOLE)
        ),
        heavy,
    )
    near = cut.withColumn(name, beside(packed).over(Window.partitionBy(key, "_slot").orderBy(at)))
    edge = F.max_by(packed, at) if step < 0 else F.min_by(packed, at)
    edges = (
        cut.filter(F.col("_slot") != WHOLE)
        .groupBy(key, "_slot")
        .agg(edge.alias("_edge"))
        .select(
            key, "_slot",
            beside("_edge").over(Window.partitionBy(key).orderBy("_slot")).alias("_passed"),
        )
    )
    return (
        near.join(edges, [key, "_slot"], "left")
        .withColumn(name, F.coalesce(name, "_passed"))
        .select(*df.columns, name)
    )

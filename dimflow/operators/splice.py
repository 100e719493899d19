"""Late batches in a type-2 history: only the keys they touch are looked at."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimflow.operators.heavy import MANY_ROWS
from dimflow.operators.scd2 import CURRENT, END, START, scd2_history


def scd2_splice(
    history: DataFrame,
    feed: DataFrame,
    late: DataFrame,
    key: str,
    at: str,
    tracked: Mapping[str, object],
    order: Sequence[str] = (),
    many_rows: int = MANY_ROWS,
) -> DataFrame:
    """The history as it would be if ``late`` had been in ``feed`` from the start.

    A late row may split the version it falls into, take over its start, or join it with a neighbour. What
    that comes to depends on few rows of a touched key: where its versions start, the late rows, and
    what the feed says next after each of them, which ends the late state even if it changed nothing before. The
    versions of these rows are the key's new ones; those of other keys stay as they are.

    ``history`` has the columns of ``feed`` with ``at`` as the start of the version, as ``scd2_history`` gives them.
    """
    late = late.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).select(*feed.columns)
    touched = late.select(key).distinct()
    known = feed.join(touched, key, "left_semi").filter(F.col(at).isNotNull())
    times = known.select(key, at, F.lit(False).alias("_late")).unionByName(late.select(key, at, F.lit(True).alias("_late")))
    times = times.groupBy(key, at).agg(F.max("_late").alias("_late"))
    after_late = F.coalesce(F.lag("_late").over(Window.partitionBy(key).orderBy(at)), F.lit(False))
    told = times.withColumn("_after", after_late).filter(F.col("_late") | F.col("_after")).select(key, at)
    starts = history.join(touched, key, "left_semi").withColumnRenamed(START, at).select(*feed.columns)
    rows = starts.unionByName(late).unionByName(known.join(told, [key, at], "left_semi"))
    spliced = scd2_history(rows.distinct(), key, at, tracked, order, many_rows)
    untouched = history.join(touched, key, "left_anti")
    columns = [c for c in history.columns if c not in (START, END, CURRENT)]
    return untouched.unionByName(spliced.select(*columns, START, END, CURRENT))

"""The activity fact in folders by run and event month, with an index of its event ids.

A run mostly brings events of a few days, so within a month's folder the times that Parquet keeps for each file tell
which runs' files hold a day. Folders by day would be 30 times as many for no more than that.

Most events that come again come with the time they had, so they are looked for in the months and between the times of
the batch first. Whether one of the rest is in the fact under another time is told by the index, of which only the
buckets of the rest are read; a batch that was loaded before leaves no rest and reads none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.operators.facts import not_loaded
from dimflow.schemas import layout
from dimflow.session import cut_lineage
from dimflow.sources.buckets import read_touched, write_bucketed
from dimflow.sources.writers import RUN, read_runs, write_run

MONTH = "event_month"
AT = "event_timestamp"
#: Longest list of months in a filter; beyond it only the range of times is tested, which keeps no less.
LISTED_MONTHS = 1000

_ID = T.StructField("event_id", T.StringType())


def month_of(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM")


def read_facts(spark: SparkSession, path: str, runs: list[str], on: Column | None = None) -> DataFrame:
    """Facts of ``runs`` with their ``event_month``. ``on`` is a condition on it; folders that fail it are not read."""
    fields = T.StructType([*layout("fact_activity").fields, T.StructField(MONTH, T.StringType())])
    rows = read_runs(spark, f"{path}/facts", fields, required=bool(runs)).filter(F.col(RUN).isin(*runs))
    return (rows if on is None else rows.filter(on)).drop(RUN)


def times_of(rows: DataFrame) -> Column:
    """Condition that holds for facts of the months, and between the first and last time, of ``rows``; and for those
    without a time if ``rows`` has any."""
    months = rows.select(month_of(F.col(AT))).distinct().limit(LISTED_MONTHS + 1).collect()
    listed = [r[0] for r in months if r[0] is not None]
    many = len(months) > LISTED_MONTHS
    undated = F.col(MONTH).isNull() if many or len(listed) < len(months) else F.lit(False)
    if not listed:
        return undated
    ends = rows.select(F.min(AT).cast("string"), F.max(AT).cast("string")).first()
    within = F.col(AT).between(*[F.lit(end).cast("timestamp_ntz") for end in ends])
    month = F.col(MONTH).isNotNull() if many else F.col(MONTH).isin(*listed)
    return (month | undated) & (within | F.col(AT).isNull())


def not_in_fact(spark: SparkSession, path: str, staged: DataFrame, runs: list[str]) -> DataFrame:
    """Staged rows whose event id no fact of ``runs`` has; rows without an id always pass."""
    if not runs:
        return staged
    near = read_facts(spark, path, runs, times_of(staged))
    # Ids alone tell whether anything is left and in which buckets; whole rows are dealt by id once, for both tests.
    rest = cut_lineage(not_loaded(staged.select("event_id"), near))
    if rest.isEmpty():
        return staged.limit(0)
    named = rest.filter("event_id IS NOT NULL")
    known = read_touched(spark, f"{path}/ids", [_ID], runs, ["event_id"], named)
    return cut_lineage(not_loaded(not_loaded(staged, near), known))


def append_facts(spark: SparkSession, path: str, facts: DataFrame, run: str) -> None:
    """Write a run's facts by month, then the index of their ids from what was written."""
    write_run(facts.withColumn(MONTH, month_of(F.col(AT))), f"{path}/facts", run, [MONTH])
    ids = read_facts(spark, path, [run]).select("event_id").filter("event_id IS NOT NULL")
    write_bucketed(ids, f"{path}/ids", run, ["event_id"])

"""Events per customer and month, kept up to date run by run.

The table holds a folder for each run and month: the counts of all the month's events as of that run. A run adds its
new facts to the months they fall in and writes those months anew; other months stay where they are. A small table
of ``(month, run_id)`` says which run has a month's latest counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.plans.reports import behavior_change, monthly_counts
from dimflow.sources.readers import read_parquet
from dimflow.sources.writers import RUN, publish, published_before, read_runs, write_run

_MARKS = T.StructType([T.StructField("month", T.TimestampNTZType())])


def _counts_of(spark: SparkSession, path: str, key: T.StructField) -> DataFrame:
    fields = [key, T.StructField("events", T.LongType()), T.StructField("month_of", T.StringType())]
    return read_runs(spark, f"{path}/counts", T.StructType(fields))


def _held(spark: SparkSession, path: str, runs: list[str]) -> dict[str, str]:
    """Month to the run that counted it last: as many entries as there are months."""
    marks = read_runs(spark, f"{path}/months", _MARKS).filter(F.col(RUN).isin(*runs))
    last = marks.groupBy(F.date_format("month", "yyyy-MM").alias("month_of")).agg(F.max(RUN).alias(RUN))
    return {r.month_of: r[RUN] for r in last.collect()}


def _current(spark: SparkSession, path: str, key: T.StructField, held: dict[str, str]) -> DataFrame:
    """Counts of the months in ``held``; only their folders are read."""
    chosen = F.lit(False)
    for run in sorted(set(held.values())):
        chosen = chosen | ((F.col(RUN) == run) & F.col("month_of").isin(*[m for m, r in held.items() if r == run]))
    counts = _counts_of(spark, path, key).filter(chosen)
    month = F.to_timestamp_ntz(F.concat("month_of", F.lit("-01 00:00:00")))
    return counts.select(key.name, month.alias("month"), "events")


def add_events(spark: SparkSession, path: str, run: str, facts: DataFrame) -> list[str]:
    """Count a run's new facts (``customer_id, event_timestamp``); returns the months it wrote.

    A run may be repeated, as long as no later one was added. Facts without a time are in no month.
    """
    new = monthly_counts(facts)
    key = new.schema["customer_id"]
    held = _held(spark, path, published_before(spark, f"{path}/runs", run))
    touched = {r.m for r in new.select(F.date_format("month", "yyyy-MM").alias("m")).distinct().collect()}
    before = _current(spark, path, key, {m: r for m, r in held.items() if m in touched})
    both = before.unionByName(new).groupBy("customer_id", "month").agg(F.sum("events").alias("events"))
    counts = both.select("customer_id", "events", F.date_format("month", "yyyy-MM").alias("month_of"))
    write_run(counts, f"{path}/counts", run, ["month_of"])
    month = F.to_timestamp_ntz(F.concat("value", F.lit("-01 00:00:00")))
    months = spark.createDataFrame([(m,) for m in sorted(touched)], "value string").select(month.alias("month"))
    write_run(months, f"{path}/months", run)
    publish(spark, f"{path}/runs", run)
    return sorted(touched)


def monthly_report(spark: SparkSession, path: str, key_type: T.DataType) -> DataFrame:
    """``behavior_by_month`` over all events of complete runs, from their counts."""
    held = _held(spark, path, published_before(spark, f"{path}/runs"))
    return behavior_change(_current(spark, path, T.StructField("customer_id", key_type), held))

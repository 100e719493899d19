"""Clean to staging: latest customers with plan attributes, unique activity, latest plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.functions.values import run_id, stamp
from dimflow.operators.enrich import with_current_plan, with_plan_attributes
from dimflow.operators.latest import keep_latest_of_runs
from dimflow.operators.metrics import row_counts, summary_json
from dimflow.plans.standardize import read_clean
from dimflow.schemas import DATASETS
from dimflow.sources.writers import RUN, write_snapshot

NEWEST = ["ingestion_ts", "archive_date"]
# A run keeps one row of a key, and runs differ in their stamp: these two decide nothing more.
_NOT_ASKED = ("copies", RUN)


def _latest(clean: DataFrame, key: str) -> DataFrame:
    return keep_latest_of_runs(clean, key, RUN, NEWEST).drop(*_NOT_ASKED)


def build_staging(
    spark: SparkSession,
    root: str,
    run_ts: dt.datetime | str,
    activity_from: dt.date | None = None,
) -> DataFrame:
    """Overwrite the three staging snapshots; returns their row counts.

    Latest rows are picked before the joins, so the joined sides hold one row per key.
    ``activity_from`` leaves out activity of older archive dates, whose folders are not read:
    the fact load is idempotent, so loaded activity need not be staged again.
    """
    clean = {name: read_clean(spark, root, name) for name in DATASETS}
    staged = {name: f"{root}/staging/{name}" for name in ("customers", "activity", "plans")}

    plans = _latest(clean["plans"], "plan_id")
    write_snapshot(plans.drop("archive_date"), staged["plans"])

    customers = _latest(clean["customers"], "customer_id")
    write_snapshot(
        with_plan_attributes(customers, spark.read.parquet(staged["plans"])), staged["customers"]
    )

    activity = clean["activity_logs"]
    if activity_from is not None:
        activity = activity.filter(F.col("archive_date") >= F.lit(activity_from))
    unique = _latest(activity, "event_id").drop("archive_date")
    write_snapshot(
        with_current_plan(unique, spark.read.parquet(staged["customers"])), staged["activity"]
    )

    counts = row_counts({name: spark.read.parquet(path) for name, path in staged.items()})
    summary_json(counts, "build_staging", stamp(run_ts)).write.mode("overwrite").text(
        f"{root}/metrics/build_staging/run_id={run_id(run_ts)}"
    )
    return counts

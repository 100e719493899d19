"""The test tables as archived files, so that whole runs can be checked against plain SQL."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.plans import fixtures as fx
from dimflow.plans.staging import build_staging
from dimflow.plans.standardize import standardize
from dimflow.plans.warehouse import run_warehouse
from dimflow.schemas import layout
from dimflow.session import scratch_folder
from dimflow.sources.writers import open_folders

# Two deliveries: everything before the first day, then everything before the second, which is
# after the last row of the tables.
DAYS = ("1999-01-01", "2002-01-01")
#: Runs after the deliveries, without news.
QUIET = ("2002-01-02 00:00:00", "2002-01-03 00:00:00")


def new_root(spark: SparkSession) -> str:
    return f"{scratch_folder(spark)}/dimflow-root-{uuid.uuid4().hex}"


def _customers(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    """State of each customer on that day; some records lack their key."""
    feed = fx.order_feed(spark, sf_dir).filter(F.col("ingestion_ts") < F.lit(day).cast("timestamp_ntz"))
    key = F.col("customer_id").cast("string")
    return fx.latest_orders(feed).select(
        F.when(F.col("customer_id") % 19 != 0, key).alias("customer_id"),
        F.concat(F.lit("C"), key).alias("first_name"),
        "plan_id",
        "status",
        F.col("ingestion_ts").cast("string").alias("registration_date"),
    )


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each delivery, named by ``ingest_date``, all activity before its day, so the second repeats the first."""
    days = F.filter(
        F.array(*map(F.lit, DAYS)), lambda day: F.col("event_timestamp") < day.cast("timestamp_ntz")
    )
    return fx.activity(spark, sf_dir).withColumn("ingest_date", F.explode(days)).select(
        "event_id",
        F.when(F.col("customer_id") % 17 != 0, F.col("customer_id").cast("string"))
        .alias("customer_id"),
        "event_type",
        F.col("event_timestamp").cast("string").alias("event_timestamp"),
        "device_type",
        "network_type",
        F.struct(F.col("event_type").alias("flag")).alias("payload"),
        "ingest_date",
    )


def _plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.plans(spark, sf_dir).select(
        "plan_id",
        "plan_name",
        F.col("monthly_price").cast("decimal(12,2)").alias("monthly_price"),
        F.lit(10).alias("data_allowance_gb"),
        F.lit(100).alias("voice_minutes"),
        F.lit(50).alias("sms_allowance"),
        F.when(F.col("plan_category") == "Premium", "Y").otherwise("N").alias("roaming_enabled"),
        F.lit(30).alias("validity_days"),
        "plan_category",
    )


def archive_batches(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Compressed files of all deliveries; the activity is made once for all of them."""
    activity = _activity(spark, sf_dir).write.partitionBy("ingest_date")
    with open_folders(spark):
        activity.json(f"{root}/archive/activity_logs", compression="gzip")
    for day in DAYS:
        _customers(spark, sf_dir, day).write.json(f"{root}/archive/customers/{day}", compression="gzip")
        _plans(spark, sf_dir).write.option("header", True).csv(f"{root}/archive/plans/{day}")


PLAN_DAYS = ("1999-01-01", "1999-01-02", "1999-01-03")


def archive_plan_versions(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Plan catalogues of three days whose headers differ: in order, case, missing and extra columns."""
    plans = fx.part_plans(spark, sf_dir)
    number = F.substring("plan_id", 2, 20).cast("bigint")
    names = layout("plans").names
    other = [F.col(n).alias(n.upper()) for n in reversed(names) if n != "voice_minutes"]
    versions = (
        plans.select(*names),
        plans.filter(number % 2 == 0).select(F.lit("x").alias("LAUNCHED"), *other),
        plans.filter(number % 3 == 0).select("monthly_price", "plan_id"),
    )
    for day, version in zip(PLAN_DAYS, versions):
        version.write.option("header", True).csv(f"{root}/archive/plans/{day}")


def archive_events(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Events as NDJSON below a folder for each day."""
    events = fx.web_events(spark, sf_dir).withColumn("ingest_date", F.date_format("event_timestamp", "yyyy-MM-dd"))
    events.write.partitionBy("ingest_date").json(f"{root}/archive/dataset=activity_logs")


def stage_loose(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Staging snapshots some of whose values do not fit the typed tables."""
    plans = fx.part_plans(spark, sf_dir)
    size = F.col("data_allowance_gb")
    staged = {
        "plans": plans.withColumns({
            "monthly_price": F.col("monthly_price") * F.when(size % 5 == 0, 1_000_000).otherwise(1),
            "voice_minutes": F.when(F.col("plan_category") == "PROMO", "unlimited").otherwise(size.cast("string")),
            "sms_allowance": size.cast("bigint") * 100_000_000,
            "roaming_enabled": F.when(size == 7, "maybe").otherwise(F.col("roaming_enabled")),
        }),
        "customers": fx.table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("CUSTOMER_ID"),
            F.when(F.col("c_custkey") % 3 == 0, "soon").otherwise("2024-01-01 00:00:00").alias("ingestion_ts"),
        ),
        "activity": fx.web_events(spark, sf_dir).select(
            "event_id", "customer_id", "event_type",
            F.when(F.col("event_type") == "error", "never")
            .otherwise(F.col("event_timestamp").cast("string")).alias("event_ts"),
        ),
    }
    for folder, df in staged.items():
        df.write.parquet(f"{root}/staging/{folder}")


def run_batches(spark: SparkSession, sf_dir: str) -> str:
    """Both deliveries through all jobs, one run each; returns the root folder."""
    root = new_root(spark)
    archive_batches(spark, sf_dir, root)
    for day in DAYS:
        run_ts = f"{day} 00:00:00"
        date = dt.date.fromisoformat(day)
        standardize(spark, root, run_ts, date, date)
        build_staging(spark, root, run_ts)
        run_warehouse(spark, root, run_ts)
    return root

"""Questions the warehouse answers. All take frames shaped like the warehouse tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.operators.heavy import heavy_keys, with_neighbour
from dimflow.operators.ranks import ranked
from dimflow.operators.scd2 import CURRENT, END, START
from dimflow.session import cut_lineage


def _truncated(unit: str) -> Column:
    return F.date_trunc(unit, F.col("event_timestamp")).cast("timestamp_ntz")


def plan_at_event(fact: DataFrame, dim_plan: DataFrame, plan_key: str = "plan_sk") -> DataFrame:
    """Each activity with the plan its customer was on when it happened."""
    return fact.join(dim_plan, plan_key, "left")


def monthly_counts(fact: DataFrame) -> DataFrame:
    """Events per customer and month."""
    return (
        fact.filter(F.col("event_timestamp").isNotNull())
        .groupBy("customer_id", _truncated("month").alias("month"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


def behavior_change(monthly: DataFrame) -> DataFrame:
    """Adds the change against the customer's month before; a customer has one row per month."""
    before = F.lag("events").over(Window.partitionBy("customer_id").orderBy("month"))
    return monthly.withColumn("events_before", before).withColumn(
        "change", F.col("events") - F.col("events_before")
    )


def behavior_by_month(fact: DataFrame) -> DataFrame:
    """Events per customer and month, and the change against the customer's month before.

    Counted before the window, so a customer has one row per month there.
    """
    return behavior_change(monthly_counts(fact))


def plan_usage(fact: DataFrame, plan_key: str = "plan_sk") -> DataFrame:
    """Plans ranked by number of events, with the number of distinct customers.

    The counts are written first, so that the facts are read once.
    """
    used = cut_lineage(
        fact.groupBy(plan_key).agg(
            F.count(F.lit(1)).alias("events"), F.count_distinct("customer_id").alias("customers")
        )
    )
    return ranked(used, "events", "usage_rank")


def churn_matrix(dim_customer: DataFrame, plan_key: str = "plan_sk") -> DataFrame:
    """How often customers went from one plan and status to another.

    Counts every pair of consecutive versions in which the plan or the status differs.
    """
    heavy = heavy_keys(dim_customer, "customer_id", START)
    followed = with_neighbour(
        dim_customer.select("customer_id", START, plan_key, "status"),
        "customer_id", START, [plan_key, "status"], 1, "_next", heavy,
    )
    moves = followed.filter(F.col("_next").isNotNull()).select(
        "customer_id",
        F.col(plan_key).alias("from_plan"),
        F.col("status").alias("from_status"),
        F.col(f"_next.{plan_key}").alias("to_plan"),
        F.col("_next.status").alias("to_status"),
    )
    left_plan = ~F.col("from_plan").eqNullSafe(F.col("to_plan"))
    new_status = ~F.col("from_status").eqNullSafe(F.col("to_status"))
    return (
        moves.filter(left_plan | new_status)
        .groupBy("from_plan", "to_plan", "from_status", "to_status")
        .agg(
            F.count(F.lit(1)).alias("moves"),
            F.count_distinct("customer_id").alias("customers"),
        )
    )


def customer_lifecycle(dim_customer: DataFrame, fact: DataFrame, as_of) -> DataFrame:
    """Versions per customer, days covered and per version, first and last activity.

    Both sides are reduced to one row per customer before they meet. The open version counts
    up to ``as_of``.
    """
    days = F.date_diff(F.coalesce(F.col(END), as_of), F.col(START))
    versions = dim_customer.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("versions"),
        F.sum(days).cast("bigint").alias("days_covered"),
        F.max(days).cast("bigint").alias("longest_version_days"),
        F.min(START).alias("first_version_from"),
        F.count_if(F.col(CURRENT)).alias("open_versions"),
    )
    activity = fact.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("event_timestamp").alias("first_event"),
        F.max("event_timestamp").alias("last_event"),
    )
    return versions.join(activity, "customer_id", "left").fillna(0, ["events"])


def daily_trend(fact: DataFrame, by: list[str]) -> DataFrame:
    """Events per day and ``by`` columns, with subtotals (NULL stands for all)."""
    daily = (
        fact.groupBy(_truncated("day").alias("event_date"), *by)
        .agg(F.count(F.lit(1)).alias("events"))
    )
    # Subtotals over the daily counts: the raw events are not expanded once per level.
    return daily.rollup("event_date", *by).agg(
        F.sum("events").alias("events"),
        F.grouping_id().cast("bigint").alias("subtotal_level"),
    )

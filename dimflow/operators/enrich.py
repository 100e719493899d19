"""Left joins that add attributes. The added side holds one row per key.

No broadcast hints: Spark broadcasts the small side when its size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, where adaptive
execution splits partitions that are skewed on the left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_plan_attributes(customers: DataFrame, plans: DataFrame) -> DataFrame:
    """Customers with name, category and price of their plan; NULLs for an unknown plan."""
    c, p = customers.alias("c"), plans.alias("p")
    return c.join(p, F.col("c.plan_id") == F.col("p.plan_id"), "left").select(
        *[
            F.col(f"c.{name}")
            for name in (
                "customer_id", "first_name", "last_name", "email",
                "phone", "country", "status", "plan_id",
            )
        ],
        F.col("p.plan_name"),
        F.col("p.plan_category"),
        F.col("p.monthly_price"),
        F.col("c.ingestion_ts"),
    )


def with_current_plan(activity: DataFrame, customers: DataFrame) -> DataFrame:
    """Activity with the plan its customer is on now."""
    return activity.join(customers.select("customer_id", "plan_id"), "customer_id", "left")


def with_plan_key(customers: DataFrame, dim_plan: DataFrame) -> DataFrame:
    """Replace the plan's natural key by its surrogate key, NULL for an unknown plan."""
    keys = dim_plan.select("plan_id", "plan_sk")
    return customers.join(keys, "plan_id", "left").drop("plan_id")

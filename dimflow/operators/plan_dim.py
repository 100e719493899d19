"""Type-1 plan dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.values import with_defaults
from dimflow.operators.keys import assign_keys, stable_keys
from dimflow.schemas import layout

COLUMNS = tuple(layout("dim_plan").names)


def _attributes(stg_plans: DataFrame, run_ts: Column) -> DataFrame:
    wanted = [c for c in COLUMNS if c in stg_plans.columns]
    rows = with_defaults(stg_plans.select(*wanted), {"is_active": True})
    return rows.withColumn("updated_at", run_ts)


def refreshed_plans(
    stg_plans: DataFrame, known: DataFrame | None, run_ts: Column, last: DataFrame | None = None
) -> DataFrame:
    """Full refresh. ``known`` (plan_id, plan_sk of all earlier loads) keeps keys stable; with
    the largest key in ``last`` it may leave out plans that are not staged."""
    rows = _attributes(stg_plans, run_ts)
    if known is None:
        keyed = assign_keys(rows, ["plan_id"], "plan_sk")
    else:
        keyed = stable_keys(rows, known.select("plan_id", "plan_sk"), ["plan_id"], "plan_sk", last)
    return keyed.select(*COLUMNS)


def appended_plans(stg_plans: DataFrame, dim_plan: DataFrame, run_ts: Column) -> DataFrame:
    """Load without truncate: every staged plan is added again under a new key.

    Plans then occur several times, and a join on ``plan_id`` multiplies rows. Kept as the
    variant it is; ``refreshed_plans`` is what the jobs use.
    """
    added = assign_keys(_attributes(stg_plans, run_ts), ["plan_id"], "plan_sk", dim_plan)
    return dim_plan.select(*COLUMNS).unionByName(added.select(*COLUMNS))


def current_count(dim_customer: DataFrame) -> DataFrame:
    """Data-quality check: number of open versions."""
    return dim_customer.filter("is_current").agg(F.count(F.lit(1)).alias("current_rows"))

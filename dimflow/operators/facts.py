"""Point-in-time join and idempotent fact load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.values import between
from dimflow.operators.heavy import (
    WHOLE,
    heavy_keys,
    is_heavy,
    slot_at,
    with_heavy,
    without_heavy,
)
from dimflow.operators.scd2 import END, START
from dimflow.schemas import OPEN_END

FACT_COLUMNS = (
    "event_id", "customer_id", "customer_sk", "plan_sk", "event_type",
    "event_timestamp", "device_type", "network_type", "ingestion_ts",
)

# A key with more versions than this is joined by time slot as well.
MANY_VERSIONS = 256

_OPEN = -2


def point_in_time_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    attributes: Sequence[str],
    many_versions: int = MANY_VERSIONS,
) -> DataFrame:
    """Left join each fact to the version of its key that is valid at the fact's time.

    An equi join on the key with the interval test on top. A key with many facts is split by
    adaptive execution, as it sits on the left. A key with many versions would have each fact
    tested against all of them, so such keys also join on a time slot: a closed version appears
    in every slot it touches, an open one in a slot of its own that takes every fact at or
    after the key's first open start. Slots per key follow its number of versions, so the
    versions of heavy keys at most double, and a fact meets a bounded number of them.
    """
    right = versions.select(
        F.col(key).alias("_key"), F.col(START).alias("_start"), F.col(END).alias("_end"),
        *attributes,
    )
    on = [F.col(key) == F.col("_key"), between(F.col(at), F.col("_start"), F.col("_end"), OPEN_END)]
    first_open = F.min(F.when(F.col(END).isNull(), F.col(START)))
    heavy = heavy_keys(
        versions, key, START, many_versions, per_slot=max(many_versions, 1), _open_from=first_open
    )
    left = facts
    if heavy is not None:
        left = without_heavy(
            with_heavy(facts, F.col(key), heavy).withColumn("_slot", _fact_slot(F.col(at))), heavy
        )
        right = without_heavy(
            with_heavy(right, F.col("_key"), heavy).withColumn(
                "_version_slot", F.explode(_version_slots())
            ),
            heavy,
        )
        on.append(F.col("_slot") == F.col("_version_slot"))
    return left.join(right, on, "left").select(*facts.columns, *attributes)


def _fact_slot(at: Column) -> Column:
    return (
        F.when(~is_heavy(), WHOLE)
        .when(at >= F.col("_open_from"), _OPEN)
        .otherwise(slot_at(at))
    )


def _version_slots() -> Column:
    start, end = F.col("_start"), F.col("_end")
    # An empty interval matches nothing: least() keeps the range in order.
    touched = F.sequence(slot_at(F.least(start, end)), slot_at(end))
    reaches_open = F.coalesce(end > F.col("_open_from"), F.lit(False))
    return (
        F.when(~is_heavy(), F.array(F.lit(WHOLE)))
        .when(end.isNull(), F.array(F.lit(_OPEN)))
        .when(reaches_open, F.array_append(touched, F.lit(_OPEN)))
        .otherwise(touched)
    )


def not_loaded(staged: DataFrame, fact: DataFrame, key: str = "event_id") -> DataFrame:
    """Staged rows whose key is not in the fact yet; rows without a key always pass."""
    return staged.join(fact.select(key), key, "left_anti")


def new_facts(
    staged: DataFrame,
    dim_customer: DataFrame,
    fact: DataFrame | None,
    many_versions: int = MANY_VERSIONS,
) -> DataFrame:
    """Rows to append to the fact: not loaded yet, with the keys valid at event time.

    The anti join comes first; it does not depend on the dimension and leaves less to join.
    """
    fresh = staged if fact is None else not_loaded(staged, fact)
    keyed = point_in_time_join(
        fresh, dim_customer, "customer_id", "event_timestamp",
        ["customer_sk", "plan_sk"], many_versions,
    )
    return keyed.select(*FACT_COLUMNS)

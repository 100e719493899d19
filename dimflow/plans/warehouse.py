"""Staging to warehouse: staging tables, plan and customer dimension, activity fact.

Tables are folders of runs. The customer dimension keeps, per run, the versions that run closed
(never written again) and the open versions after it; so a run's cost follows the open
versions, not the length of the history.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.functions.values import run_id, stamp
from dimflow.operators.enrich import with_plan_key
from dimflow.operators.facts import new_facts
from dimflow.operators.keys import assign_keys
from dimflow.operators.metrics import row_counts
from dimflow.operators.plan_dim import refreshed_plans
from dimflow.operators.scd2 import CLOSED, KEPT, OPENED, START, scd2_apply
from dimflow.plans.facts_by_month import AT, MONTH, append_facts, month_of, not_in_fact, read_facts
from dimflow.plans.key_registry import known_keys, last_key, register, set_last_key
from dimflow.schemas import TRACKED, layout
from dimflow.session import cut_lineage
from dimflow.sources.files import Files
from dimflow.sources.readers import read_parquet, read_staged
from dimflow.sources.writers import (
    RUN,
    publish,
    published_before,
    read_runs,
    write_run,
    write_snapshot,
)

STAGING_TABLES = {"stg_plans": "plans", "stg_customers": "customers", "stg_activity": "activity"}


def load_staging(spark: SparkSession, root: str) -> DataFrame:
    """Truncate and reload the typed staging tables from the staging snapshots.

    Returns ``(table, column, rows, misfits)``: how many of a table's rows lost their value of the column because
    it does not fit the type. A snapshot that is not there is an error before any table is written.
    """
    seen = {table: Observation(table) for table in STAGING_TABLES}
    staged = {
        table: read_staged(spark, f"{root}/staging/{folder}", table, seen[table])
        for table, folder in STAGING_TABLES.items()
    }
    for table, df in staged.items():
        write_snapshot(df, f"{root}/warehouse/{table}")
    told = [
        (table, column, counts["rows"], misfits)
        for table, counts in ((table, observed.get) for table, observed in seen.items())
        for column, misfits in counts.items()
        if column != "rows"
    ]
    return spark.createDataFrame(told, "table string, column string, rows bigint, misfits bigint")


def staging_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_parquet(spark, f"{root}/warehouse/{table}", layout(table))


def _runs(root: str) -> str:
    return f"{root}/warehouse/runs"


def dim_plan(spark: SparkSession, root: str, runs: list[str] | None = None) -> DataFrame:
    """The plan dimension as of the last of ``runs`` (all complete runs by default)."""
    runs = published_before(spark, _runs(root)) if runs is None else runs
    every = read_runs(
        spark, f"{root}/warehouse/dim_plan", layout("dim_plan"), required=bool(runs)
    )
    return every.filter(F.col(RUN).isin(runs[-1:])).drop(RUN)


def dim_customer(
    spark: SparkSession, root: str, runs: list[str] | None = None, since: str | None = None
) -> DataFrame:
    """The customer dimension with its whole history as of the last of ``runs``.

    With ``since``, a time in the form of a run's id, without versions that ended before it: a version
    ends at the time of the run that closed it, so the folders of earlier runs are not read.
    """
    runs = published_before(spark, _runs(root)) if runs is None else runs
    _check_kept(spark, root, runs)
    closing = [run for run in runs if since is None or run[: len(since)] >= since]
    closed = (F.col("change") == CLOSED) & F.col(RUN).isin(closing)
    current = (F.col("change") != CLOSED) & F.col(RUN).isin(runs[-1:])
    every = _customer_runs(spark, root, required=bool(runs))
    return every.filter(closed | current).drop(RUN, "change")


def _compacted(root: str) -> str:
    return f"{root}/warehouse/compacted/dim_customer"


def _check_kept(spark: SparkSession, root: str, runs: list[str]) -> None:
    """Runs whose open versions are gone cannot be the last of those that are read."""
    if runs and runs[-1] in published_before(spark, _compacted(root)):
        raise ValueError(f"the open versions of run {runs[-1]} were compacted; later runs hold the history")


def compact_customers(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the open versions of all but the last ``keep`` complete runs; returns those runs.

    Every run writes its open versions anew, so those of earlier runs repeat what later ones hold, and storage would
    follow runs times customers. Closed versions are written once and stay, so the history as of the runs that are
    kept is unchanged. At least two runs are kept: the last can then be repeated, and who reads as of it is not
    disturbed by one that follows. Runs are marked before anything is deleted, and reading as of a marked run is an
    error. A call that stopped is finished by the next one.
    """
    if keep < 2:
        raise ValueError("at least two runs must keep their open versions")
    superseded = published_before(spark, _runs(root))[:-keep]
    marked = set(published_before(spark, _compacted(root)))
    if new := [run for run in superseded if run not in marked]:
        marks = spark.createDataFrame([(run,) for run in new], f"{RUN} string")
        marks.coalesce(1).write.mode("append").parquet(_compacted(root))
    files = Files(spark, f"{root}/warehouse/dim_customer")
    for run in superseded:
        for change in (KEPT, OPENED):
            if files.exists(folder := f"{RUN}={run}/change={change}"):
                files.delete(folder)
    return superseded


def _customer_runs(spark: SparkSession, root: str, required: bool = False) -> DataFrame:
    fields = [*layout("dim_customer").fields, T.StructField("change", T.StringType())]
    return read_runs(spark, f"{root}/warehouse/dim_customer", T.StructType(fields), required)


def fact_activity(
    spark: SparkSession,
    root: str,
    runs: list[str] | None = None,
    first_day: dt.date | None = None,
    last_day: dt.date | None = None,
) -> DataFrame:
    """The activity fact of ``runs`` (all complete runs by default). Of a range of event days only the
    folders of its months are read; events without a time are in no range."""
    runs = published_before(spark, _runs(root)) if runs is None else runs
    facts = read_facts(spark, _fact(root), runs)
    if first_day is not None:
        first = F.lit(first_day).cast("timestamp_ntz")
        facts = facts.filter((F.col(AT) >= first) & (F.col(MONTH) >= month_of(first)))
    if last_day is not None:
        last = F.lit(last_day).cast("timestamp_ntz")
        facts = facts.filter((F.col(AT) < last + F.expr("INTERVAL 1 DAY")) & (F.col(MONTH) <= month_of(last)))
    return facts.drop(MONTH)


def _fact(root: str) -> str:
    return f"{root}/warehouse/fact_activity"


def _keys(root: str, table: str) -> str:
    return f"{root}/warehouse/key_registry/{table}"


def _as_frame(spark: SparkSession, key: str, last: int) -> DataFrame:
    return spark.createDataFrame([(last,)], f"{key} bigint")


def load_dim_plan(spark: SparkSession, root: str, run_ts, before: list[str]) -> None:
    run, registry = run_id(run_ts), _keys(root, "dim_plan")
    staged = staging_table(spark, root, "stg_plans")
    last = last_key(spark, registry, before)
    known = known_keys(spark, registry, "plan_id", "plan_sk", before, staged)
    plans = refreshed_plans(staged, known, stamp(run_ts), _as_frame(spark, "plan_sk", last))
    write_run(plans, f"{root}/warehouse/dim_plan", run)
    register(spark, registry, run, dim_plan(spark, root, [run]), "plan_id", "plan_sk", last)


def load_dim_customer(
    spark: SparkSession, root: str, run_ts, before: list[str], reopen_same_run: bool = True
) -> None:
    run, registry = run_id(run_ts), _keys(root, "dim_customer")
    last = spark.createDataFrame([], layout("dim_customer"))
    _check_kept(spark, root, before)
    if before:
        every = _customer_runs(spark, root, required=True)
        last = every.filter((F.col(RUN) == before[-1]) & (F.col("change") != CLOSED))
    snapshot = with_plan_key(
        staging_table(spark, root, "stg_customers"), dim_plan(spark, root, [run])
    )
    applied = cut_lineage(
        scd2_apply(
            last.select(*layout("dim_customer").names),
            snapshot, "customer_id", TRACKED, stamp(run_ts), reopen_same_run,
        )
    )
    opened = applied.filter(F.col("change") == OPENED).drop("customer_sk")
    used = last_key(spark, registry, before)
    keyed = assign_keys(
        opened, ["customer_id", START], "customer_sk", _as_frame(spark, "customer_sk", used)
    )
    versions = applied.filter(F.col("change") != OPENED).unionByName(keyed)
    write_run(versions, f"{root}/warehouse/dim_customer", run, ["change"])
    new = _customer_runs(spark, root).filter((F.col(RUN) == run) & (F.col("change") == OPENED))
    set_last_key(spark, registry, run, new.select("customer_sk"), used)


def load_fact_activity(spark: SparkSession, root: str, run_ts, before: list[str]) -> None:
    """Append the staged activity that is not loaded yet. Of the dimension, only versions that were open
    at the oldest new event or later are read."""
    run = run_id(run_ts)
    fresh = not_in_fact(spark, _fact(root), staging_table(spark, root, "stg_activity"), before)
    oldest = F.greatest(F.min("event_timestamp"), F.lit("0001-01-01").cast("timestamp_ntz"))
    bounded = F.least(oldest, F.lit("9999-12-31").cast("timestamp_ntz"))
    since = fresh.agg(F.date_format(F.when(F.min("event_timestamp").isNotNull(), bounded), "yyyyMMdd'T'HHmmss")).first()[0]
    # No event has a time: no version is asked for, and that of no run ends late enough.
    versions = dim_customer(spark, root, [*before, run], "Z" if since is None else since)
    append_facts(spark, _fact(root), new_facts(fresh, versions, None), run)


def run_warehouse(
    spark: SparkSession, root: str, run_ts: dt.datetime | str, reopen_same_run: bool = True
) -> DataFrame:
    """All loads in order, then the mark that makes the run visible; returns row counts.

    A run that stops half-way leaves nothing that readers see, and may be repeated.
    """
    run = run_id(run_ts)
    before = published_before(spark, _runs(root), run)
    _check_kept(spark, root, before)
    misfits = load_staging(spark, root)
    misfits.coalesce(1).write.mode("overwrite").json(f"{root}/metrics/load_staging/run_id={run}")
    load_dim_plan(spark, root, run_ts, before)
    load_dim_customer(spark, root, run_ts, before, reopen_same_run)
    load_fact_activity(spark, root, run_ts, before)
    publish(spark, _runs(root), run)
    runs = [*before, run]
    return row_counts(
        {
            "dim_plan": dim_plan(spark, root, runs),
            "dim_customer": dim_customer(spark, root, runs),
            "dim_customer_current": dim_customer(spark, root, runs).filter("is_current"),
            "fact_activity": fact_activity(spark, root, runs),
        }
    )

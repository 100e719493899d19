"""One query per operator on the test tables. Oracle twins are in ``oracle``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.functions.jsontext import payload_field
from dimflow.functions.paths import dataset_of, decoded_key
from dimflow.functions.values import normalized_names, stamp, with_defaults
from dimflow.operators.align import align_by_name
from dimflow.operators.asof import as_of_join
from dimflow.operators.enrich import with_current_plan, with_plan_attributes, with_plan_key
from dimflow.operators.facts import new_facts, point_in_time_join
from dimflow.operators.keys import assign_keys, stable_keys
from dimflow.operators.latest import collapse_copies, keep_latest
from dimflow.operators.metrics import record_counts
from dimflow.operators.plan_dim import appended_plans, current_count, refreshed_plans
from dimflow.operators.quality import labelled, split_records
from dimflow.operators.scd2 import CURRENT, END, START, scd2_apply, scd2_history
from dimflow.operators.splice import scd2_splice
from dimflow.operators.verdicts import (
    alerts,
    file_facts,
    first_lines,
    routed_to,
    verdicts,
)
from dimflow.plans import archived, landed, monthly, reports
from dimflow.plans import fixtures as fx
from dimflow.plans.staging import build_staging
from dimflow.plans.standardize import standardize, typed
from dimflow.plans.warehouse import (
    compact_customers,
    dim_customer,
    dim_plan,
    fact_activity,
    load_staging,
    run_warehouse,
)
from dimflow.schemas import BAD_NDJSON, OK, UNKNOWN_FOLDER, layout
from dimflow.session import cut_lineage
from dimflow.sources.readers import read_archive

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TS = fx.RUN_TS
# The last one is after the last row of the tables.
SNAPSHOTS = ("1997-01-01 00:00:00", "1999-01-01 00:00:00", "2002-01-01 00:00:00")
LOADED_BEFORE = "1998-01-01 00:00:00"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- standardize -------------------------------------------------------------------------


def _events_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.web_events(spark, sf_dir).select(
        F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 17 != 0, F.col("event_id")).alias("event_id"),
        F.when(F.col("event_id") % 19 != 0, F.col("customer_id")).alias("customer_id"),
        "event_type",
    )


@query
def split_good_bad(spark, sf_dir):
    return labelled(_events_with_nulls(spark, sf_dir), ["event_id", "customer_id"])


@query
def standardize_timestamps(spark, sf_dir):
    text = F.col("event_timestamp").cast("string")
    written = (
        F.when(F.col("event_id") % 13 == 0, "not a time")
        .when(F.col("event_id") % 11 == 0, "")
        .when(F.col("event_id") % 7 == 0, F.replace(text, F.lit(" "), F.lit("T")))
        .otherwise(text)
    )
    raw = fx.web_events(spark, sf_dir).withColumn("event_timestamp", written)
    return typed(raw, "activity_logs", stamp(RUN_TS)).drop("payload")


@query
def dedupe_latest_activity(spark, sf_dir):
    return fx.unique_shipments(spark, sf_dir)


@query
def dedupe_with_copies(spark, sf_dir):
    shipped = fx.raw_shipments(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag"
    )
    return collapse_copies(shipped, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query
def run_summary(spark, sf_dir):
    shipped = fx.raw_shipments(spark, sf_dir)
    activity = shipped.select(
        F.when(F.col("l_suppkey") % 17 != 0, F.concat_ws("-", "l_orderkey", "l_linenumber"))
        .alias("event_id"),
        F.col("l_shipdate").alias("event_ts"),
    )
    feed = fx.order_feed(spark, sf_dir)
    customers = feed.select(
        F.when(F.col("feed_seq") % 19 != 0, F.col("customer_id")).alias("customer_id"),
        "ingestion_ts",
    )
    plans = feed.select("plan_id", "ingestion_ts")
    counts = []
    for dataset, rows, key, at in (
        ("activity_logs", activity, "event_id", "event_ts"),
        ("customers", customers, "customer_id", "ingestion_ts"),
        ("plans", plans, "plan_id", "ingestion_ts"),
    ):
        good, bad = split_records(rows, [key])
        counts.append(record_counts(collapse_copies(good, [key], [at]), bad, dataset))
    return reduce(DataFrame.unionByName, counts)


@query
def payload_field_extract(spark, sf_dir):
    return fx.web_events(spark, sf_dir).select(
        "event_id",
        payload_field(F.col("payload"), "k", "int").alias("k"),
        payload_field(F.col("payload"), "absent", "string").alias("absent"),
    )


@query
def normalized_columns(spark, sf_dir):
    odd = fx.table(spark, sf_dir, "supplier").toDF("Supp Key", "suppName", "Nation-Key", "AcctBAL")
    return with_defaults(normalized_names(odd), {"is_active": True})


# --- staging -----------------------------------------------------------------------------


@query
def latest_customer_snapshot(spark, sf_dir):
    return fx.customers(spark, sf_dir)


@query
def latest_plan_snapshot(spark, sf_dir):
    return keep_latest(fx.plan_feed(spark, sf_dir), ["plan_id"], ["ingestion_ts", "feed_seq"])


@query
def customer_plan_enrichment(spark, sf_dir):
    return with_plan_attributes(
        fx.customers_with_odd_plans(spark, sf_dir), fx.plans(spark, sf_dir)
    )


@query
def activity_current_plan(spark, sf_dir):
    latest = fx.latest_orders(fx.order_feed(spark, sf_dir))
    return with_current_plan(fx.activity(spark, sf_dir), latest)


@query
def align_columns_by_name(spark, sf_dir):
    loose = fx.part_plans(spark, sf_dir).withColumn(
        "roaming_enabled",
        F.when(F.col("data_allowance_gb") == 7, "maybe").otherwise(F.col("roaming_enabled")),
    )
    upper = loose.toDF(*[c.upper() for c in loose.columns])
    changed = upper.drop("SMS_ALLOWANCE").withColumn("surplus", F.lit(1))
    typed_rows = align_by_name(changed, layout("stg_plans"))
    return typed_rows.withColumn("monthly_price", F.col("monthly_price").cast("double"))


# --- customer dimension ------------------------------------------------------------------


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_history(
        fx.order_feed(spark, sf_dir), "customer_id", "ingestion_ts", fx.TRACKED, ["feed_seq"]
    )


@query
def scd2_bulk_history(spark, sf_dir):
    return _history(spark, sf_dir)


@query
def scd2_current_rows(spark, sf_dir):
    return (
        _history(spark, sf_dir)
        .filter(CURRENT)
        .groupBy("plan_id", "status")
        .agg(F.count(F.lit(1)).alias("current_rows"))
    )


@query
def scd2_late_batch(spark, sf_dir):
    """A month of the feed that comes after all others, put into the history of the others."""
    feed = cut_lineage(fx.order_feed(spark, sf_dir))
    late = F.col("ingestion_ts").between(F.lit("1997-06-01").cast("timestamp_ntz"), F.lit("1997-06-30").cast("timestamp_ntz"))
    known = feed.filter(~late)
    history = cut_lineage(scd2_history(known, "customer_id", "ingestion_ts", fx.TRACKED, ["feed_seq"]))
    return scd2_splice(history, known, feed.filter(late), "customer_id", "ingestion_ts", fx.TRACKED, ["feed_seq"])


@query
def scd2_current_check(spark, sf_dir):
    """Data-quality count of open versions."""
    return current_count(_history(spark, sf_dir))


def _batches(spark: SparkSession, sf_dir: str, reopen_same_run: bool) -> DataFrame:
    """Three snapshots applied one after the other; closed versions are set aside."""
    feed = fx.order_feed(spark, sf_dir)
    fields = feed.drop("ingestion_ts").schema
    columns = [*fields.names, START, END, CURRENT]
    current = feed.filter("false").select(
        *fields.names,
        F.col("ingestion_ts").alias(START),
        F.col("ingestion_ts").alias(END),
        F.lit(True).alias(CURRENT),
    )
    closed = []
    for at in SNAPSHOTS:
        snapshot = fx.latest_orders(feed.filter(F.col("ingestion_ts") < F.lit(at).cast("timestamp_ntz")))
        applied = cut_lineage(
            scd2_apply(
                current, snapshot, "customer_id", fx.TRACKED, stamp(at), reopen_same_run
            )
        ).select(*columns)
        closed.append(applied.filter(~F.col(CURRENT)))
        current = applied.filter(CURRENT)
    return reduce(DataFrame.unionByName, closed, current)


@query
def scd2_apply_three_batches(spark, sf_dir):
    return _batches(spark, sf_dir, reopen_same_run=True)


@query
def scd2_merge_one_step(spark, sf_dir):
    return _batches(spark, sf_dir, reopen_same_run=False)


@query
def scd2_closed_in_batch(spark, sf_dir):
    return (
        _batches(spark, sf_dir, reopen_same_run=True)
        .filter(~F.col(CURRENT))
        .groupBy(END)
        .agg(F.count(F.lit(1)).alias("closed_rows"))
    )


# --- keys and plan dimension -------------------------------------------------------------


def _priced(plans: DataFrame) -> DataFrame:
    return plans.withColumn("monthly_price", F.col("monthly_price").cast("double"))


@query
def dim_plan_type1(spark, sf_dir):
    return _priced(refreshed_plans(fx.staged_part_plans(spark, sf_dir), None, stamp(RUN_TS)))


@query
def dim_plan_append_variant(spark, sf_dir):
    staged = fx.staged_part_plans(spark, sf_dir)
    first = refreshed_plans(staged, None, stamp("2001-01-01 00:00:00"))
    both = appended_plans(staged, first, stamp(RUN_TS))
    return both.select("plan_sk", "plan_id", "plan_name", "is_active", "updated_at")


@query
def surrogate_keys(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    return assign_keys(rows, ["customer_id"], "customer_sk")


@query
def surrogate_keys_incremental(spark, sf_dir):
    """Customers who ordered before the first snapshot have keys; all others get new ones."""
    rows = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    feed = fx.order_feed(spark, sf_dir)
    early = feed.filter(F.col("ingestion_ts") < F.lit("1995-06-01").cast("timestamp_ntz"))
    known = assign_keys(early.select("customer_id").distinct(), ["customer_id"], "customer_sk")
    return stable_keys(rows, known, ["customer_id"], "customer_sk")


def _dim_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_keys(fx.plans(spark, sf_dir), ["plan_id"], "plan_sk")


@query
def plan_key_lookup(spark, sf_dir):
    return with_plan_key(
        fx.customers_with_odd_plans(spark, sf_dir), _dim_plan(spark, sf_dir)
    ).select("customer_id", "first_name", "status", "plan_sk")


# --- facts -------------------------------------------------------------------------------


def _dim_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history as the written table that loads and reports read."""
    return cut_lineage(_history(spark, sf_dir))


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = _dim_table(spark, sf_dir).withColumn("version_from", F.col(START))
    return point_in_time_join(
        fx.activity(spark, sf_dir), versions, "customer_id", "event_timestamp",
        ["version_from", "status", "plan_id"],
    )


@query
def fact_point_in_time(spark, sf_dir):
    return _resolved(spark, sf_dir)


@query
def fact_point_in_time_merge(spark, sf_dir):
    """The same by one merge of facts and versions in order of time."""
    versions = _dim_table(spark, sf_dir).withColumn("version_from", F.col(START))
    return as_of_join(
        fx.activity(spark, sf_dir), versions, "customer_id", "event_timestamp",
        ["version_from", "status", "plan_id"],
    )


@query
def plan_at_event(spark, sf_dir):
    """What plan was the customer on when the activity occurred?"""
    facts = _resolved(spark, sf_dir).select("event_id", "customer_id", "event_timestamp", "plan_id")
    return reports.plan_at_event(facts, fx.plans(spark, sf_dir), "plan_id")


@query
def unmatched_facts(spark, sf_dir):
    return (
        _resolved(spark, sf_dir)
        .filter(F.col("version_from").isNull())
        .select("event_id", "customer_id", "event_timestamp")
    )


def _keyed_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = assign_keys(_dim_table(spark, sf_dir), ["customer_id", START], "customer_sk")
    return cut_lineage(with_plan_key(keyed, _dim_plan(spark, sf_dir)))


def _staged_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(fx.activity(spark, sf_dir).withColumn("ingestion_ts", stamp(RUN_TS)))


@query
def fact_idempotent_append(spark, sf_dir):
    staged = _staged_activity(spark, sf_dir)
    loaded = staged.filter(
        F.col("event_timestamp") < F.lit(LOADED_BEFORE).cast("timestamp_ntz")
    )
    return new_facts(staged, _keyed_dim(spark, sf_dir), loaded)


@query
def fact_reload_adds_zero(spark, sf_dir):
    staged = _staged_activity(spark, sf_dir)
    dim = _keyed_dim(spark, sf_dir)
    first = cut_lineage(new_facts(staged, dim, None))
    second = new_facts(staged, dim, first)
    both = first.select(F.lit(1).alias("load")).unionByName(second.select(F.lit(2).alias("load")))
    return both.agg(
        F.count_if(F.col("load") == 1).alias("first_load"),
        F.count_if(F.col("load") == 2).alias("second_load"),
    )


# --- reports -----------------------------------------------------------------------------


@query
def behavior_change_monthly(spark, sf_dir):
    return reports.behavior_by_month(fx.activity(spark, sf_dir))


@query
def behavior_change_incremental(spark, sf_dir):
    """The same from counts that three loads kept up to date, the last of them all months after the second."""
    path = f"{archived.new_root(spark)}/monthly"
    events = cut_lineage(fx.activity(spark, sf_dir))
    bounds = [F.lit(at).cast("timestamp_ntz") for at in SNAPSHOTS[:2]]
    at = F.col("event_timestamp")
    # Every tenth event of the first load comes with the last one, so old months are counted again.
    tardy = (F.crc32("event_id") % 10 == 0) & (at < bounds[0])
    loads = [(at < bounds[0]) & ~tardy, (at >= bounds[0]) & (at < bounds[1]), (at >= bounds[1]) | tardy]
    for number, load in enumerate(loads):
        monthly.add_events(spark, path, f"{number:03d}", events.filter(load))
    return monthly.monthly_report(spark, path, events.schema["customer_id"].dataType)


@query
def plan_usage_ranked(spark, sf_dir):
    return reports.plan_usage(_resolved(spark, sf_dir), "plan_id")


@query
def plan_churn_matrix(spark, sf_dir):
    return reports.churn_matrix(_dim_table(spark, sf_dir), "plan_id")


@query
def customer_lifecycle(spark, sf_dir):
    return reports.customer_lifecycle(
        _history(spark, sf_dir), fx.activity(spark, sf_dir), stamp(RUN_TS)
    )


@query
def daily_event_trend(spark, sf_dir):
    return reports.daily_trend(fx.web_events(spark, sf_dir), ["event_type"])


@query
def daily_device_trend(spark, sf_dir):
    shipped = fx.raw_shipments(spark, sf_dir)
    return reports.daily_trend(
        shipped.select(*fx.activity_columns(shipped)), ["device_type", "network_type"]
    )


# --- landed files ------------------------------------------------------------------------


def _judged(lines: DataFrame, seen: DataFrame, sampled: bool = False) -> DataFrame:
    day = stamp(RUN_TS).cast("date")
    judged = verdicts(fx.listing(lines), file_facts(seen), day, sampled=sampled)
    return judged.drop("uri", "header", "header_no")


@query
def ndjson_verdicts(spark, sf_dir):
    lines = fx.ndjson_files(spark, sf_dir)
    return _judged(lines, lines)


@query
def ndjson_verdicts_sampled(spark, sf_dir):
    """The same files judged by their first lines only: a sampling operator."""
    lines = fx.ndjson_files(spark, sf_dir)
    return _judged(lines, first_lines(lines, max_lines=3, max_bytes=2048), sampled=True)


@query
def csv_verdicts(spark, sf_dir):
    lines = fx.csv_files(spark, sf_dir)
    return _judged(lines, lines)


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = (
        F.when(F.col("source") == "src0", "customers")
        .when(F.col("source") == "src1", "plans")
        .when(F.col("source") == "src2", "activity_logs")
        .otherwise(F.col("source"))
    )
    event_key = F.concat(
        F.lit("raw/"), folder, F.lit("/"), F.col("lang"), F.lit("+part%20"),
        F.col("doc_id").cast("string"), F.lit(".ndjson"),
    )
    keyed = fx.table(spark, sf_dir, "documents").select(
        decoded_key(event_key).alias("key"), "n_chars"
    )
    sound = F.col("n_chars") >= 1000
    judged = keyed.withColumn("dataset", dataset_of(F.col("key"))).withColumn(
        "reason",
        F.when(F.col("dataset").isNull(), UNKNOWN_FOLDER).when(sound, OK).otherwise(BAD_NDJSON),
    )
    named = judged.withColumn("ok", F.col("reason") == OK)
    return named.withColumn("moved_to", routed_to(stamp(RUN_TS).cast("date"))).drop("n_chars")


@query
def route_destinations(spark, sf_dir):
    return _routed(spark, sf_dir)


@query
def rejection_alerts(spark, sf_dir):
    return alerts(_routed(spark, sf_dir))


@query
def csv_verdicts_multiline(spark, sf_dir):
    """Rows of quoted cells that span lines and splits."""
    lines = fx.csv_files_multiline(spark, sf_dir)
    return _judged(lines, lines)


@query
def archive_date_replay(spark, sf_dir):
    """A week of an archive of daily folders."""
    root = archived.new_root(spark)
    archived.archive_events(spark, sf_dir, root)
    week = read_archive(spark, root, "activity_logs", dt.date(2024, 1, 10), dt.date(2024, 1, 16))
    return week.groupBy(F.col("archive_date").cast("string").alias("archive_date"), "event_type").agg(
        F.count(F.lit(1)).alias("events")
    )


@query
def plans_across_headers(spark, sf_dir):
    """Three days of CSV files with unlike headers as one frame, and the middle day by itself."""
    root = archived.new_root(spark)
    archived.archive_plan_versions(spark, sf_dir, root)
    middle = dt.date.fromisoformat(archived.PLAN_DAYS[1])
    asked = {"all": read_archive(spark, root, "plans"), "middle": read_archive(spark, root, "plans", middle, middle)}
    told = [df.withColumn("asked", F.lit(name)) for name, df in asked.items()]
    return reduce(DataFrame.unionByName, told).drop("raw_line", "source_file").withColumn(
        "archive_date", F.col("archive_date").cast("string")
    )


@query
def intake_manifest(spark, sf_dir):
    """Verdicts of two deliveries of files, the second of known keys with an old date."""
    root = archived.new_root(spark)
    told = landed.manifests(spark, root, landed.taken_in(spark, sf_dir, root))
    return told.select("delivery", "key", "dataset", "ok", "reason", "moved_to")


@query
def intake_routed_lines(spark, sf_dir):
    """What is read at the places that the verdicts announce."""
    root = archived.new_root(spark)
    told = landed.manifests(spark, root, landed.taken_in(spark, sf_dir, root))
    lines = landed.lines_in_place(spark, root, told)
    return lines.groupBy("moved_to", "value").agg(F.count(F.lit(1)).alias("n"))


@query
def intake_redelivery(spark, sf_dir):
    """Keys that were delivered again, with all verdicts and the lines at the last place."""
    root = archived.new_root(spark)
    told = landed.manifests(spark, root, landed.taken_in(spark, sf_dir, root))
    keys = told.groupBy("key").agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("delivery", "reason"))), lambda x: x["reason"]), "; ").alias("reasons"),
        F.max_by("moved_to", "delivery").alias("moved_to"),
    )
    counts = landed.lines_in_place(spark, root, told).groupBy("moved_to").agg(F.count(F.lit(1)).alias("lines"))
    return keys.where("deliveries > 1").join(counts, "moved_to").select("key", "deliveries", "reasons", "moved_to", "lines")


# --- whole runs over archived files ------------------------------------------------------


@query
def standardize_counts(spark, sf_dir):
    """Both deliveries standardized in one run."""
    root = archived.new_root(spark)
    archived.archive_batches(spark, sf_dir, root)
    return standardize(spark, root, RUN_TS)


@query
def quarantined_records(spark, sf_dir):
    root = archived.new_root(spark)
    archived.archive_batches(spark, sf_dir, root)
    standardize(spark, root, RUN_TS)
    bad = spark.read.parquet(f"{root}/clean/bad_records/activity_logs")
    return bad.select(
        "event_id", "event_ts", "reason", payload_field(F.col("payload"), "flag", "string").alias("flag"),
        F.col("archive_date").cast("string").alias("archive_date"),
    )


@query
def staged_customers(spark, sf_dir):
    root = archived.new_root(spark)
    archived.archive_batches(spark, sf_dir, root)
    standardize(spark, root, RUN_TS)
    build_staging(spark, root, RUN_TS)
    return spark.read.parquet(f"{root}/staging/customers")


@query
def staging_misfits(spark, sf_dir):
    """Values that do not fit the typed staging tables, by column."""
    root = archived.new_root(spark)
    archived.stage_loose(spark, sf_dir, root)
    return load_staging(spark, root).filter("misfits > 0").withColumnsRenamed(
        {"table": "staging_table", "column": "staging_column", "rows": "n_rows"}
    )


@query
def warehouse_customers(spark, sf_dir):
    """Customer versions after two daily runs, with the plan's natural key."""
    return _versions(spark, archived.run_batches(spark, sf_dir))


def _versions(spark, root):
    plans = dim_plan(spark, root).select("plan_sk", "plan_id", "monthly_price", "roaming_enabled")
    versions = dim_customer(spark, root).join(plans, "plan_sk", "left")
    return versions.select(
        "customer_id", "first_name", "status", "plan_id", "roaming_enabled",
        F.col("monthly_price").cast("double").alias("monthly_price"), START, END, CURRENT,
    )


@query
def warehouse_customers_compacted(spark, sf_dir):
    """The same after two runs without news, when the open versions of the first two runs are gone."""
    root = archived.run_batches(spark, sf_dir)
    for run_ts in archived.QUIET:
        run_warehouse(spark, root, run_ts)
    compact_customers(spark, root)
    return _versions(spark, root)


@query
def warehouse_facts(spark, sf_dir):
    """Facts after two daily runs, with the start of the customer version they point to."""
    root = archived.run_batches(spark, sf_dir)
    versions = dim_customer(spark, root).select("customer_sk", F.col(START).alias("version_from"))
    plans = dim_plan(spark, root).select("plan_sk", "plan_id")
    return (
        fact_activity(spark, root)
        .join(versions, "customer_sk", "left")
        .join(plans, "plan_sk", "left")
        .drop("customer_sk", "plan_sk")
    )

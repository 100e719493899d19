"""Whole runs over temporary folders."""

import datetime as dt
import json

import pytest

from pyspark.errors import AnalysisException

from dimflow.operators.keys import stable_keys
from dimflow.plans.facts_by_month import append_facts, not_in_fact, read_facts, times_of
from dimflow.plans.key_registry import known_keys, last_key, register
from dimflow.plans.staging import build_staging
from dimflow.plans.standardize import standardize
from dimflow.plans.warehouse import (
    compact_customers,
    dim_customer,
    dim_plan,
    fact_activity,
    load_dim_customer,
    load_dim_plan,
    load_staging,
    run_warehouse,
    staging_table,
)
from dimflow.schemas import layout
from dimflow.session import cut_lineage
from dimflow.sources.buckets import read_touched
from dimflow.sources.readers import preview, read_archive, read_evolved, read_parquet
from dimflow.sources.writers import published_before, write_run

PLAN_HEADER = ",".join(layout("plans").names)


def archive(root, dataset, day, name, *lines):
    path = root / "archive" / dataset / day / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(line + "\n" for line in lines), encoding="utf-8")


def customer(key, plan, status="active", **more):
    record = {"customer_id": key, "first_name": "F", "email": f"{key}@x", "plan_id": plan,
              "status": status, "registration_date": "2025-01-01", **more}
    return json.dumps(record)


def event(key, who, at, **more):
    return json.dumps({"event_id": key, "customer_id": who, "event_type": "call",
                       "event_timestamp": at, "payload": {"k": [1, 2]}, **more})


@pytest.fixture
def day_one(tmp_path):
    archive(tmp_path, "plans", "2025-05-01", "p.csv", PLAN_HEADER,
            "P001,Premium Plan 1,2212.81,20,300,100,Y,365,Premium",
            "P003,Basic Plan 3,abc,1,2000,100,N,30,Basic", ",no key,1,1,1,1,Y,1,x")
    archive(tmp_path, "customers", "2025-05-01", "c.ndjson",
            customer("c1", "P001"), customer("c2", "P003"), customer("c2", "P003"),
            customer(None, "P001"), '{"customer_id": "cut', customer("c3", "P009"))
    archive(tmp_path, "activity_logs", "2025-05-01", "a.ndjson",
            event("e1", "c1", "2025-05-02 10:00:00"), event("e1", "c1", "2025-05-02 10:00:00"),
            event("e2", "c2", "never"), event(None, "c1", "2025-05-02"), event("e3", None, "2025-05-02"))
    return tmp_path


def run_day(spark, root, at, day=None):
    standardize(spark, root, at, day, day)
    build_staging(spark, root, at)
    return run_warehouse(spark, root, at)


def test_three_days(spark, rows, day_one):
    root = str(day_one)
    counts = standardize(spark, root, "2025-05-02 02:00:00")
    assert rows(counts) == [("activity_logs", 5, 2, 2, 1), ("customers", 6, 3, 2, 1), ("plans", 3, 2, 1, 0)]
    quarantined = spark.read.parquet(f"{root}/clean/bad_records/customers")
    assert rows(quarantined, "reason", "raw_line") == [
        ("null_keys_[customer_id]", '{"customer_id": "cut'), ("null_keys_[customer_id]", None),
    ]
    staged = build_staging(spark, root, "2025-05-02 02:00:00")
    assert rows(staged) == [("activity", 2), ("customers", 3), ("plans", 2)]
    assert spark.read.parquet(f"{root}/staging/customers").columns == [
        "customer_id", "first_name", "last_name", "email", "phone", "country", "status",
        "plan_id", "plan_name", "plan_category", "monthly_price", "ingestion_ts",
    ]
    first = {r["dataset"]: r["rows"] for r in run_warehouse(spark, root, "2025-05-02 02:00:00").collect()}
    assert first == {"dim_plan": 2, "dim_customer": 3, "dim_customer_current": 3, "fact_activity": 2}

    # The event is after the first start, so it has keys; the one without a time has none.
    facts = {r["event_id"]: r for r in fact_activity(spark, root).collect()}
    plans = {r["plan_id"]: r["plan_sk"] for r in dim_plan(spark, root).collect()}
    assert facts["e1"]["plan_sk"] == plans["P001"] and facts["e1"]["customer_sk"] is not None
    assert facts["e2"]["customer_sk"] is None and facts["e2"]["event_timestamp"] is None

    # Day two: c1 moves to another plan, c4 is new, an old event comes again, a late one arrives.
    archive(day_one, "customers", "2025-05-02", "c.ndjson", customer("c1", "P003"), customer("c4", "P001"))
    archive(day_one, "activity_logs", "2025-05-02", "a.ndjson",
            event("e1", "c1", "2025-05-02 10:00:00"), event("e4", "c1", "2025-05-02 11:00:00"),
            event("e5", "c1", "2025-05-03 02:00:00"))
    day = dt.date(2025, 5, 2)
    second = {r["dataset"]: r["rows"] for r in run_day(spark, root, "2025-05-03 02:00:00", day).collect()}
    assert second == {"dim_plan": 2, "dim_customer": 5, "dim_customer_current": 4, "fact_activity": 4}
    facts = {r["event_id"]: r["plan_sk"] for r in fact_activity(spark, root).collect()}
    assert facts == {"e1": plans["P001"], "e2": None, "e4": plans["P001"], "e5": plans["P003"]}
    assert {r["plan_id"]: r["plan_sk"] for r in dim_plan(spark, root).collect()} == plans
    keys = [r["customer_sk"] for r in dim_customer(spark, root).collect()]
    assert sorted(keys) == [1, 2, 3, 4, 5]

    # Repeating the run, or a run without news, changes nothing.
    before = rows(dim_customer(spark, root)), rows(fact_activity(spark, root))
    run_day(spark, root, "2025-05-03 02:00:00", day)
    assert (rows(dim_customer(spark, root)), rows(fact_activity(spark, root))) == before
    third = run_day(spark, root, "2025-05-04 02:00:00", dt.date(2025, 5, 3))
    assert {r["dataset"]: r["rows"] for r in third.collect()} == second
    kept = rows(dim_customer(spark, root), "customer_sk", "customer_id", "effective_start_date", "effective_end_date")
    assert kept == sorted([(r[0], r[1], r[9], r[10]) for r in before[0]], key=repr)


def test_compaction_keeps_the_history(spark, rows, day_one):
    root = str(day_one)
    run_day(spark, root, "2025-05-02 02:00:00")
    archive(day_one, "customers", "2025-05-02", "c.ndjson", customer("c1", "P003"), customer("c4", "P001"))
    run_day(spark, root, "2025-05-03 02:00:00", dt.date(2025, 5, 2))
    assert compact_customers(spark, root) == []
    run_warehouse(spark, root, "2025-05-04 02:00:00")
    before = rows(dim_customer(spark, root))
    first, second, third = published_before(spark, f"{root}/warehouse/runs")
    as_of_second = rows(dim_customer(spark, root, [first, second]))
    table = day_one / "warehouse" / "dim_customer"
    for _ in range(2):
        assert compact_customers(spark, root) == [first]
        assert not list(table.glob(f"run_id={first}/change=*")) and {p.name for p in table.glob(f"run_id={second}/change=*")} == {
            "change=closed", "change=kept", "change=opened",
        }
        assert rows(dim_customer(spark, root)) == before and len(before) == 5
        assert rows(dim_customer(spark, root, [first, second])) == as_of_second
    with pytest.raises(ValueError, match="compacted"):
        dim_customer(spark, root, [first])
    with pytest.raises(ValueError, match="compacted"):
        run_warehouse(spark, root, "2025-05-03 02:00:00")
    with pytest.raises(ValueError, match="at least two"):
        compact_customers(spark, root, keep=1)
    # The last run can be repeated, and the next one goes on from it.
    run_warehouse(spark, root, "2025-05-04 02:00:00")
    assert rows(dim_customer(spark, root)) == before
    run_day(spark, root, "2025-05-05 02:00:00", dt.date(2025, 5, 2))
    assert compact_customers(spark, root) == [first, second]
    assert rows(dim_customer(spark, root)) == before
    # A mark whose folders were not deleted yet: the next call deletes them.
    (table / f"run_id={first}" / "change=kept").mkdir(parents=True)
    compact_customers(spark, root)
    assert not (table / f"run_id={first}" / "change=kept").exists()


def test_a_run_that_stops_half_way_is_not_seen(spark, rows, day_one):
    root = str(day_one)
    run_day(spark, root, "2025-05-02 02:00:00")
    before = rows(dim_customer(spark, root)), rows(dim_plan(spark, root))
    archive(day_one, "customers", "2025-05-02", "c.ndjson", customer("c1", "P003", status="left"))
    at = "2025-05-03 02:00:00"
    standardize(spark, root, at, dt.date(2025, 5, 2), dt.date(2025, 5, 2))
    build_staging(spark, root, at)
    done = published_before(spark, f"{root}/warehouse/runs")
    load_staging(spark, root)
    load_dim_plan(spark, root, at, done)
    load_dim_customer(spark, root, at, done)  # ... and no further
    assert (rows(dim_customer(spark, root)), rows(dim_plan(spark, root))) == before
    # An abandoned run leaves no trace in later ones either.
    run_warehouse(spark, root, "2025-05-04 02:00:00")
    versions = rows(dim_customer(spark, root).filter("customer_id = 'c1'"), "effective_start_date", "is_current")
    assert versions == [(dt.datetime(2025, 5, 2, 2), False), (dt.datetime(2025, 5, 4, 2), True)]


def test_one_step_variant_reopens_a_run_later(spark, day_one):
    root = str(day_one)
    run_day(spark, root, "2025-05-02 02:00:00")
    archive(day_one, "customers", "2025-05-02", "c.ndjson", customer("c1", "P003"))
    standardize(spark, root, "2025-05-03 02:00:00")
    build_staging(spark, root, "2025-05-03 02:00:00")
    run_warehouse(spark, root, "2025-05-03 02:00:00", reopen_same_run=False)
    assert dim_customer(spark, root).filter("customer_id = 'c1' AND is_current").count() == 0
    run_warehouse(spark, root, "2025-05-04 02:00:00", reopen_same_run=False)
    assert dim_customer(spark, root).filter("customer_id = 'c1' AND is_current").count() == 1


def test_standardize_is_repeatable_and_newest_date_wins(spark, rows, day_one):
    root = str(day_one)
    archive(day_one, "customers", "2025-05-03", "c.ndjson", customer("c2", "P001", "left"))
    for _ in range(2):
        counts = standardize(spark, root, "2025-05-04 02:00:00")
    assert rows(counts.filter("dataset = 'customers'")) == [("customers", 7, 3, 2, 2)]
    clean = spark.read.parquet(f"{root}/clean/customers")
    assert rows(clean.filter("customer_id = 'c2'"), "status", "copies") == [("left", 3)]
    activity = spark.read.parquet(f"{root}/clean/activity_logs")
    assert activity.filter("event_id = 'e1'").first()["payload"] == '{"k": [1, 2]}'
    text = spark.read.text(f"{root}/metrics/standardize").first()["value"]
    assert json.loads(text)["datasets"]["customers"] == {"total": 7, "good": 3, "bad": 2, "duplicates": 2}


def test_replay_reads_only_the_asked_days(spark, rows, day_one):
    root = str(day_one)
    archive(day_one, "customers", "2025-05-03", "c.ndjson", customer("c7", "P001"))
    some = read_archive(spark, root, "customers", dt.date(2025, 5, 2), dt.date(2025, 5, 9))
    assert rows(some, "customer_id") == [("c7",)]
    assert read_archive(spark, root, "customers", None, dt.date(2025, 5, 2)).count() == 6


def test_missing_dataset_is_empty(spark, tmp_path):
    archive(tmp_path, "plans", "2025-05-01", "p.csv", PLAN_HEADER, "P001,a,1,1,1,1,Y,1,x")
    counts = standardize(spark, str(tmp_path), "2025-05-02 02:00:00")
    assert {r["dataset"]: r["total"] for r in counts.collect()} == {"customers": 0, "plans": 1, "activity_logs": 0}
    build_staging(spark, str(tmp_path), "2025-05-02 02:00:00")
    run_warehouse(spark, str(tmp_path), "2025-05-02 02:00:00")
    assert fact_activity(spark, str(tmp_path)).count() == 0
    assert dim_plan(spark, str(tmp_path)).first()["plan_sk"] == 1


def test_csv_is_read_by_name(spark, tmp_path):
    archive(tmp_path, "plans", "2025-05-01", "p.csv", "plan_name,extra,PLAN_ID,monthly_price", 'a,1,P1,2.5', 'b,2,P2,x')
    plans = read_archive(spark, str(tmp_path), "plans").orderBy("plan_id").collect()
    assert [(r["plan_id"], r["plan_name"], r["monthly_price"], r["sms_allowance"]) for r in plans] == [
        ("P1", "a", 2.5, None), ("P2", "b", None, None),
    ]


def test_csv_of_several_headers_is_one_frame(spark, rows, tmp_path):
    root = str(tmp_path)
    archive(tmp_path, "plans", "2025-05-01", "a.csv", "plan_id,plan_name", '"P,1",a', "", "plan_id,plan_name", "P2")
    archive(tmp_path, "plans", "2025-05-02", "b.csv", "", "MONTHLY_PRICE,extra,Plan_Id,plan_id", "2.5,x,P3,no", ",,P4,,,more")
    archive(tmp_path, "plans", "2025-05-03", "c.csv", "unknown", "x")
    archive(tmp_path, "plans", "2025-05-04", "d.csv", "plan_name,plan_id", *[f"n{i},P{i}" for i in range(5000)])
    archive(tmp_path, "plans", "2025-05-05", "e.csv")
    first, third = dt.date(2025, 5, 1), dt.date(2025, 5, 3)
    some = read_archive(spark, root, "plans", first, third)
    assert rows(some, "plan_id", "plan_name", "monthly_price") == sorted([
        ("P,1", "a", None), ("plan_id", "plan_name", None), ("P2", None, None),
        ("P3", None, 2.5), ("P4", None, None), (None, None, None),
    ], key=repr)
    day = dt.date(2025, 5, 2)
    assert rows(read_archive(spark, root, "plans", day, day), "plan_id") == [("P3",), ("P4",)]
    assert read_archive(spark, root, "plans", dt.date(2026, 1, 1), dt.date(2026, 1, 9)).count() == 0
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        plans = read_archive(spark, root, "plans", dt.date(2025, 5, 4))
        assert plans.count() == plans.filter("plan_name = replace(plan_id, 'P', 'n')").count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_staging_tables_are_typed(spark, day_one):
    root = str(day_one)
    standardize(spark, root, "2025-05-02 02:00:00")
    build_staging(spark, root, "2025-05-02 02:00:00")
    load_staging(spark, root)
    plan = staging_table(spark, root, "stg_plans").filter("plan_id = 'P001'").first()
    assert (str(plan["monthly_price"]), plan["roaming_enabled"]) == ("2212.81", True)
    activity = staging_table(spark, root, "stg_activity")
    assert activity.schema == layout("stg_activity")
    assert activity.filter("event_id = 'e1'").first()["event_timestamp"] == dt.datetime(2025, 5, 2, 10)
    assert preview(activity, "stg_activity_preview").count() == 2
    assert spark.sql("SELECT * FROM stg_activity_preview").columns == activity.columns


def test_lost_folders_raise_before_a_write(spark, rows, day_one):
    root, at = str(day_one), "2025-05-02 02:00:00"
    run_day(spark, root, at)
    clean, staging = (sorted(str(p) for p in (day_one / d).rglob("*.parquet")) for d in ("staging", "warehouse"))
    (day_one / "clean" / "customers").rename(day_one / "lost_clean")
    (day_one / "staging" / "activity").rename(day_one / "lost_staging")
    for job in (build_staging, run_warehouse):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            job(spark, root, "2025-05-03 02:00:00")
    (day_one / "lost_staging").rename(day_one / "staging" / "activity")
    assert sorted(str(p) for p in (day_one / "staging").rglob("*.parquet")) == clean
    assert sorted(str(p) for p in (day_one / "warehouse").rglob("*.parquet")) == staging
    # The same for a table of the warehouse itself, once runs are marked that wrote it.
    (day_one / "warehouse" / "dim_customer").rename(day_one / "lost_dimension")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        dim_customer(spark, root)


def test_values_that_do_not_fit_are_counted(spark, rows, tmp_path):
    root = str(tmp_path)
    odd = [("P1", "1e99", "maybe"), ("P2", "2.5", None), (None, None, "Y")]
    spark.createDataFrame(odd, "PLAN_ID string, monthly_price string, roaming_enabled string").write.parquet(f"{root}/staging/plans")
    spark.createDataFrame([], "customer_id string, ingestion_ts string").write.parquet(f"{root}/staging/customers")
    spark.createDataFrame([("e", "never")], "event_id string, event_ts string").write.parquet(f"{root}/staging/activity")
    assert rows(load_staging(spark, root)) == [
        ("stg_activity", "event_id", 1, 0), ("stg_activity", "event_timestamp", 1, 1),
        ("stg_customers", "customer_id", 0, 0), ("stg_customers", "ingestion_ts", 0, 0),
        ("stg_plans", "monthly_price", 3, 1), ("stg_plans", "plan_id", 3, 0), ("stg_plans", "roaming_enabled", 3, 1),
    ]
    assert rows(staging_table(spark, root, "stg_plans"), "plan_id", "roaming_enabled") == [
        ("P1", None), ("P2", None), (None, True),
    ]


FACT = "event_id string, event_timestamp timestamp_ntz"


def staged_facts(spark, *events):
    times = [(key, at and dt.datetime.fromisoformat(at)) for key, at in events]
    names = layout("fact_activity").names
    known = spark.createDataFrame(times, FACT)
    return known.selectExpr(*[n if n in known.columns else f"CAST(NULL AS {layout('fact_activity')[n].dataType.simpleString()}) AS {n}" for n in names])


def test_facts_are_looked_for_by_time_and_by_id(spark, rows, tmp_path):
    path = str(tmp_path)
    first = staged_facts(spark, ("a", "2025-05-01 10:00"), ("b", "2025-05-02 10:00"), ("c", None), (None, "2025-05-01"))
    append_facts(spark, path, not_in_fact(spark, path, first, []), "1")
    again = staged_facts(
        spark, ("a", "2025-05-01 10:00"), ("b", "2025-05-07 10:00"), ("c", "2025-05-01"), ("d", "2025-05-01"),
        ("a", None), (None, "2025-05-01"), ("e", None),
    )
    # Another day, a time found or lost: known ids stay out. Rows without an id always pass.
    fresh = not_in_fact(spark, path, again, ["1"])
    assert rows(fresh, "event_id") == sorted([("d",), ("e",), (None,)], key=repr)
    append_facts(spark, path, fresh, "2")
    append_facts(spark, path, staged_facts(spark, ("z", "2025-05-01")), "3")  # never marked
    assert not_in_fact(spark, path, again, ["1", "2"]).count() == 1
    assert read_facts(spark, path, ["1", "2"]).count() == 7
    assert not_in_fact(spark, path, staged_facts(spark), ["1", "2"]).count() == 0

    # Only the folders of the batch's months, and files of its times, and of the buckets of its ids, are read.
    may = staged_facts(spark, ("b", "2025-05-02 10:00"), ("y", "2025-06-01"))
    read = read_facts(spark, path, ["1", "2"], times_of(may))
    scanned = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scanned and "event_month" in scanned.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert rows(read, "event_id") == [("b",)]
    ids = read_touched(spark, f"{path}/ids", [layout("fact_activity")["event_id"]], ["1", "2"], ["event_id"], may)
    assert "bucket" in ids._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert {r[0] for r in ids.collect()} >= {"b"} and ids.count() < 5
    assert rows(read_facts(spark, path, ["1"], times_of(staged_facts(spark, ("x", None)))), "event_id") == [("c",)]
    assert "event_timestamp" in scanned.split("PushedFilters: [")[1].split("ReadSchema")[0]
    old = [(f"m{i}", f"{1900 + i // 12}-{i % 12 + 1:02}-01") for i in range(1100)]
    many = staged_facts(spark, *old, ("a", "2025-05-01 10:00"))
    assert rows(read_facts(spark, path, ["1"], times_of(many)), "event_id") == sorted([("a",), ("c",), (None,)], key=repr)


def test_registered_keys_are_kept_and_found_by_bucket(spark, rows, tmp_path):
    path = str(tmp_path)
    plans = lambda *p: spark.createDataFrame([(x,) for x in p], "plan_id string")

    def number(run, before, *ids):
        last = last_key(spark, path, before)
        known = known_keys(spark, path, "plan_id", "plan_sk", before, plans(*ids))
        top = spark.createDataFrame([(last,)], "plan_sk bigint")
        numbered = cut_lineage(stable_keys(plans(*ids), known, ["plan_id"], "plan_sk", top))
        register(spark, path, run, numbered, "plan_id", "plan_sk", last)
        return dict(rows(numbered))

    first = number("1", [], *[f"p{i}" for i in range(200)])
    assert sorted(first.values()) == list(range(1, 201))
    assert number("2", ["1"], "p7", "new") == {"p7": first["p7"], "new": 201}
    number("3", ["1", "2"], "abandoned")
    # A plan that was away has its key again; numbers of a run that was not marked are free.
    assert number("4", ["1", "2"], "p9", "new", "late") == {"p9": first["p9"], "new": 201, "late": 202}
    assert number("5", ["1", "2", "4"]) == {}
    assert last_key(spark, path, ["1", "2", "4", "5"]) == 202
    assert known_keys(spark, path, "plan_id", "plan_sk", ["1", "2", "4"], plans("p9")).count() < 30
    with pytest.raises(ValueError, match="no last key"):
        last_key(spark, path, ["1", "9"])


def test_versions_of_old_runs_are_read_only_for_old_events(spark, rows, day_one):
    root = str(day_one)
    run_day(spark, root, "2025-05-02 02:00:00")
    archive(day_one, "customers", "2025-05-02", "c.ndjson", customer("c1", "P003", status="left"))
    archive(day_one, "activity_logs", "2025-05-02", "a.ndjson", event("e9", "c1", "2025-05-02 09:00:00"))
    run_day(spark, root, "2025-05-03 02:00:00", dt.date(2025, 5, 2))
    assert dim_customer(spark, root).count() == 4
    assert dim_customer(spark, root, since="20250503T020000").count() == 4
    assert dim_customer(spark, root, since="20250503T020001").filter("NOT is_current").count() == 0
    day = dt.date(2025, 5, 2)
    assert rows(fact_activity(spark, root, None, day, day), "event_id") == [("e1",), ("e9",)]
    # A late event still finds the version that was closed since.
    late = {r["event_id"]: r["customer_sk"] for r in fact_activity(spark, root).collect()}
    assert late["e9"] == late["e1"] is not None


def test_staging_from_a_date_on(spark, rows, day_one):
    root = str(day_one)
    archive(day_one, "activity_logs", "2025-05-02", "a.ndjson", event("e8", "c1", "2025-05-02"))
    standardize(spark, root, "2025-05-03 02:00:00")
    build_staging(spark, root, "2025-05-03 02:00:00", activity_from=dt.date(2025, 5, 2))
    assert rows(spark.read.parquet(f"{root}/staging/activity"), "event_id") == [("e8",)]


def test_evolved_layouts_read_as_one(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    schema = layout("stg_plans")
    write_run(spark.sql("SELECT 'P1' AS plan_id, 1 AS old_column"), path, "1")
    write_run(spark.sql("SELECT 'P2' AS plan_id, 'b' AS plan_name"), path, "2")
    got = read_parquet(spark, path, schema)
    assert got.drop("run_id").schema == schema
    assert rows(got, "plan_id", "plan_name") == [("P1", None), ("P2", "b")]
    other = str(tmp_path / "u")
    write_run(spark.sql("SELECT 'P1' AS plan_id, 1.5D AS monthly_price"), other, "1")
    write_run(spark.sql("SELECT 'P2' AS plan_id, 'Y' AS ROAMING_ENABLED"), other, "2")
    typed = read_evolved(spark, other, schema)
    assert rows(typed.selectExpr("plan_id", "cast(monthly_price AS string)", "roaming_enabled")) == [
        ("P1", "1.50", None), ("P2", None, True),
    ]
    assert read_parquet(spark, str(tmp_path / "none"), schema).count() == 0


def test_last_batches_hold_every_row(spark):
    from dimflow.plans.archived import DAYS
    from dimflow.plans.catalog import SNAPSHOTS

    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    shipments = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    for last in (SNAPSHOTS[-1], DAYS[-1]):
        assert orders.where(orders.o_orderdate >= last).isEmpty()
        assert shipments.where(shipments.l_shipdate >= last).isEmpty()


def test_a_run_shuffles_and_writes_no_more_than_it_must(spark, rows, tmp_path):
    from dimflow.plans import archived

    orders = spark.sql("SELECT id AS o_orderkey, id % 3 + 1 AS o_custkey FROM range(20)")
    lines = spark.sql("""SELECT id AS l_orderkey, 1 AS l_linenumber, id AS l_partkey, id AS l_suppkey, 1D AS l_quantity,
        1D AS l_extendedprice, 0D AS l_discount, 0D AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus,
        CAST(IF(id < 8, '1998-01-01', IF(id < 18, '2000-01-01', NULL)) AS TIMESTAMP_NTZ) AS l_shipdate FROM range(20)""")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.unionAll(lines.limit(1)).write.parquet(f"{tmp_path}/lineitem.parquet")
    made = archived._activity(spark, str(tmp_path))
    days = {r["ingest_date"]: r["count"] for r in made.groupBy("ingest_date").count().collect()}
    assert days == {"1999-01-01": 8, "2002-01-01": 18}

    # Few archive dates: the run's rows are not dealt by date. Known facts: only ids are looked at.
    root = str(tmp_path)
    made.write.partitionBy("ingest_date").json(f"{root}/archive/activity_logs", compression="gzip")
    standardize(spark, root, "2002-01-01 00:00:00")
    clean = spark.read.parquet(f"{root}/clean/activity_logs")
    assert sorted(r["copies"] for r in clean.collect()) == [1] * 10 + [2] * 8
    files = {f for f in map(str, (tmp_path / "clean").rglob("*.parquet"))}
    assert files and all(".zstd." in f for f in files)


def test_a_batch_that_was_loaded_leaves_an_empty_frame(spark, tmp_path):
    path = str(tmp_path)
    first = staged_facts(spark, ("a", "2025-05-01 10:00"), ("b", None))
    append_facts(spark, path, first, "1")
    again = not_in_fact(spark, path, first, ["1"])
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert again.count() == 0 and again.schema == first.schema and "Join" not in plan


def test_few_folders_are_written_without_a_sort(spark, rows, tmp_path):
    spark.sql("SELECT id, IF(id % 3 = 0, NULL, CAST(id % 20 AS string)) AS day FROM range(200)").write.parquet(f"{tmp_path}/in")
    df = spark.read.parquet(f"{tmp_path}/in")
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before, store = spark.conf.get(name), spark._jsparkSession.sharedState().statusStore()

    def written(by, spread):
        """The plan that Spark ran for the write of these folders."""
        write_run(df, f"{tmp_path}/out", f"{spread}", by, spread)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        told = [store.executionsList().apply(i).physicalPlanDescription() for i in range(store.executionsCount())]
        return [plan for plan in told if f"{tmp_path}/out/run_id={spread}" in plan][-1]

    assert "Sort" not in written(["day"], True) and "Sort" not in written(["day"], False)
    assert spark.conf.get(name) == before
    for run in (True, False):  # more folders than are open at once
        assert rows(spark.read.parquet(f"{tmp_path}/out/run_id={run}"), "id", "day") == rows(df.selectExpr("id", "int(day)"))

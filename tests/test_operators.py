"""Operators on small literal frames, against plain Python where the rule is easy to restate."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dimflow.functions.values import normalized_names, snake_case, stamp, with_defaults
from dimflow.operators.align import align_by_name
from dimflow.operators.asof import as_of_join
from dimflow.operators.enrich import with_current_plan, with_plan_attributes, with_plan_key
from dimflow.operators.facts import new_facts, not_loaded, point_in_time_join
from dimflow.operators.heavy import heavy_keys, slot_at, with_heavy
from dimflow.operators.keys import assign_keys, stable_keys
from dimflow.operators.latest import collapse_copies, keep_latest, keep_latest_of_runs
from dimflow.operators.metrics import record_counts, summary_json
from dimflow.operators.plan_dim import appended_plans, current_count, refreshed_plans
from dimflow.operators.quality import labelled, split_records
from dimflow.operators.ranks import ranked
from dimflow.operators.scd2 import scd2_apply, scd2_history
from dimflow.operators.splice import scd2_splice
from dimflow.plans import fixtures as fx
from dimflow.plans.monthly import add_events, monthly_report
from dimflow.plans.reports import plan_usage
from dimflow.plans.standardize import typed
from dimflow.schemas import TRACKED, layout

DAY = [dt.datetime(2025, 1, d) for d in range(1, 29)]


# --- records -----------------------------------------------------------------------------


def test_split_is_an_exact_complement(spark, rows):
    data = [("e1", "c1"), (None, "c1"), ("e2", None), (None, None), ("e1", "c1")]
    df = spark.createDataFrame(data, "event_id string, customer_id string")
    good, bad = split_records(df, ["event_id", "customer_id"])
    assert rows(good) == [("e1", "c1")] * 2
    assert sorted(rows(good) + rows(bad), key=repr) == rows(df)
    reasons = {r["reason"] for r in labelled(df, ["event_id", "customer_id"]).collect()}
    assert reasons == {
        None, "null_keys_[event_id]", "null_keys_[customer_id]", "null_keys_[event_id, customer_id]",
    }


def test_times_parse_or_become_null(spark):
    texts = ["2025-01-02 03:04:05", "2025-01-02T03:04:05.5", "2025-01-02T03:04:05+02:00", "soon", "", None]
    raw = spark.createDataFrame(
        [(str(i), "c", t) for i, t in enumerate(texts)],
        "event_id string, customer_id string, event_timestamp string",
    )
    out = typed(raw, "activity_logs", stamp(DAY[0])).orderBy("event_id")
    assert out.columns == ["event_id", "customer_id", "event_ts", "ingestion_ts"]
    assert [r["event_ts"] for r in out.collect()] == [
        dt.datetime(2025, 1, 2, 3, 4, 5), dt.datetime(2025, 1, 2, 3, 4, 5, 500000),
        dt.datetime(2025, 1, 2, 1, 4, 5), None, None, None,
    ]
    assert {r["ingestion_ts"] for r in out.collect()} == {DAY[0]}


def test_latest_row_and_copies(spark, rows):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), ("b", 0, "m"), ("c", 5, None)]
    df = spark.createDataFrame(data, "k string, at int, v string")
    expected = [("a", 2, "z"), ("b", 0, "m"), ("c", 5, None)]
    assert rows(keep_latest(df, ["k"], ["at"])) == expected
    counted = collapse_copies(df, ["k"], ["at"])
    assert rows(counted, "k", "at", "v", "copies") == [(*e, n) for e, n in zip(expected, [3, 2, 1])]


def test_latest_row_is_cut_down_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS at")
    plan = keep_latest(df, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_latest_of_runs_leaves_the_last_run_where_it_is(spark, rows):
    data = [("a", 1, "x", "r1"), ("b", 1, "y", "r1"), ("d", 1, "u", "r1"), ("a", 2, "z", "r2"), ("b", 2, None, "r3"), ("c", 2, "w", "r3")]
    df = spark.createDataFrame(data, "k string, at int, v string, run string")
    assert rows(keep_latest_of_runs(df, "k", "run", ["at"])) == rows(keep_latest(df, ["k"], ["at"]))
    assert rows(keep_latest_of_runs(df.limit(0), "k", "run", ["at"])) == []


def test_rows_of_the_last_run_are_not_sorted(spark, rows, tmp_path):
    path = str(tmp_path / "clean")
    data = [("a", 1, "r1"), ("b", 1, "r1"), ("a", 2, "r2")]
    spark.createDataFrame(data, "k string, at int, run string").write.partitionBy("run").parquet(path)
    latest = keep_latest_of_runs(spark.read.parquet(path), "k", "run", ["at"])
    assert rows(latest, "k", "at", "run") == [("a", 2, "r2"), ("b", 1, "r1")]
    plan = latest._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    newest = plan.children().apply(0).toString()
    assert "Relation" in newest and "Window" not in newest and "Join" not in newest


def test_activity_is_dealt_by_order_once(spark, rows, tmp_path):
    lines = [(1, 1, "1995-01-01", "N"), (1, 1, "1995-01-02", "R"), (1, 2, "1995-01-01", "A"), (2, 1, "1995-01-01", "A"), (None, 1, "1995-01-01", "A")]
    columns = "l_orderkey bigint, l_linenumber int, l_shipdate string, l_returnflag string"
    others = {c: F.lit(1) for c in ("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_linestatus")}
    items = spark.createDataFrame(lines, columns).withColumns(others)
    items.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 7), (3, 8)], "o_orderkey bigint, o_custkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    found = fx.activity(spark, str(tmp_path))
    assert rows(found, "customer_id", "event_id", "event_type") == [(7, "1-1", "R"), (7, "1-2", "A")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(l_orderkey") == 1 and "l_linenumber" not in plan.split("hashpartitioning(")[1].split(")")[0]


def test_names_and_defaults(spark, rows):
    assert [snake_case(n) for n in ("Customer ID", "customerId", "HTTPCode", " plan-name ")] == [
        "customer_id", "customer_id", "http_code", "plan_name",
    ]
    df = spark.createDataFrame([(1, None)], "`Customer ID` int, isActive boolean")
    named = normalized_names(df)
    assert named.columns == ["customer_id", "is_active"]
    assert rows(with_defaults(named, {"is_active": True, "level": 3})) == [(1, True, 3)]
    with pytest.raises(ValueError):
        normalized_names(spark.createDataFrame([(1, 2)], "aB int, a_b int"))


def test_align_by_name(spark, rows):
    data = [("P1", "10.005", "Y", 1), ("P2", "x", "N", 1), ("P3", None, "maybe", 1)]
    df = spark.createDataFrame(data, "PLAN_ID string, Monthly_Price string, roaming_enabled string, z int")
    out = align_by_name(df, layout("stg_plans"))
    assert out.schema == layout("stg_plans")
    got = out.select("plan_id", F.col("monthly_price").cast("string"), "roaming_enabled", "plan_name")
    assert rows(got) == [("P1", "10.01", True, None), ("P2", None, False, None), ("P3", None, None, None)]
    with pytest.raises(ValueError):
        spark.conf.set("spark.sql.caseSensitive", "true")
        try:
            align_by_name(spark.createDataFrame([(1, 2)], "a int, A int"), layout("stg_plans"))
        finally:
            spark.conf.unset("spark.sql.caseSensitive")


# --- enrichment --------------------------------------------------------------------------


def test_enrichment_keeps_every_customer_once(spark, rows):
    fields = "customer_id string, first_name string, last_name string, email string, phone string, country string, status string, plan_id string, ingestion_ts timestamp_ntz"
    customers = spark.createDataFrame(
        [(c, "f", "l", "e", "p", "x", "s", plan, DAY[0]) for c, plan in (("c1", "P1"), ("c2", "P9"), ("c3", None))],
        fields,
    )
    plans = spark.createDataFrame(
        [("P1", "new", "Basic", 2.0, DAY[1]), ("P1", "old", "Basic", 1.0, DAY[0]), (None, "none", "x", 0.0, DAY[0])],
        "plan_id string, plan_name string, plan_category string, monthly_price double, ingestion_ts timestamp_ntz",
    )
    latest = keep_latest(plans, ["plan_id"], ["ingestion_ts"])
    out = with_plan_attributes(customers, latest)
    assert len(out.columns) == 12
    assert rows(out, "customer_id", "plan_name", "monthly_price") == [
        ("c1", "new", 2.0), ("c2", None, None), ("c3", None, None),
    ]
    keyed = with_plan_key(customers, spark.createDataFrame([("P1", 7)], "plan_id string, plan_sk long"))
    assert rows(keyed, "customer_id", "plan_sk") == [("c1", 7), ("c2", None), ("c3", None)]
    activity = spark.createDataFrame([("e1", "c1"), ("e2", "c9")], "event_id string, customer_id string")
    assert rows(with_current_plan(activity, customers), "event_id", "plan_id") == [("e1", "P1"), ("e2", None)]


# --- keys --------------------------------------------------------------------------------


def test_keys_are_dense_unique_and_stable(spark):
    first = spark.range(500).selectExpr("cast(id AS string) AS k")
    known = assign_keys(first, ["k"], "sk")
    values = {r["k"]: r["sk"] for r in known.collect()}
    assert sorted(values.values()) == list(range(1, 501))
    again = {r["k"]: r["sk"] for r in assign_keys(first.repartition(3), ["k"], "sk").collect()}
    assert again == values
    more = spark.range(250, 800).selectExpr("cast(id AS string) AS k")
    grown = {r["k"]: r["sk"] for r in stable_keys(more, known, ["k"], "sk").collect()}
    assert len(grown) == 550
    assert all(grown[k] == values[k] for k in grown.keys() & values.keys())
    assert sorted(v for k, v in grown.items() if k not in values) == list(range(501, 801))


def test_keys_of_nothing(spark):
    none = spark.range(0).selectExpr("cast(id AS string) AS k")
    assert assign_keys(none, ["k"], "sk").count() == 0


# --- customer dimension ------------------------------------------------------------------

DIM = "customer_sk long, customer_id string, first_name string, last_name string, email string, phone string, country string, status string, plan_sk long, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz, is_current boolean, ingestion_ts timestamp_ntz"
SNAP = "customer_id string, first_name string, last_name string, email string, phone string, country string, status string, plan_sk long, ingestion_ts timestamp_ntz"


def person(key, email="e", status="s", plan=1, name="n", at=DAY[0]):
    return (key, name, "l", email, "p", "x", status, plan, at)


def version(key, **kwargs):
    p = person(key, **kwargs)
    return (100, *p[:8], DAY[0], None, True, p[8])


def applied(spark, versions, people, at=DAY[5], **options):
    out = scd2_apply(
        spark.createDataFrame(versions, DIM), spark.createDataFrame(people, SNAP),
        "customer_id", TRACKED, stamp(at), **options,
    )
    found = {}
    for r in out.collect():
        found.setdefault(r["customer_id"], {})[r["change"]] = r
    return found


def test_scd2_cases(spark):
    versions = [
        version("same"), version("email"), version("blank", email=None), version("plan", plan=None),
        version("name"), version("absent"), version("noplan", plan=None),
    ]
    people = [
        person("same"), person("email", email="new"), person("blank", email=""), person("plan", plan=3),
        person("name", name="other"), person("new"), person("noplan", plan=-1),
    ]
    found = applied(spark, versions, people)
    changes = {k: sorted(v) for k, v in found.items()}
    assert changes == {
        "same": ["kept"], "email": ["closed", "opened"], "blank": ["kept"], "plan": ["closed", "opened"],
        "name": ["kept"], "absent": ["kept"], "new": ["opened"], "noplan": ["kept"],
    }
    closed, opened = found["email"]["closed"], found["email"]["opened"]
    assert (closed["effective_end_date"], closed["is_current"], closed["customer_sk"]) == (DAY[5], False, 100)
    assert closed["email"] == "e" and opened["email"] == "new"
    assert (opened["effective_start_date"], opened["effective_end_date"], opened["is_current"]) == (DAY[5], None, True)
    assert opened["customer_sk"] is None and found["name"]["kept"]["first_name"] == "n"
    assert found["absent"]["kept"]["is_current"]


def test_scd2_first_start_and_one_step(spark):
    people = [person("new", at=DAY[2]), person("email", email="x")]
    early = applied(spark, [version("email")], people, first_start=F.col("ingestion_ts"))
    assert early["new"]["opened"]["effective_start_date"] == DAY[2]
    assert early["email"]["opened"]["effective_start_date"] == DAY[5]
    one = applied(spark, [version("email")], people, reopen_same_run=False)
    assert sorted(one["email"]) == ["closed"] and sorted(one["new"]) == ["opened"]
    later = applied(spark, [version("other")], people, at=DAY[6], reopen_same_run=False)
    assert sorted(later["email"]) == ["opened"]


FEED = "customer_id int, email string, plan string, at timestamp_ntz, seq int"
WATCHED = {"email": "", "plan": ""}


def random_feed(seed):
    dice = random.Random(seed)
    return [
        (dice.randrange(4), dice.choice(["a", "b", "", None]), dice.choice(["p", "q", None]), dice.choice(DAY[:8]), i)
        for i in range(80)
    ]


@pytest.mark.parametrize("many_rows", [1, 3, 15])
def test_history_does_not_depend_on_slots(spark, rows, many_rows):
    feed = spark.createDataFrame(random_feed(5), FEED)
    plain = scd2_history(feed, "customer_id", "at", WATCHED, ["seq"])
    cut = scd2_history(feed, "customer_id", "at", WATCHED, ["seq"], many_rows)
    assert rows(cut, *plain.columns) == rows(plain)


def test_slots_spread_a_heavy_key(spark):
    feed = spark.range(5000).selectExpr(
        "1 AS k", "timestamp_ntz'2025-01-01' + make_interval(0, 0, 0, 0, 0, 0, id) AS at"
    )
    heavy = heavy_keys(feed, "k", "at", 1000)
    sizes = with_heavy(feed, F.col("k"), heavy).groupBy(slot_at(F.col("at"))).count().collect()
    assert len(sizes) == 6 and max(r["count"] for r in sizes) <= 1001
    assert heavy_keys(feed, "k", "at", 5000) is None


@pytest.mark.parametrize("seed", range(2))
def test_bulk_history_equals_batches_applied_in_turn(spark, rows, seed):
    feed = spark.createDataFrame(random_feed(seed), FEED)
    bulk = scd2_history(feed, "customer_id", "at", WATCHED, ["seq"])
    columns = ["customer_id", "email", "plan", "seq", "effective_start_date", "effective_end_date", "is_current"]
    state, closed = spark.createDataFrame([], bulk.select(columns).schema), []
    for at in DAY[:8]:
        batch = keep_latest(feed.filter(F.col("at") == F.lit(at)), ["customer_id"], ["seq"])
        out = scd2_apply(state, batch.drop("at"), "customer_id", WATCHED, stamp(at))
        done = out.select(columns).collect()
        closed += [r for r in done if not r["is_current"]]
        state = spark.createDataFrame([r for r in done if r["is_current"]], bulk.select(columns).schema)
    assert rows(bulk, *columns) == sorted((tuple(r) for r in closed + state.collect()), key=repr)


def test_history_is_gapless_with_one_open_version(spark):
    history = scd2_history(spark.createDataFrame(random_feed(9), FEED), "customer_id", "at", WATCHED, ["seq"])
    by_key = {}
    for r in history.orderBy("effective_start_date").collect():
        by_key.setdefault(r["customer_id"], []).append(r)
    for versions in by_key.values():
        assert [v["is_current"] for v in versions] == [False] * (len(versions) - 1) + [True]
        for a, b in zip(versions, versions[1:]):
            assert a["effective_end_date"] == b["effective_start_date"]


def test_history_holds_one_row_per_batch_however_hot_the_key(spark):
    feed = spark.range(20000).selectExpr(
        "1 AS customer_id", "cast(id % 7 AS string) AS email", "'p' AS plan",
        "timestamp_ntz'2025-01-01' + make_interval(0, 0, 0, cast(id % 5 AS int)) AS at", "cast(id AS int) AS seq",
    )
    assert scd2_history(feed, "customer_id", "at", WATCHED, ["seq"]).count() <= 5


# --- facts -------------------------------------------------------------------------------

VERSIONS = "customer_id int, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz, sk int"


def test_interval_join_edges(spark, rows):
    versions = spark.createDataFrame([(1, DAY[2], DAY[4], 10), (1, DAY[4], None, 11)], VERSIONS)
    times = [DAY[1], DAY[2], DAY[3], DAY[4], DAY[20], None, dt.datetime(9999, 12, 31)]
    facts = spark.createDataFrame([(i, 1, t) for i, t in enumerate(times)] + [(9, 2, DAY[3])], "id int, customer_id int, at timestamp_ntz")
    for many in (0, 1, 64):
        out = point_in_time_join(facts, versions, "customer_id", "at", ["sk"], many)
        assert rows(out, "id", "sk") == [(0, None), (1, 10), (2, 10), (3, 11), (4, 11), (5, None), (6, None), (9, None)]


@pytest.mark.parametrize("many", [10, 100, 1000])
def test_split_keys_give_the_same_join(spark, rows, many):
    """Hot keys, overlaps, gaps, empty and reversed intervals, several open versions."""
    dice = random.Random(4)

    def moment():
        return dt.datetime(2020, 1, 1) + dt.timedelta(hours=dice.randrange(24 * 400))

    versions = []
    for key, n in ((1, 150), (2, 80), (3, 3)):
        for i in range(n):
            start, end = moment(), moment()
            versions.append((key, start, None if dice.random() < 0.03 else end, len(versions)))
    facts = [(i, dice.choice([1, 1, 2, 3, 4]), moment() if dice.random() < 0.97 else None) for i in range(400)]
    expected = []
    for i, key, at in facts:
        hits = [
            sk for k, start, end, sk in versions
            if k == key and at is not None and start <= at < (end or dt.datetime(9999, 12, 31))
        ]
        expected += [(i, sk) for sk in hits] or [(i, None)]
    out = point_in_time_join(
        spark.createDataFrame(facts, "id int, customer_id int, at timestamp_ntz"),
        spark.createDataFrame(versions, VERSIONS), "customer_id", "at", ["sk"], many,
    )
    assert rows(out, "id", "sk") == sorted(expected, key=repr)


STAGED = "event_id string, customer_id string, event_type string, event_timestamp timestamp_ntz, device_type string, network_type string, ingestion_ts timestamp_ntz"


def staged(spark, ids):
    return spark.createDataFrame([(i, "c", "t", DAY[3], "d", "n", DAY[9]) for i in ids], STAGED)


def test_fact_load_is_idempotent(spark, rows):
    dim = spark.createDataFrame([version("c", plan=4)], DIM)
    first = new_facts(staged(spark, ["a", "b"]), dim, None)
    assert first.columns == layout("fact_activity").names
    assert rows(first, "event_id", "customer_sk", "plan_sk") == [("a", 100, 4), ("b", 100, 4)]
    assert new_facts(staged(spark, ["a", "b"]), dim, first).count() == 0
    assert rows(new_facts(staged(spark, ["a", "b", "c"]), dim, first), "event_id") == [("c",)]
    unnamed = staged(spark, [None])
    assert not_loaded(unnamed, unnamed).count() == 1


# --- plan dimension, metrics, reports ----------------------------------------------------


def stg_plans(spark, ids):
    data = [(i, "Premium Plan 1", "Premium", 2212.81, 20, 300, 100, "Y", 365, DAY[0]) for i in ids]
    names = layout("stg_plans").names
    return align_by_name(spark.createDataFrame(data, names), layout("stg_plans"))


def test_plan_dimension_keeps_keys(spark):
    first = refreshed_plans(stg_plans(spark, ["P001", "P003"]), None, stamp(DAY[0]))
    assert first.schema.names == layout("dim_plan").names
    keys = {r["plan_id"]: r["plan_sk"] for r in first.collect()}
    second = refreshed_plans(stg_plans(spark, ["P003", "P004"]), first, stamp(DAY[1]))
    after = {r["plan_id"]: r for r in second.collect()}
    assert after["P003"]["plan_sk"] == keys["P003"] and after["P004"]["plan_sk"] == 3
    assert set(after) == {"P003", "P004"} and after["P003"]["updated_at"] == DAY[1]
    assert after["P003"]["is_active"] is True
    both = appended_plans(stg_plans(spark, ["P003"]), first, stamp(DAY[1]))
    assert sorted(r["plan_sk"] for r in both.collect()) == [1, 2, 3]


def test_counts_add_up(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    good, bad = split_records(df, ["k"])
    counts = record_counts(collapse_copies(good, ["k"], []), bad, "d")
    assert tuple(counts.first()) == ("d", 4, 2, 1, 1)
    nothing = df.filter("false")
    assert tuple(record_counts(collapse_copies(nothing, ["k"], []), nothing, "d").first()) == ("d", 0, 0, 0, 0)
    text = summary_json(counts, "job", stamp(DAY[0])).first()["summary"]
    assert '"d":{"total":4,"good":2,"bad":1,"duplicates":1}' in text and "2025-01-01T00:00:00" in text
    assert current_count(spark.createDataFrame([version("c")], DIM)).first()[0] == 1


def test_usage_rank_equals_a_global_rank(spark):
    dice = random.Random(1)
    data = [(p, c) for p in range(40) for c in range(dice.choice([1, 2, 3, 3, 8, 9, 15, 16, 40]))]
    out = plan_usage(spark.createDataFrame(data, "plan_sk int, customer_id int")).collect()
    counts = [r["events"] for r in out]
    assert all(r["usage_rank"] == 1 + sum(n > r["events"] for n in counts) for r in out)


@pytest.mark.parametrize("seed", range(3))
def test_as_of_join_equals_the_interval_join(spark, rows, seed):
    """With a key that fills most ranges, keys without versions, gaps, and open and empty versions."""
    r = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    minute = lambda n: start + dt.timedelta(minutes=n)
    versions, facts = [], [(None, minute(3), -1), ("hot", None, -2), ("nobody", minute(1), -3)]
    for key in ("hot", "a", "b", "c"):
        times = sorted(r.sample(range(4000), 900 if key == "hot" else 5))
        for i, (begin, end) in enumerate(zip(times, [*times[1:], None])):
            end = end if r.random() < 0.8 or end is None else max(begin, end - 3)
            versions.append((key, minute(begin), end and minute(end), f"{key}{i}"))
    versions += [("d", minute(5), minute(5), "empty"), ("e", None, None, "no start"), (None, minute(1), None, "no key")]
    for i in range(4000):
        key = "hot" if r.random() < 0.7 else r.choice("abcdef")
        facts.append((key, minute(r.randrange(-50, 4100)), i))
    left = spark.createDataFrame(facts, "k string, at timestamp_ntz, n int").repartition(5)
    right = spark.createDataFrame(
        versions, "k string, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz, v string"
    ).repartition(3)
    merged = as_of_join(left, right, "k", "at", ["v"])
    assert rows(merged) == rows(point_in_time_join(left, right, "k", "at", ["v"]))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    assert rows(as_of_join(left, right.filter("false"), "k", "at", ["v"])) == rows(left.selectExpr("*", "cast(null as string)"))
    assert as_of_join(left.filter("false"), right, "k", "at", ["v"]).count() == 0


def test_late_batches_give_the_bulk_history(spark, rows):
    """Late rows before, between, at and after the others, that split, join and repeat versions."""
    columns = "k string, ts timestamp_ntz, status string, seq int"
    tracked = {"status": ""}
    r = random.Random(12)
    for _ in range(3):
        feed = [(r.choice("abc"), dt.datetime(2024, 1, 1 + r.randrange(20)), r.choice(["x", "y", None]), i) for i in range(50)]
        feed += [("only late", dt.datetime(2024, 1, 3), "x", 99), (None, dt.datetime(2024, 1, 3), "x", 98), ("a", None, "x", 97)]
        late = [row for row in feed if row[0] in ("a", "only late") and r.random() < 0.4 or row[3] == 99]
        early = spark.createDataFrame([row for row in feed if row not in late], columns)
        history = scd2_history(early.filter("k is not null"), "k", "ts", tracked, ["seq"])
        spliced = scd2_splice(history, early, spark.createDataFrame(late, columns), "k", "ts", tracked, ["seq"])
        bulk = scd2_history(spark.createDataFrame(feed, columns).filter("k is not null"), "k", "ts", tracked, ["seq"])
        told = ("k", "status", "seq", "effective_start_date", "effective_end_date", "is_current")
        assert rows(spliced, *told) == rows(bulk, *told)


def test_ranks_over_many_values(spark, rows):
    values = [random.Random(3).randrange(400) for _ in range(2000)] + [None, None, 7, 7]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int")
    some = [v for v in values if v is not None]
    want = [(i, v, 1 + (len(some) if v is None else sum(x > v for x in some))) for i, v in enumerate(values)]
    assert rows(ranked(frame, "v", "r")) == sorted(want, key=repr)
    assert ranked(frame.filter("false"), "v", "r").count() == 0


def test_monthly_counts_are_kept_by_run(spark, rows, tmp_path):
    path = str(tmp_path / "monthly")
    schema = "customer_id string, event_timestamp timestamp_ntz"
    load = lambda *days: spark.createDataFrame([("c", dt.datetime(2024, m, d)) for m, d in days] + [("c", None)], schema)
    assert add_events(spark, path, "1", load((1, 1), (1, 9), (2, 1))) == ["2024-01", "2024-02"]
    assert add_events(spark, path, "2", load((1, 2), (3, 1))) == ["2024-01", "2024-03"]
    assert add_events(spark, path, "2", load((1, 2), (3, 1))) == ["2024-01", "2024-03"]  # repeated
    key_type = spark.createDataFrame([], schema).schema["customer_id"].dataType
    told = rows(monthly_report(spark, path, key_type), "month", "events", "change")
    assert told == [(dt.datetime(2024, 1, 1), 3, None), (dt.datetime(2024, 2, 1), 1, -2), (dt.datetime(2024, 3, 1), 1, 0)]
    assert not (tmp_path / "monthly/counts/run_id=2/month_of=2024-02").exists()  # not counted again


@pytest.mark.parametrize("singles", [0, 3, 40])
def test_rows_without_copies_stay_where_they_are(spark, rows, singles):
    from dimflow.operators.latest import collapse_few_copies

    alone = [(f"s{i}", i, 1, "x") for i in range(singles)]
    df = spark.createDataFrame([*alone, (None, 1, 2, "a"), (None, 1, 3, "b"), ("k", None, 1, "c")], "k string, n int, at int, v string")
    assert rows(collapse_few_copies(df, ["k", "n"], ["at"])) == rows(collapse_copies(df, ["k", "n"], ["at"]))
    got = collapse_few_copies(df.filter("v <> 'a'"), ["k", "n"], ["at"])
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.filter("copies = 1").count() == singles + 2


@pytest.mark.parametrize("sorted_rows", [500, 4])
def test_many_copies_are_dealt_before_they_are_sorted(spark, rows, tmp_path, sorted_rows):
    from dimflow.operators.latest import collapse_few_copies

    one = [(None, 1, i, "x") for i in range(9)] + [(f"k{i % 20}", None, i % 3, f"v{i}") for i in range(50)]
    spark.createDataFrame(one, "k string, n int, at int, v string").write.parquet(f"{tmp_path}/in")
    df = spark.read.parquet(f"{tmp_path}/in")
    got = collapse_few_copies(df, ["k", "n"], ["at"], sorted_rows)
    assert rows(got) == rows(collapse_copies(df, ["k", "n"], ["at"]))
    # No split is sorted before its rows are dealt, but for keys that are too much for a task.
    below = got._jdf.queryExecution().executedPlan().toString().split("REPARTITION_BY_NUM")
    assert len(below) == 2 and "Sort" not in below[1].split("+- SortAggregate")[0]
    assert ("ENSURE_REQUIREMENTS" in below[1]) == (sorted_rows == 4)

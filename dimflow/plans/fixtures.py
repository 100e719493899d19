"""The test tables in the shapes the operators work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.functions.values import stamp
from dimflow.operators.align import align_by_name
from dimflow.operators.latest import keep_latest
from dimflow.schemas import layout

RUN_TS = "2002-01-01 00:00:00"
TRACKED = {"status": "", "plan_id": ""}
ACTIVITY_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed: every order tells status and plan of its customer at that time."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("plan_id"),
        F.col("o_orderdate").alias("ingestion_ts"),
        F.col("o_orderkey").alias("feed_seq"),
    )


def latest_orders(feed: DataFrame) -> DataFrame:
    return keep_latest(feed, ["customer_id"], ["ingestion_ts", "feed_seq"])


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state per customer with name, phone and country."""
    attributes = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("phone"),
            F.col("n_name").alias("country"),
        )
    )
    return latest_orders(order_feed(spark, sf_dir)).join(attributes, "customer_id")


def customers_with_odd_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``customers``, some without a plan and some with a plan nobody knows."""
    odd = (
        F.when(F.col("customer_id") % 23 == 0, F.lit(None))
        .when(F.col("customer_id") % 29 == 0, "9-UNKNOWN")
        .otherwise(F.col("plan_id"))
    )
    nothing = F.lit(None).cast("string")
    return customers(spark, sf_dir).withColumns(
        {"plan_id": odd, "last_name": nothing, "email": nothing}
    )


def plan_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order states the price of its plan at that time."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("plan_id"),
        F.col("o_totalprice").alias("monthly_price"),
        F.col("o_orderdate").alias("ingestion_ts"),
        F.col("o_orderkey").alias("feed_seq"),
    )


def plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = keep_latest(plan_feed(spark, sf_dir), ["plan_id"], ["ingestion_ts", "feed_seq"])
    return latest.select(
        "plan_id",
        F.concat(F.lit("Plan "), F.expr("substring(plan_id, 3)")).alias("plan_name"),
        F.when(F.substring("plan_id", 1, 1) <= "2", "Premium")
        .otherwise("Basic")
        .alias("plan_category"),
        "monthly_price",
    )


def network_type(supplier: Column) -> Column:
    return F.element_at(F.array(F.lit("4G"), F.lit("5G"), F.lit("WIFI")), (supplier % 3 + 1).cast("int"))


def raw_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped lines as activity; order and line number together are the event id."""
    return table(spark, sf_dir, "lineitem")


def unique_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(raw_shipments(spark, sf_dir), ["l_orderkey", "l_linenumber"], ACTIVITY_ORDER)


def activity_columns(shipments: DataFrame) -> list[Column]:
    return [
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        F.col("l_returnflag").alias("event_type"),
        F.col("l_shipdate").alias("event_timestamp"),
        F.col("l_linestatus").alias("device_type"),
        network_type(F.col("l_suppkey")).alias("network_type"),
    ]


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique shipments with their customer.

    Lines are dealt by order once, for their copies and for the join. Cutting them down before the shuffle, as for
    ``unique_shipments``, would sort whole splits of them, which spills, and shuffle what is left of them again.
    """
    owners = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    dealt = raw_shipments(spark, sf_dir).filter("l_orderkey IS NOT NULL").repartition("l_orderkey")
    shipped = keep_latest(dealt, ["l_orderkey", "l_linenumber"], ACTIVITY_ORDER)
    return shipped.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("customer_id"), *activity_columns(shipped)
    )


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("customer_id"),
        "event_type",
        F.col("ts").alias("event_timestamp"),
        F.col("props").alias("payload"),
    )


def part_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a plan catalogue that grows with the data, in staged text and number types."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("plan_id"),
        F.col("p_name").alias("plan_name"),
        F.col("p_type").alias("plan_category"),
        F.col("p_retailprice").alias("monthly_price"),
        F.col("p_size").alias("data_allowance_gb"),
        (F.col("p_size") * 100).alias("voice_minutes"),
        (F.col("p_size") * 10).alias("sms_allowance"),
        F.when(F.col("p_partkey") % 2 == 0, "Y").otherwise("N").alias("roaming_enabled"),
        F.lit(30).alias("validity_days"),
        stamp(RUN_TS).alias("ingestion_ts"),
    )


def staged_part_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_by_name(part_plans(spark, sf_dir), layout("stg_plans"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document: ``doc_id``, number from 0, number of lines, text."""
    split = table(spark, sf_dir, "documents").select(
        "doc_id", F.split("text", "\n").alias("_lines")
    )
    return split.select(
        "doc_id",
        F.size("_lines").alias("n_lines"),
        F.posexplode("_lines").alias("line_no", "text"),
    )


def _as_json(text: Column) -> Column:
    """``"text":"..."`` with the text escaped."""
    document = F.to_json(F.struct(text.alias("text")))
    return F.substring(document, F.lit(2), F.length(document) - 2)


def _numbered(row: str) -> Column:
    return F.struct(F.lit(0).alias("start"), F.col(row).alias("row")).alias("line_no")


def ndjson_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as NDJSON files, one line per text line, in thirteen sound or broken forms."""
    lines = document_lines(spark, sf_dir)
    form = F.col("doc_id") % 13
    event = F.concat(F.lit('"event_id":"e'), "line_no", F.lit('"'))
    customer = F.concat(F.lit('"customer_id":"c'), "doc_id", F.lit('"'))
    text = _as_json(F.col("text"))

    def members(*parts: Column) -> Column:
        return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))

    sound = members(event, customer, text)
    quoted = F.substring(text, F.lit(8), F.length(text))
    value = (
        F.when((form == 2) & (F.col("line_no") == F.col("n_lines") - 1), '{"event_id":"e')
        .when(form == 3, " \t ")
        .when(form == 4, members(text))
        .when(form == 5, F.when(F.col("line_no") % 2 == 0, members(event, text)).otherwise(
            members(customer, text)))
        .when(form == 6, F.lit('{"event_id":null,"customer_id":null}'))
        .when(form == 7, F.concat(F.lit("["), quoted, F.lit("]")))
        .when(form == 8, F.col("line_no").cast("string"))
        .when(form == 11, F.concat(sound, F.lit(" x")))
        .when(form == 12, quoted)
        .otherwise(sound)
    )
    folder = (
        F.when(form == 9, "raw/other")
        .when(form == 10, "landing/customers")
        .when(F.col("doc_id") % 2 == 0, "raw/customers")
        .otherwise("raw/activity_logs")
    )
    key = F.concat(folder, F.lit("/doc-"), F.col("doc_id").cast("string"), F.lit(".ndjson"))
    return lines.select(key.alias("uri"), _numbered("line_no"), value.alias("value"))


def csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as plan CSV files: a header in six forms, then a row per text line."""
    lines = document_lines(spark, sf_dir)
    form = F.col("doc_id") % 6
    header = (
        F.when(form == 1, "id,plan_name,monthly_price")
        .when(form == 2, '"plan_id","name, long",monthly_price')
        .when(form == 3, "")
        .when(form == 4, "plan_name,monthly_price,plan_id")
        .otherwise("plan_id,plan_name,monthly_price")
    )
    cell = F.replace(F.col("text"), F.lit('"'), F.lit('""'))
    row = F.concat(F.lit('P1,"'), cell, F.lit('",1.5'))
    value = F.when((form == 5) & (F.col("line_no") > 0), "").otherwise(row)
    key = F.concat(F.lit("raw/plans/doc-"), F.col("doc_id").cast("string"), F.lit(".csv"))
    both = F.when(
        F.col("line_no") == 0,
        F.array(F.struct(F.lit(-1).alias("n"), header.alias("v")),
                F.struct(F.lit(0).alias("n"), value.alias("v"))),
    ).otherwise(F.array(F.struct(F.col("line_no").alias("n"), value.alias("v"))))
    return lines.select(key.alias("uri"), F.inline(both)).select(
        "uri", _numbered("n"), F.col("v").alias("value")
    )


def csv_files_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as plan CSV files of up to four rows: whole texts are quoted cells over many lines, and
    an unquoted cell holds a quote. Every five lines are a split."""
    number = F.col("doc_id")
    cell = F.replace(F.col("text"), F.lit('"'), F.lit('""'))
    rows = F.array_repeat(F.concat(F.lit('P1,"'), cell, F.lit('",1.5')), (number % 4).cast("int"))
    odd = F.when(number % 3 == 2, F.array(F.lit('P0,5" pipe,1'))).otherwise(F.array().cast("array<string>"))
    content = F.concat(F.array(F.lit("plan_id,plan_name,monthly_price")), odd, rows)
    key = F.concat(F.lit("raw/plans/doc-"), number.cast("string"), F.lit(".csv"))
    texts = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    lines = texts.select(
        key.alias("uri"), F.posexplode(F.split(F.array_join(content, "\n"), "\n")).alias("n", "value")
    )
    place = F.struct((F.floor(F.col("n") / 5) * 100).cast("bigint").alias("start"), F.col("n").alias("row"))
    return lines.select("uri", place.alias("line_no"), "value")


def listing(lines: DataFrame) -> DataFrame:
    """Files of a frame of lines with their length in bytes."""
    return lines.groupBy("uri").agg(F.sum(F.octet_length("value") + 1).alias("length"))

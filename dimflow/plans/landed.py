"""The test tables as files that land in two deliveries, for queries through the whole intake."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.plans import fixtures as fx
from dimflow.sources.files import Files
from dimflow.sources.readers import or_empty
from dimflow.streaming.intake import take_in_new

DAY = "2002-01-01"
#: Documents of a source that share a file.
DOCS_A_FILE = 2000
#: 2000-01-01, long before the first delivery: a file's time does not tell whether it is new.
OLD = 946_684_800_000
#: Folder and ending of a source's files, by its number modulo 7.
FOLDERS = ("customers", "activity_logs", "plans", "customers", "other", "activity_logs", "customers")
ENDINGS = ("ndjson", "ndjson", "csv", "ndjson", "txt", "ndjson", "ndjson.gz")
AGAIN = (0, 1, 3)


def _pick(form: Column, values) -> Column:
    return F.get(F.array(*map(F.lit, values)), form)


def delivery(spark: SparkSession, sf_dir: str, second: bool) -> DataFrame:
    """``folder, file, doc_id, line_no, value``: every line of every document in one of seven forms, by its
    source. The second delivery has some of the keys again, with every other document and forms swapped."""
    sources = fx.table(spark, sf_dir, "documents").select("doc_id", "source")
    number = F.coalesce(F.regexp_extract("source", r"^src(\d{1,6})$", 1).try_cast("int"), F.lit(4))
    lines = fx.document_lines(spark, sf_dir).join(sources, "doc_id").withColumn("form", number % 7)
    name = F.concat_ws("-", F.coalesce("source", F.lit("none")), F.floor(F.col("doc_id") / DOCS_A_FILE))
    lines = lines.select(
        _pick(F.col("form"), FOLDERS).alias("folder"), F.concat_ws(".", name, _pick(F.col("form"), ENDINGS)).alias("file"),
        "doc_id", "line_no", "form",
    )
    written = F.col("form")
    if second:
        lines = lines.where(F.col("form").isin(*AGAIN) & (F.col("doc_id") % 2 == 0))
        written = F.when(written == 0, 3).when(written == 3, 0).otherwise(written)
    at = F.concat_ws("-", "doc_id", "line_no")
    text = lambda before, after: F.concat(F.lit(before), at, F.lit(after))
    value = (
        F.when(written <= 1, F.concat(text('{"event_id":"e', '","customer_id":"c'), F.col("doc_id"), F.lit('"}')))
        .when(written == 2, text("P", ',"a, b"'))
        .when(written == 3, text('{"id":"', '"}'))
        .when(written == 5, text('{"event_id":"', '"'))
        .otherwise(text("line ", ""))
    )
    rows = lines.select("folder", "file", "doc_id", "line_no", value.alias("value"))
    headers = rows.where("folder = 'plans'").select("folder", "file").distinct().select(
        "folder", "file", F.lit(-1).cast("long").alias("doc_id"), F.lit(0).alias("line_no"), F.lit("plan_id,plan_name").alias("value")
    )
    return rows.unionByName(headers)


def land(spark: SparkSession, lines: DataFrame, root: str, number: int) -> None:
    """Write a delivery, one file for each name, and put it below ``raw/``."""
    written = f"{root}/landing/{number}"
    files = lines.repartition("folder", "file").sortWithinPartitions("folder", "file", "doc_id", "line_no")
    files.select("value", "folder", "file").write.partitionBy("folder", "file").text(written)
    store = Files(spark, root)
    below = [path[path.index(f"landing/{number}/") :] for path in spark.read.text(written).inputFiles()]
    named = [re.search("folder=([^/]+)/file=([^/]+)/", path).groups() for path in below]
    places = [f"raw/{folder}/{file}" for folder, file in named]
    store.move_all(zip(below, places))
    if number > 1:
        store.set_all_modified(places, OLD)


def taken_in(spark: SparkSession, sf_dir: str, root: str) -> list[str]:
    """Both deliveries through the intake, on one day; returns the batches."""
    batches = []
    for number in (1, 2):
        land(spark, delivery(spark, sf_dir, number == 2), root, number)
        batches += take_in_new(spark, root, f"{root}/state", DAY)
    return batches


def manifests(spark: SparkSession, root: str, batches: list[str]) -> DataFrame:
    """All verdicts, with the number of the delivery."""
    told = spark.read.parquet(f"{root}/manifest")
    number = F.array_position(F.array(*map(F.lit, batches)), F.col("run_id"))
    return told.withColumn("delivery", number.cast("int"))


def lines_in_place(spark: SparkSession, root: str, places: DataFrame) -> DataFrame:
    """``moved_to, value``: every line that is read at an announced place."""
    read = spark.read.options(recursiveFileLookup=True, ignoreCorruptFiles=True)
    place = F.regexp_extract(F.col("_metadata.file_path"), ".*/((?:archive|rejected)/.*)$", 1).alias("moved_to")
    # Spark looks into a folder whose name begins with an underscore only if it is named itself.
    zones = ("archive", "rejected", "rejected/_unknown")
    found = [
        or_empty(lambda zone=zone: read.text(f"{root}/{zone}").select(place, "value"), spark, "moved_to string, value string")
        for zone in zones
    ]
    return reduce(DataFrame.unionByName, found).join(places.select("moved_to").distinct(), "moved_to")

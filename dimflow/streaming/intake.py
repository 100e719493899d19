"""Intake of landed files: judge each delivery once, move it to its place, record verdict and alert.

A delivery is a file with its time and length. One batch takes in all that has landed:

1. *Plan*: the deliveries and the day are written to the state folder. From then on the batch is fixed.
2. *Judge*: lines are read once, verdicts and alerts written. The finished manifest is the mark of this step.
3. *Move*: every file goes to the place its verdict names, which empties ``raw/``; then the plan is deleted.

A batch that stopped anywhere is finished by the next call: with its own day, from the step it was in. What
is kept between calls is the plan of a batch under way, however many files were ever delivered.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dimflow.operators.verdicts import alerts, file_facts, first_lines, verdicts
from dimflow.sources.files import Files
from dimflow.sources.readers import (
    is_compressed, landed_files, landed_lines, read_parquet, whole_files,
)
from dimflow.sources.writers import write_run

#: What a delivery is told by.
IDENTITY = ("uri", "modified", "length")
_PLAN = T.StructType([
    T.StructField("uri", T.StringType()), T.StructField("modified", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("day", T.DateType()),
])
_PLACES = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("moved_to", T.StringType()),
    T.StructField("run_id", T.StringType()),
])


def judge_landed(
    spark: SparkSession, root: str, day: dt.date | str, mode: str = "full"
) -> DataFrame:
    """Verdict on every file below ``raw/``; ``mode="sample"`` looks at file starts only."""
    return judged(landed_lines(spark, root), listed(spark, root), F.lit(str(day)).cast("date"), mode)


def listed(spark: SparkSession, root: str) -> DataFrame:
    """``(uri, modified, length, decompressed)``: the files below ``raw/`` and whether a
    compressed one could be read to its end (NULL for others)."""
    whole = whole_files(spark, root).select("uri", F.lit(True).alias("decompressed"))
    files = landed_files(spark, root)
    tried = is_compressed(F.col("uri")) & (F.col("length") > 0)
    return files.join(whole, "uri", "left").withColumn(
        "decompressed", F.when(tried, F.coalesce("decompressed", F.lit(False)))
    )


def judged(lines: DataFrame, files: DataFrame, day, mode: str = "full") -> DataFrame:
    """Verdicts on ``files`` by their ``lines``, with what tells a delivery.

    A file is whole if its lines with their ends (two bytes at most, and a byte order mark) make up
    its length, or if it decompressed to its end. Sample mode does not look that far."""
    sampled = mode == "sample"
    facts = file_facts(first_lines(lines) if sampled else lines)
    if not sampled:
        read = facts.select("uri", (F.col("bytes") + 2 * F.col("lines") + 3).alias("most"))
        enough = F.coalesce(F.col("most"), F.lit(0)) >= F.col("length")
        files = files.join(read, "uri", "left").withColumn("whole", F.coalesce("decompressed", enough))
    told = verdicts(files.drop("decompressed", "most"), facts, day, sampled=sampled)
    return told.join(files.select(*IDENTITY), "uri")


def placed(manifest: DataFrame, taken: DataFrame) -> DataFrame:
    """Give files that would end up in one place (folders below a dataset's are not part of it) places of
    their own: the first key has the plain one, others their key's hash in front of the name.

    ``taken`` has ``(key, moved_to)`` of earlier batches; a key delivered again replaces its own file."""
    held = taken.groupBy(F.col("moved_to").alias("_place")).agg(F.min("key").alias("_holder"))
    first = F.min("key").over(Window.partitionBy("moved_to"))
    named = manifest.join(held, F.col("moved_to") == F.col("_place"), "left").withColumn("_first", first)
    owner = F.coalesce("_holder", "_first")
    apart = F.regexp_replace("moved_to", "([^/]*)$", F.concat(F.substring(F.md5("key"), 1, 8), F.lit("-$1")))
    return named.withColumn(
        "moved_to", F.when(F.col("key") == owner, F.col("moved_to")).otherwise(apart)
    ).select(*manifest.columns)


def _batches(files: Files, folder: str) -> list[str]:
    """Batches with a complete folder of that name."""
    names = files.folders(folder)
    return [n.removeprefix("run_id=") for n in names if files.exists(f"{folder}/{n}/_SUCCESS")]


def plan_batch(spark: SparkSession, root: str, state: str, day: dt.date | str) -> str | None:
    """Fix the next batch: all that has landed. Returns its name, None if there is nothing."""
    files = landed_files(spark, root).withColumn("day", F.lit(str(day)).cast("date"))
    if files.isEmpty():
        return None
    done = [b for b in _batches(Files(spark, root), "manifest") if b.startswith(f"{day}-")]
    batch = f"{day}-{1 + max((int(b.rsplit('-', 1)[1]) for b in done), default=0):06d}"
    write_run(files.select(_PLAN.names), f"{state}/plan", batch)
    return batch


def judge_batch(spark: SparkSession, root: str, state: str, batch: str) -> None:
    """Write manifest and alerts of a planned batch.

    A file that was replaced or taken away since it was listed is left out; it is another delivery."""
    plan = spark.read.schema(_PLAN).parquet(f"{state}/plan/run_id={batch}")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"p.{c}")) for c in IDENTITY]
    files = listed(spark, root).alias("l").join(plan.alias("p"), same).select("l.*")
    day = plan.first()["day"]
    told = judged(landed_lines(spark, root).join(files.select("uri"), "uri", "left_semi"), files, F.lit(day))
    others = [b for b in _batches(Files(spark, root), "manifest") if b.startswith(f"{day}-") and b != batch]
    manifests = read_parquet(spark, f"{root}/manifest", _PLACES).where(F.col("run_id").isin(*others))
    write_run(placed(told, manifests.select("key", "moved_to")), f"{root}/manifest", batch)
    manifest = spark.read.parquet(f"{root}/manifest/run_id={batch}")
    messages = alerts(manifest).select(F.col("message").alias("value"))
    if not messages.isEmpty():
        messages.write.mode("overwrite").text(f"{root}/alerts/run_id={batch}")


def move_batch(spark: SparkSession, root: str, state: str, batch: str) -> None:
    """Move the files of a judged batch, then forget its plan. Only unchanged files are moved."""
    manifest = spark.read.parquet(f"{root}/manifest/run_id={batch}")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"m.{c}")) for c in IDENTITY]
    left = manifest.alias("m").join(landed_files(spark, root).alias("l"), same).select("m.key", "m.moved_to")
    Files(spark, root).move_all((r.key, r.moved_to) for r in left.toLocalIterator())
    Files(spark, state).delete(f"plan/run_id={batch}")


def take_in_new(
    spark: SparkSession, root: str, state: str, day: dt.date | str | None = None
) -> list[str]:
    """Finish a batch under way, then take in everything that has landed; returns the batches' names.

    A key that is delivered again is judged again, whatever its time; on the same day it
    replaces the file it was before, as long as its verdict is the same. One call at a time."""
    files = Files(spark, state)
    for name in files.folders("plan"):
        if not files.exists(f"plan/{name}/_SUCCESS"):
            files.delete(f"plan/{name}")  # stopped while it was listed: nothing was taken in
    batches = _batches(files, "plan")
    finish(spark, root, state, batches)
    new = plan_batch(spark, root, state, day or dt.datetime.now(dt.timezone.utc).date())
    if new:
        finish(spark, root, state, [new])
        batches.append(new)
    return batches


def finish(spark: SparkSession, root: str, state: str, batches: list[str]) -> None:
    """Judge planned batches, unless that is done, and move their files."""
    for batch in batches:
        if batch not in _batches(Files(spark, root), "manifest"):
            judge_batch(spark, root, state, batch)
        move_batch(spark, root, state, batch)


def intake_stream(spark: SparkSession, root: str, state: str, seconds: int = 60) -> StreamingQuery:
    """Take in what has landed again and again, until the query is stopped.

    The stream is a clock. Spark's own stream over files knows them by path alone, so it would never
    look at a key again; the batches above are what makes each delivery count once."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def take(_: DataFrame, __: int) -> None:
        take_in_new(spark, root, state)

    return ticks.writeStream.foreachBatch(take).trigger(processingTime=f"{seconds} seconds").start()

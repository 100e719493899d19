"""Verdicts on landed files: one grouped job over all their lines.

Lines are a frame ``(uri, line_no, value)``: encoded path below the landing root, a struct
``(start, row)`` that orders the lines of a file (start of the split, then place in it), and
the text. Counts are hash aggregates, partial per task before the shuffle, so a file may be as
large as it likes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.functions.csvtext import header_names, opens_inside, opens_outside
from dimflow.functions.jsontext import is_parsed, mentions, stripped
from dimflow.functions.paths import dataset_of, decoded_uri, destination, is_landed
from dimflow.schemas import (
    BAD_NDJSON,
    DATASETS,
    MIN_CSV_ROWS,
    MISSING_COLUMNS,
    MISSING_FIELDS,
    NO_JSON,
    NO_ROWS,
    OK,
    READ_ERROR,
    REQUIRED_KEYS,
    SAMPLE_BYTES,
    SAMPLE_LINES,
    UNKNOWN_FOLDER,
)

CSV_DATASETS = ("plans",)
_ALL_KEYS = list(dict.fromkeys(k for keys in REQUIRED_KEYS.values() for k in keys))


def is_csv() -> Column:
    """Is a line or file of a CSV dataset? Cheap, as it is asked for every line."""
    return reduce(
        lambda x, y: x | y, [F.col("uri").startswith(f"raw/{name}/") for name in CSV_DATASETS]
    )


def first_lines(
    lines: DataFrame, max_lines: int = SAMPLE_LINES, max_bytes: int = SAMPLE_BYTES
) -> DataFrame:
    """The start of each file: at most ``max_lines`` whole lines within ``max_bytes`` bytes.

    A line that the byte limit cuts is left out. Only splits that begin within the limit are
    looked at, and the row limit is applied per map task first, so no group grows beyond
    ``max_lines`` rows.
    """
    in_order = Window.partitionBy("uri").orderBy("line_no")
    starts = lines.filter(F.col("line_no.start") < max_bytes)
    head = starts.withColumn("_n", F.row_number().over(in_order)).filter(F.col("_n") <= max_lines)
    size = F.sum(F.octet_length("value") + 1).over(
        in_order.rowsBetween(Window.unboundedPreceding, 0)
    )
    # The last line of a file needs no line end, hence the one byte of slack.
    return head.withColumn("_bytes", size).filter(F.col("_bytes") <= max_bytes + 1).drop(
        "_n", "_bytes"
    )


def file_facts(lines: DataFrame) -> DataFrame:
    """What the verdict needs to know about each file, one row per file with any line."""
    texts = lines.select(
        "uri",
        (F.col("value") != "").alias("_filled"),
        F.octet_length("value").alias("_bytes"),
        F.when(~is_csv(), stripped(F.col("value"))).alias("_text"),
    )
    parsed = texts.withColumn(
        "_parsed", F.when(F.col("_text") != "", is_parsed(F.col("_text")))
    )
    found = {
        f"has_{k}": F.coalesce(
            F.bool_or(F.when(F.col("_parsed"), mentions(F.col("_text"), k))), F.lit(False)
        )
        for k in _ALL_KEYS
    }
    counts = parsed.groupBy("uri").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("_bytes").alias("bytes"),
        F.count_if(F.col("_filled")).alias("filled"),
        F.count_if(F.col("_parsed")).alias("parsed"),
        F.count_if(~F.col("_parsed")).alias("broken"),
        *[column.alias(name) for name, column in found.items()],
    )
    return counts.join(csv_rows(lines.filter(is_csv())), "uri", "left")


def row_starts(lines: DataFrame) -> DataFrame:
    """Lines of CSV files with ``split``, where their split starts, and ``begins``: does a row begin here, or is the
    line's start within quotes?

    Whether a line ends within quotes depends on how it began: some lines set the state, some turn it
    round, others leave it. So the state at a line is what the last setting line left, turned by the
    lines since. That is taken within each split of a file first; what a split leaves is passed on from
    split to split, one row each, so that no task sees more of a file than a split. All steps name one column
    for the split, so lines are dealt once: of a struct's field Spark makes a new column for each window.
    """
    odd = lambda n: F.pmod(n, F.lit(2)) == 1
    flip = lambda state, n: F.when(odd(n), ~state).otherwise(state)
    judged = lines.withColumn("split", F.col("line_no.start"))
    judged = judged.withColumn("_from_out", opens_outside(F.col("value"))).withColumn("_from_in", opens_inside(F.col("value")))
    sets = F.col("_from_out") == F.col("_from_in")
    in_split = Window.partitionBy("uri", "split").orderBy("line_no")
    so_far = in_split.rowsBetween(Window.unboundedPreceding, 0)
    # The state a setting line leaves, turned back to the split's start: later lines turn it as often as they must.
    turned = judged.withColumn("_turns", F.count_if(F.col("_from_out") & ~F.col("_from_in")).over(so_far))
    turned = turned.withColumn("_set", F.last(F.when(sets, flip(F.col("_from_out"), F.col("_turns"))), True).over(so_far))
    splits = turned.groupBy("uri", "split").agg(
        F.max("_turns").alias("_turns"), F.max_by("_set", "line_no").alias("_set")
    )
    before = Window.partitionBy("uri").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    passed = splits.withColumn("_before", F.coalesce(F.sum("_turns").over(before), F.lit(0)))
    passed = passed.withColumn("_set", flip(F.col("_set"), F.col("_before")))
    entered = passed.select(
        F.col("uri").alias("_uri"), F.col("split").alias("_split"),
        flip(F.coalesce(F.last("_set", True).over(before), F.lit(False)), F.col("_before")).alias("_entered"),
    )
    same = (F.col("uri") == F.col("_uri")) & (F.col("split") == F.col("_split"))
    previous = lambda name: F.lag(name).over(in_split)
    placed = turned.withColumn("_p_turns", F.coalesce(previous("_turns"), F.lit(0))).withColumn("_p_set", previous("_set"))
    inside = flip(F.coalesce("_p_set", "_entered"), F.col("_p_turns"))
    return placed.join(entered, same).select(*lines.columns, "split", (~inside).alias("begins"))


def csv_rows(lines: DataFrame) -> DataFrame:
    """Of each CSV file the header row and the number of filled rows; a quoted cell may span lines.

    The header is looked for in the first ``SAMPLE_LINES`` lines; of one that is longer, that much is taken.
    """
    starts = row_starts(lines)
    rows = starts.groupBy("uri").agg(
        F.count_if(F.col("begins") & (F.col("value") != "")).alias("rows"),
        F.min("line_no").alias("header_no"),
    )
    # All of them are of one split, so this deals no line again.
    order = Window.partitionBy("uri", "split").orderBy("line_no")
    head = starts.filter("split = 0").withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= SAMPLE_LINES)
    numbered = head.withColumn("_row", F.count_if("begins").over(order)).filter("_row = 1")
    headers = numbered.groupBy("uri", "split").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_n", "value"))), lambda x: x["value"]), "\n").alias("header")
    )
    return rows.join(headers.drop("split"), "uri", "left")


def _listed(prefix: str, absent: Column) -> Column:
    return F.concat(F.lit(prefix + "['"), F.array_join(absent, "', '"), F.lit("']"))


def _reason_for(dataset: str, min_rows: int) -> Column:
    required = REQUIRED_KEYS[dataset]
    if dataset in CSV_DATASETS:
        names = F.coalesce(header_names(F.col("header")), F.array().cast("array<string>"))
        absent = F.array_except(F.array(*[F.lit(k) for k in required]), names)
        # The header is one of the filled rows.
        rows = F.coalesce(F.col("rows"), F.lit(0)) - 1
        return (
            F.when(F.size(absent) > 0, _listed(MISSING_COLUMNS, absent))
            .when(rows < min_rows, NO_ROWS)
            .otherwise(OK)
        )
    absent = F.array_compact(F.array(*[F.when(~F.col(f"has_{k}"), F.lit(k)) for k in required]))
    return (
        F.when(F.col("broken") > 0, BAD_NDJSON)
        .when(F.coalesce(F.col("parsed"), F.lit(0)) == 0, NO_JSON)
        .when(F.size(absent) > 0, _listed(MISSING_FIELDS, absent))
        .otherwise(OK)
    )


def verdicts(
    files: DataFrame,
    facts: DataFrame,
    day: Column,
    min_rows: int = MIN_CSV_ROWS,
    sampled: bool = False,
) -> DataFrame:
    """Manifest ``(uri, key, dataset, ok, reason, moved_to, header, header_no)``.

    ``files`` lists ``(uri, length)`` of everything that landed, so a file without a single
    line gets a verdict too. Files outside the landing zone are left out. A file with bytes of
    which no line was read is unreadable, unless only file starts were looked at (``sampled``), and
    so is one that ``files`` says was not read whole (column ``whole``, optional).
    """
    joined = (
        files.filter(is_landed(F.col("uri")))
        .join(facts, "uri", "left")
        .withColumn("key", decoded_uri(F.col("uri")))
        .withColumn("dataset", dataset_of(F.col("key")))
    )
    unread = F.lit(not sampled) & F.col("lines").isNull() & (F.col("length") > 0)
    known = reduce(
        lambda chain, name: chain.when(F.col("dataset") == name, _reason_for(name, min_rows)),
        DATASETS[1:],
        F.when(F.col("dataset") == DATASETS[0], _reason_for(DATASETS[0], min_rows)),
    )
    cut_short = ~F.col("whole") if "whole" in files.columns else F.lit(False)
    reason = (
        F.when(F.col("dataset").isNull(), UNKNOWN_FOLDER)
        .when(unread, F.lit(READ_ERROR + "no_line_read"))
        .when(cut_short, F.lit(READ_ERROR + "incomplete"))
        .otherwise(known)
    )
    judged = joined.withColumn("reason", reason).withColumn("ok", F.col("reason") == OK)
    return judged.select(
        "uri", "key", "dataset", "ok", "reason", routed_to(day).alias("moved_to"),
        "header", "header_no",
    )


def routed_to(day: Column) -> Column:
    """Destination of a file with columns ``key``, ``dataset`` and ``ok``."""
    zone = F.when(F.col("ok"), "archive").otherwise("rejected")
    return destination(zone, F.coalesce(F.col("dataset"), F.lit("_unknown")), day, F.col("key"))


def alerts(manifest: DataFrame) -> DataFrame:
    """One JSON message per rejected file; the destination is told only for judged content."""
    judged = ~F.col("reason").startswith(READ_ERROR) & (F.col("reason") != UNKNOWN_FOLDER)
    message = F.struct(
        F.col("key").alias("file"),
        F.col("reason"),
        F.when(judged, F.col("moved_to")).alias("moved_to"),
    )
    return manifest.filter(~F.col("ok")).select("key", F.to_json(message).alias("message"))

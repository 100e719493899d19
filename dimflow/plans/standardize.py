"""Archive to clean: typed columns, good and bad records apart, one row per key."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.functions.values import parsed_ts, run_id, stamp
from dimflow.operators.latest import collapse_few_copies
from dimflow.operators.metrics import record_counts, summary_json
from dimflow.operators.quality import bad_reason, split_records
from dimflow.schemas import DATASETS, RECORD_KEYS, REQUIRED_KEYS, layout
from dimflow.session import cut_lineage
from dimflow.sources.readers import read_archive
from dimflow.sources.writers import read_runs, write_run

# Text column of each dataset that becomes a timestamp, and the name it gets.
TIMES = {
    "customers": ("registration_date", "registration_ts"),
    "activity_logs": ("event_timestamp", "event_ts"),
}

#: Up to so many archive dates a run's tasks write into all their folders.
FEW_DATES = 4


def clean_layout(dataset: str) -> T.StructType:
    """Columns of a clean table, without those that are in its folder names."""
    fields = [f for f in layout(dataset) if f.name != TIMES.get(dataset, ("",))[0]]
    times = [TIMES[dataset][1]] if dataset in TIMES else []
    stamps = [T.StructField(name, T.TimestampNTZType()) for name in (*times, "ingestion_ts")]
    return T.StructType([*fields, *stamps, T.StructField("copies", T.LongType())])


def read_clean(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """All runs of a clean table, with ``archive_date`` and ``run_id`` from the folder names.

    Every run of ``standardize`` writes all tables, so a folder that is not there is an error.
    """
    located = [*clean_layout(dataset).fields, T.StructField("archive_date", T.DateType())]
    return read_runs(spark, f"{root}/clean/{dataset}", T.StructType(located), required=True)


def typed(df: DataFrame, dataset: str, run_ts: Column) -> DataFrame:
    """Parse the dataset's time and stamp the run. Unparsable times become NULL and do not
    make a record bad."""
    if dataset in TIMES:
        text, parsed = TIMES[dataset]
        df = df.withColumn(parsed, parsed_ts(F.col(text))).drop(text)
    return df.withColumn("ingestion_ts", run_ts)


def standardize(
    spark: SparkSession,
    root: str,
    run_ts: dt.datetime | str,
    first_day: dt.date | None = None,
    last_day: dt.date | None = None,
) -> DataFrame:
    """Run for the given archive dates (all by default); returns the counts per dataset.

    Among copies of a key the newest archive date wins, then the last file, then the largest
    row. The counts are taken from what was written.
    """
    run = run_id(run_ts)
    counts = []
    for dataset in DATASETS:
        rows = typed(
            read_archive(spark, root, dataset, first_day, last_day), dataset, stamp(run_ts)
        )
        # Good and bad records are two writes; the archive is parsed once for both.
        rows = cut_lineage(rows)
        few = rows.select("archive_date").distinct().limit(FEW_DATES + 1).count() <= FEW_DATES
        good, bad = split_records(rows, REQUIRED_KEYS[dataset])
        # The stamp is the same for all rows, so it is not shuffled.
        kept = collapse_few_copies(
            good.drop("raw_line", "ingestion_ts"), [RECORD_KEYS[dataset]], ["archive_date", "source_file"]
        ).withColumn("ingestion_ts", stamp(run_ts))
        clean, quarantine = f"{root}/clean/{dataset}", f"{root}/clean/bad_records/{dataset}"
        write_run(kept.drop("source_file"), clean, run, ["archive_date"], spread=not few)
        reasoned = bad.withColumn("reason", bad_reason(REQUIRED_KEYS[dataset]))
        write_run(reasoned, quarantine, run)
        counts.append(
            record_counts(
                spark.read.schema(kept.select("copies").schema).parquet(f"{clean}/run_id={run}"),
                spark.read.schema(bad.schema).parquet(f"{quarantine}/run_id={run}"),
                dataset,
            )
        )
    summary = reduce(DataFrame.unionByName, counts)
    summary_json(summary, "standardize", stamp(run_ts)).write.mode("overwrite").text(
        f"{root}/metrics/standardize/run_id={run}"
    )
    return summary

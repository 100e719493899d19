"""Run summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def record_counts(good: DataFrame, bad: DataFrame, dataset: str) -> DataFrame:
    """Total, good, bad and duplicate counts of one dataset.

    ``good`` carries ``copies`` (see ``collapse_copies``), so the total needs no second scan of
    the input: total = copies of the good rows + bad rows.
    """
    kept = good.agg(
        F.count(F.lit(1)).alias("good"),
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("_copies"),
        F.lit(0).cast("bigint").alias("bad"),
    )
    lost = bad.agg(
        F.lit(0).cast("bigint").alias("good"),
        F.lit(0).cast("bigint").alias("_copies"),
        F.count(F.lit(1)).alias("bad"),
    )
    both = kept.unionByName(lost).agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.sum("_copies").alias("_copies")
    )
    return both.select(
        F.lit(dataset).alias("dataset"),
        (F.col("_copies") + F.col("bad")).alias("total"),
        "good",
        "bad",
        (F.col("_copies") - F.col("good")).alias("duplicates"),
    )


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """``(dataset, rows)`` for each frame."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def summary_json(counts: DataFrame, job: str, run_ts) -> DataFrame:
    """One JSON document for a run: a nested object of counts per dataset."""
    measures = [c for c in counts.columns if c != "dataset"]
    per_dataset = F.map_from_entries(
        F.sort_array(F.collect_list(F.struct("dataset", F.struct(*measures).alias("counts"))))
    )
    document = F.struct(
        F.lit(job).alias("job"),
        F.date_format(run_ts, "yyyy-MM-dd'T'HH:mm:ss").alias("run_time_utc"),
        F.col("datasets"),
        F.lit("SUCCESS").alias("status"),
    )
    return counts.agg(per_dataset.alias("datasets")).select(F.to_json(document).alias("summary"))

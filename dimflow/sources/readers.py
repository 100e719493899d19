"""Scans of landed, archived, clean and staged data."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.functions.csvtext import header_names
from dimflow.functions.paths import archive_date_of, path_below
from dimflow.operators.align import align_by_name
from dimflow.schemas import layout

RAW_LINE = (T.StructField("raw_line", T.StringType()),)
LOCATION = (T.StructField("source_file", T.StringType()), T.StructField("archive_date", T.DateType()))
#: Longest range of days whose folders are named one by one.
LISTED_DAYS = 1000


def or_empty(read, spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """A dataset without any file is an empty frame, not an error."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def read_ndjson(spark: SparkSession, path: str, dataset: str, keep: Column | None = None) -> DataFrame:
    """NDJSON with the dataset's layout. A malformed line gives a row of NULLs and its text
    in ``raw_line``; nested objects under text fields stay JSON text. ``keep`` is a condition on
    ``_metadata.file_path``; Spark skips files that fail it."""
    schema = T.StructType([*layout(dataset).fields, *RAW_LINE])
    rows = spark.read.schema(schema).json(
        path, columnNameOfCorruptRecord=RAW_LINE[0].name, recursiveFileLookup=True
    )
    return with_archive_date(rows if keep is None else rows.filter(keep), schema)


def read_csv(spark: SparkSession, path: str, dataset: str, keep: Column | None = None) -> DataFrame:
    """CSV with a header line, each file read by the names of its own header.

    Files of any number of header versions are one frame: columns may move, come and go, or change
    between upper and lower case; of two columns with one name the first counts. A file's cells
    are put in place by its header, which is joined to its lines; so all versions are parsed in one scan. Numbers
    that do not parse become NULL. ``keep`` is a condition on ``_metadata.file_path``.
    """
    schema = layout(dataset)
    text = spark.read.option("recursiveFileLookup", True).text(path)
    if keep is not None:
        text = text.filter(keep)
    lines = text.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("start"),
        # Both scans below are of the same files in the same splits, so a line has one number.
        F.monotonically_increasing_id().alias("place"),
        "value",
    ).filter("value <> ''")
    headers = (
        lines.filter("start = 0")
        .groupBy("source_file")
        .agg(F.min_by("value", "place").alias("header"), F.min("place").alias("header_place"))
        .withColumn("names", F.transform(header_names(F.col("header")), lambda name: F.lower(name)))
    )
    widest = headers.agg(F.max(F.size("names"))).first()[0]
    if widest is None:
        return spark.createDataFrame([], T.StructType([*schema.fields, *LOCATION]))
    width = range(widest)
    cells = F.from_csv("value", ", ".join(f"c{i} string" for i in width))
    rows = (
        lines.join(headers, "source_file")
        .filter("place <> header_place")
        .withColumn("cells", cells)
        .withColumn("cells", F.array(*[F.col("cells")[f"c{i}"] for i in width]))
    )

    def column(field: T.StructField) -> Column:
        at = F.array_position("names", F.lit(field.name.lower())).cast("int") - 1
        return F.get("cells", F.when(at >= 0, at)).try_cast(field.dataType).alias(field.name)

    date = archive_date_of(F.col("source_file")).alias("archive_date")
    return rows.select(*[column(field) for field in schema], "source_file", date)


def with_archive_date(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fit scanned rows to ``schema`` and add the path and archive date of their file.

    A filter on ``archive_date`` depends on the path alone, so Spark skips whole files.
    """
    file = df.select("*", F.col("_metadata.file_path").alias("source_file"))
    located = file.withColumn("archive_date", archive_date_of(F.col("source_file")))
    return align_by_name(located, T.StructType([*schema.fields, *LOCATION]))


def read_archive(
    spark: SparkSession,
    root: str,
    dataset: str,
    first_day: dt.date | None = None,
    last_day: dt.date | None = None,
) -> DataFrame:
    """All archived files of a dataset, or those of a range of archive dates (replay).

    Of a range with two ends only the folders of its days are listed, up to ``LISTED_DAYS`` of them.
    """
    # Folders may be named by the bare dataset or as ``dataset=<name>``, days likewise.
    path = f"{root}/archive/{{{dataset},dataset={dataset}}}"
    if first_day is not None and last_day is not None and (last_day - first_day).days < LISTED_DAYS:
        days = [first_day + dt.timedelta(n) for n in range((last_day - first_day).days + 1)]
        path += f"/{{{','.join(f'{d},ingest_date={d}' for d in days)}}}"
    date = archive_date_of(F.col("_metadata.file_path"))
    bounds = [date >= F.lit(first_day)] * (first_day is not None) + [date <= F.lit(last_day)] * (last_day is not None)
    keep = reduce(lambda x, y: x & y, bounds) if bounds else None
    empty = T.StructType([*layout(dataset).fields, *RAW_LINE, *LOCATION])
    read = read_csv if dataset == "plans" else read_ndjson
    return align_by_name(or_empty(lambda: read(spark, path, dataset, keep), spark, empty), empty)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet written under older and newer layouts, as one frame of ``schema``.

    The layout is given, so columns a file lacks are NULL and columns it has besides are not
    read; no footers are merged.
    """
    return or_empty(lambda: spark.read.schema(schema).parquet(path), spark, schema)


def read_evolved(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As ``read_parquet`` for files whose column types or upper and lower case changed too."""
    return or_empty(
        lambda: align_by_name(spark.read.option("mergeSchema", True).parquet(path), schema),
        spark,
        schema,
    )


def read_staged(
    spark: SparkSession, path: str, table: str, misfits: Observation | None = None
) -> DataFrame:
    """Staged Parquet as the typed staging table, by column name in any case.

    The staged activity calls its time ``event_ts``; the table calls it ``event_timestamp``.
    ``misfits`` observes the values of each column that do not fit and become NULL. A folder
    that is not there is an error: an empty table would replace the one loaded before.
    """
    schema = layout(table)
    rows = spark.read.parquet(path)
    if "event_ts" in rows.columns and "event_timestamp" in schema.names:
        rows = rows.withColumnRenamed("event_ts", "event_timestamp")
    return align_by_name(rows, schema, misfits)


def preview(df: DataFrame, name: str) -> DataFrame:
    """Register a frame for ``SELECT * FROM name`` and return that query."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


_LINES = "uri string, line_no struct<start:bigint,row:bigint>, value string"
_FILES = "uri string, modified timestamp, length bigint"
#: Endings of files that Spark reads through a decompressor.
COMPRESSED = ("gz", "bz2", "deflate", "zst", "lz4", "snappy")


def located_text(text: DataFrame, root: str) -> DataFrame:
    """``(uri, start, value)`` of a text scan, batch or stream: encoded path below the root,
    start of the split, line. Decoding is left to the verdict, which is once per file."""
    return text.select(
        path_below(F.col("_metadata.file_path"), root).alias("uri"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )


def numbered_lines(located: DataFrame) -> DataFrame:
    """``(uri, line_no, value)``; ``line_no`` orders the lines of a file: start of the split,
    then place in the task that reads it. To be applied to the scan itself."""
    place = F.monotonically_increasing_id().alias("row")
    return located.select("uri", F.struct("start", place).alias("line_no"), "value")


def landed_lines(spark: SparkSession, root: str) -> DataFrame:
    """Every line below ``raw/``. Of a file that cannot be read to its end, the lines before the failure."""
    read = _tolerant(spark)
    return or_empty(
        lambda: numbered_lines(located_text(read.text(f"{root}/raw"), root)), spark, _LINES
    )


def _tolerant(spark: SparkSession):
    options = {"recursiveFileLookup": True, "ignoreCorruptFiles": True, "ignoreMissingFiles": True}
    return spark.read.options(**options)


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """``(uri, modified, length)`` of every file below ``raw/``; contents are not read.

    Scans leave out files of length zero, so the names come from the listing that the scan
    keeps on the driver anyway, and both are of the same moment. The time of an empty file is NULL.
    """

    def read() -> DataFrame:
        scan = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(
            f"{root}/raw"
        )
        # Local files are written file:/ in one list and file:/// in the other.
        alike = F.regexp_replace("uri", "^file:/+", "file:/").alias("uri")
        sized = scan.select(
            F.col("_metadata.file_path").alias("uri"), F.col("modificationTime").alias("modified"), "length"
        ).select(alike, "modified", "length")
        names = spark.createDataFrame([(uri,) for uri in scan.inputFiles()], "uri string").select(alike)
        return names.join(sized, "uri", "left").select(
            path_below(F.col("uri"), root).alias("uri"),
            "modified",
            F.coalesce("length", F.lit(0)).cast("bigint").alias("length"),
        )

    return or_empty(read, spark, _FILES)


def is_compressed(name: Column) -> Column:
    return name.rlike(rf"\.({'|'.join(COMPRESSED)})$")


def whole_files(spark: SparkSession, root: str) -> DataFrame:
    """``uri`` of the compressed files below ``raw/`` that decompress to their end.

    Such a file cannot be split. Read as one text, it makes its row only when all of it is there,
    and a task needs memory for all of it.
    """

    def read() -> DataFrame:
        names = f"*.{{{','.join(COMPRESSED)}}}"
        scan = _tolerant(spark).option("pathGlobFilter", names).text(f"{root}/raw", wholetext=True)
        return scan.select(path_below(F.col("_metadata.file_path"), root).alias("uri"))

    return or_empty(read, spark, "uri string")

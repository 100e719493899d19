"""Fit a frame to a typed layout by column name."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align_by_name(
    df: DataFrame, schema: T.StructType, misfits: Observation | None = None
) -> DataFrame:
    """Match columns by name in any case, drop extra ones, fill absent ones with NULL.

    Values that do not fit the type become NULL. Plain projection, so it reaches the scan.
    ``misfits``, if given, counts such values by column (and all rows, as ``rows``) while the
    result is written, without another scan.
    """
    found: dict[str, str] = {}
    for name in df.columns:
        if name.lower() in found:
            raise ValueError(f"columns differ only in case: {found[name.lower()]}, {name}")
        found[name.lower()] = name

    def column(field: T.StructField):
        if field.name.lower() not in found:
            return F.lit(None).cast(field.dataType).alias(field.name)
        source = df[f"`{found[field.name.lower()]}`"]
        return source.try_cast(field.dataType).alias(field.name)

    if misfits is not None:
        # Only what is used below is observed, so no more columns are read.
        used = [f for f in schema if f.name.lower() in found]
        df = df.select(*[f"`{found[f.name.lower()]}`" for f in used])
        lost = {f.name: df[f"`{found[f.name.lower()]}`"].isNotNull() & column(f).isNull() for f in used}
        counts = [F.count_if(test).alias(name) for name, test in lost.items()]
        df = df.observe(misfits, F.count(F.lit(1)).alias("rows"), *counts)
    return df.select(*[column(f) for f in schema])

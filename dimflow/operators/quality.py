"""Good and bad records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keys_present(required: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in required])


def bad_reason(required: Sequence[str]) -> Column:
    """``null_keys_[a, b]`` for a record with missing keys, NULL for a good one."""
    absent = F.array_compact(
        F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in required])
    )
    return F.when(
        ~keys_present(required),
        F.concat(F.lit("null_keys_["), F.array_join(absent, ", "), F.lit("]")),
    )


def split_records(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Good records (all required keys present) and the exact complement."""
    return df.filter(keys_present(required)), df.filter(~keys_present(required))


def labelled(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Both streams in one frame: ``quality`` is good or bad, ``reason`` says why."""
    return df.withColumns(
        {
            "quality": F.when(keys_present(required), "good").otherwise("bad"),
            "reason": bad_reason(required),
        }
    )

"""Null-tolerant comparison, dirty-text parsing and run stamps."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differs(left: Column, right: Column, blank) -> Column:
    """Change test in which NULL and ``blank`` are the same value. Never NULL."""
    return F.coalesce(left, F.lit(blank)) != F.coalesce(right, F.lit(blank))


def any_differs(left, right, tracked: Mapping[str, object]) -> Column:
    """True when one tracked column differs; ``left`` and ``right`` map a name to a column."""
    tests = [differs(left(name), right(name), blank) for name, blank in tracked.items()]
    return reduce(lambda a, b: a | b, tests)


def parsed_ts(text: Column) -> Column:
    """Text to a zone-less timestamp; NULL for text that is no timestamp."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def stamp(run_ts: dt.datetime | str) -> Column:
    """One constant timestamp for a whole run."""
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def run_id(run_ts: dt.datetime | str) -> str:
    """Sortable text form of a run timestamp, usable in a directory name."""
    return dt.datetime.fromisoformat(str(run_ts)).strftime("%Y%m%dT%H%M%S%f")


def between(at: Column, start: Column, end: Column, open_end: str) -> Column:
    """Half-open interval test; a NULL end means ``open_end``."""
    return (at >= start) & (at < F.coalesce(end, F.lit(open_end).cast("timestamp_ntz")))


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill absent columns, and NULLs of present ones, from ``defaults``."""
    return df.withColumns(
        {
            name: F.coalesce(df[name], F.lit(value)) if name in df.columns else F.lit(value)
            for name, value in defaults.items()
        }
    )


def snake_case(name: str) -> str:
    """``Customer ID``, ``customerId`` and ``customer-id`` all become ``customer_id``."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name.strip())
    return re.sub(r"[^0-9A-Za-z]+", "_", spaced).strip("_").lower()


def normalized_names(df: DataFrame) -> DataFrame:
    """Rename every column to snake case; two names that collide are an error."""
    names = [snake_case(name) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"column names collide after normalizing: {clashes}")
    return df.toDF(*names)

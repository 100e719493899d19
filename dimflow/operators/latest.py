"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimflow.session import cut_lineage

#: Up to this share of rows whose key comes again, only they are shuffled whole.
FEW_COPIES = 0.1
#: About as many whole rows a task sorts in memory. Stored rows are packed so well that a split of them does not tell.
SORTED_ROWS = 500_000


def newest_first(df: DataFrame, keys: Sequence[str], lead: Sequence[str]) -> list[str]:
    """A total order: the leading columns, then every other column as tie-break."""
    return [*lead, *sorted(c for c in df.columns if c not in {*keys, *lead})]


def keep_latest(df: DataFrame, keys: Sequence[str], lead: Sequence[str]) -> DataFrame:
    """The row of each key that is largest in ``lead`` (then in all other columns).

    Spark cuts each map task down to one row per key before the shuffle, so a key that holds
    a large share of all rows sends no more than one row per task.
    """
    order = [F.col(c).desc() for c in newest_first(df, keys, lead)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def collapse_copies(df: DataFrame, keys: Sequence[str], lead: Sequence[str]) -> DataFrame:
    """As ``keep_latest``, and ``copies`` says how many rows the survivor stands for.

    Two-phase aggregate; the count travels with the data, so it stays exact when a lost
    executor makes Spark run a stage again (task-side counters would count twice).
    """
    packed = F.struct(*newest_first(df, keys, lead))
    best = df.groupBy(*keys).agg(F.max(packed).alias("_best"), F.count(F.lit(1)).alias("copies"))
    return best.select(*[c if c in keys else F.col(f"_best.{c}") for c in df.columns], "copies")


def _repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that come again, as ``_key_0`` and so on, and how often. Keys alone are shuffled, partial per task."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")).filter("_copies > 1")
    return cut_lineage(counted.toDF(*[f"_key_{i}" for i in range(len(keys))], "_copies"))


def _with_and_without(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is listed (as ``_repeated`` names it), and the others."""
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])
    return df.join(listed, same, "left_semi"), df.join(listed, same, "left_anti")


def keep_latest_of_runs(df: DataFrame, key: str, run: str, lead: Sequence[str]) -> DataFrame:
    """As ``keep_latest`` for the rows of several runs, none of which has a key twice, if the order of ``run`` is that
    of the first of ``lead``. Rows of the last run stay where they are; only its keys and older rows are shuffled."""
    last = df.agg(F.max(run)).first()[0]
    if last is None:
        return df
    newest, older = df.filter(F.col(run) == last), df.filter(F.col(run) != last)
    left = older.join(newest.select(key), key, "left_anti").select(*df.columns)
    return newest.unionByName(keep_latest(left, [key], lead))


def collapse_few_copies(
    df: DataFrame, keys: Sequence[str], lead: Sequence[str], sorted_rows: int = SORTED_ROWS
) -> DataFrame:
    """As ``collapse_copies``, for a written table. Where most keys come once, their rows are not shuffled.

    Else rows are dealt by key before they are sorted, into parts that a task sorts in memory: ``collapse_copies`` sorts
    whole splits, which spills, and leaves no fewer rows of keys with few copies. Keys with more than ``sorted_rows``
    rows are too much for a task; they are still cut down before the shuffle. ``df`` is read up to four times."""
    again = _repeated(df, keys)
    copies, most = again.agg(F.sum("_copies"), F.max("_copies")).first()
    if copies is None:
        return df.withColumn("copies", F.lit(1).cast("bigint"))
    rows = df.count()
    if copies <= FEW_COPIES * rows:
        repeated, alone = _with_and_without(df, again, keys)
        return alone.withColumn("copies", F.lit(1).cast("bigint")).unionByName(collapse_copies(repeated, keys, lead))
    if most <= sorted_rows:
        return collapse_copies(_dealt(df, keys, rows, sorted_rows), keys, lead)
    heavy, others = _with_and_without(df, again.filter(F.col("_copies") > sorted_rows), keys)
    dealt = collapse_copies(_dealt(others, keys, rows, sorted_rows), keys, lead)
    return dealt.unionByName(collapse_copies(heavy, keys, lead))


def _dealt(df: DataFrame, keys: Sequence[str], rows: int, sorted_rows: int) -> DataFrame:
    return df.repartition(1 + rows // sorted_rows, *keys)

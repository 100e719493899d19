"""Type-2 dimension: versions with half-open validity intervals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.values import any_differs
from dimflow.operators.heavy import MANY_ROWS, heavy_keys, with_neighbour
from dimflow.operators.latest import keep_latest

START, END, CURRENT = "effective_start_date", "effective_end_date", "is_current"
KEPT, CLOSED, OPENED = "kept", "closed", "opened"


def scd2_apply(
    current: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Mapping[str, object],
    run_ts: Column,
    reopen_same_run: bool = True,
    first_start: Column | None = None,
) -> DataFrame:
    """Bring the open versions in line with a snapshot (one row per key on either side).

    ``change`` tells what became of each row: ``kept`` (unchanged, or absent from the
    snapshot), ``closed`` (a tracked column changed; ends at ``run_ts``) or ``opened`` (a new
    version from ``run_ts``). With ``reopen_same_run=False`` a closed key gets its new version
    in the next run. ``first_start`` replaces ``run_ts`` as the start of a key's first version.

    One full join finds all three cases, so each side is shuffled once.
    """
    attributes = [c for c in current.columns if c not in (START, END, CURRENT)]
    carried = [c for c in attributes if c in snapshot.columns and c != key]
    joined = current.select(key, F.struct(*current.columns).alias("old")).join(
        snapshot.select(
            key,
            F.struct(*carried, (run_ts if first_start is None else first_start).alias("_first"))
            .alias("new"),
        ),
        key,
        "full_outer",
    )
    changed = (
        F.col("old").isNotNull()
        & F.col("new").isNotNull()
        & any_differs(lambda c: F.col(f"old.{c}"), lambda c: F.col(f"new.{c}"), tracked)
    )
    opens = F.col("old").isNull()
    if reopen_same_run:
        opens = opens | changed

    types = {f.name: f.dataType for f in current.schema}

    def old_value(name: str) -> Column:
        value = F.col(f"old.{name}")
        if name == END:
            return F.when(changed, run_ts).otherwise(value)
        return value & ~changed if name == CURRENT else value

    def new_value(name: str) -> Column:
        fresh = {
            key: F.col(key),
            START: F.when(F.col("old").isNull(), F.col("new._first")).otherwise(run_ts),
            END: F.lit(None),
            CURRENT: F.lit(True),
        }
        value = fresh.get(name, F.col(f"new.{name}") if name in carried else F.lit(None))
        return value.cast(types[name])

    before = F.struct(
        *[old_value(c).alias(c) for c in current.columns],
        F.when(changed, CLOSED).otherwise(KEPT).alias("change"),
    )
    after = F.struct(
        *[new_value(c).alias(c) for c in current.columns], F.lit(OPENED).alias("change")
    )
    rows = F.array(F.when(F.col("old").isNotNull(), before), F.when(opens, after))
    return joined.select(F.inline(rows)).filter("change IS NOT NULL")


def scd2_history(
    feed: DataFrame,
    key: str,
    at: str,
    tracked: Mapping[str, object],
    order: Sequence[str] = (),
    many_rows: int = MANY_ROWS,
) -> DataFrame:
    """All versions from an ordered change feed: ``scd2_apply`` per batch, in one pass.

    The feed is first cut to the last row per key and batch time, so a key enters the windows
    with one row per batch however many rows it had. Keys with more than ``many_rows`` rows in
    the feed may still have very many batches; their rows are looked at in slots of time.
    """
    timed = feed.filter(F.col(at).isNotNull())
    heavy = heavy_keys(timed, key, at, many_rows)
    batches = keep_latest(timed, [key, at], order)
    seen = with_neighbour(batches, key, at, list(tracked), -1, "_before", heavy)
    changed = any_differs(F.col, lambda c: F.col(f"_before.{c}"), tracked)
    versions = seen.filter(F.col("_before").isNull() | changed).drop("_before")
    starts = versions.withColumnRenamed(at, START)
    ended = with_neighbour(starts, key, START, [START], 1, "_after", heavy)
    return ended.withColumns(
        {END: F.col(f"_after.{START}"), CURRENT: F.col("_after").isNull()}
    ).drop("_after")

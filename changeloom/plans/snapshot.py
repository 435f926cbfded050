"""Full, partitioned and filtered snapshots, and joining them to live changes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODES = ("initial", "initial_only", "schema_only", "no_data", "never")


def table_snapshot(
    df: DataFrame, table: str, as_of_lsn, pk: Sequence[str] = ()
) -> DataFrame:
    """A full table read as ``r`` events without a before image."""
    row = F.struct(*df.columns)
    keys = [F.struct(*pk).alias("pk")] if pk else []
    return df.select(
        F.lit(table).alias("table"),
        F.lit("r").alias("op"),
        F.lit(as_of_lsn).alias("lsn"),
        *keys,
        F.lit(None).cast(df.schema).alias("before"),
        row.alias("after"),
    )


def check_bounds(bounds: Sequence[tuple]) -> None:
    """Ranges ``(lo, hi)`` include lo and exclude hi; None leaves an end open."""
    if not bounds:
        raise ValueError("no key ranges given")
    if bounds[0][0] is not None or bounds[-1][1] is not None:
        raise ValueError("the first and last range must be open to cover all keys")
    for (_, hi), (lo, _) in zip(bounds, bounds[1:]):
        if hi is None or lo is None or hi != lo:
            raise ValueError(f"ranges overlap or leave a gap at {hi!r} and {lo!r}")


def partitioned_snapshot(
    df: DataFrame, key: str, bounds: Sequence[tuple], table: str, as_of_lsn
) -> DataFrame:
    """A snapshot read as key ranges that cover every key exactly once.

    The number of the range is added as ``part``.  File sources are read once and
    each row is given its range by comparing literals; for a database use
    :func:`changeloom.sources.tables.read_jdbc`, which reads ranges in parallel.
    """
    check_bounds(bounds)
    part = F.lit(0)
    for i, (lo, _) in enumerate(bounds[1:], start=1):
        part = F.when(F.col(key) >= F.lit(lo), F.lit(i)).otherwise(part)
    numbered = df.select("*", part.alias("__part"))
    row = F.struct(*df.columns)
    return numbered.select(
        F.lit(table).alias("table"),
        F.lit("r").alias("op"),
        F.lit(as_of_lsn).alias("lsn"),
        F.lit(None).cast(df.schema).alias("before"),
        row.alias("after"),
        F.col("__part").alias("part"),
    )


def snapshot_then_stream(
    snapshot: DataFrame,
    change: DataFrame,
    mode: str,
    start,
    current=None,
    position: str = "lsn",
) -> DataFrame:
    """Snapshot and later changes as one log, by snapshot mode.

    ``initial`` gives the snapshot and the changes after ``start``;
    ``initial_only`` the snapshot; ``schema_only`` and ``no_data`` the changes
    after ``start``; ``never`` the changes after ``current``.
    """
    if mode not in MODES:
        raise ValueError(f"unknown snapshot mode {mode!r}")
    if mode == "initial_only":
        return snapshot
    since = current if mode == "never" and current is not None else start
    later = change.where(F.col(position) > F.lit(since))
    if mode == "initial":
        return snapshot.unionByName(later, allowMissingColumns=True)
    return later


def filtered_snapshot(
    tables: dict[str, DataFrame],
    overrides: dict[str, Callable[[DataFrame], DataFrame]],
    as_of_lsn,
    pks: dict[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """Snapshot events per table; a table with an override is read through it.

    Tables without one are read whole.  Changes that come later are not filtered:
    join them with :func:`snapshot_then_stream`.
    """
    unknown = set(overrides) - set(tables)
    if unknown:
        raise ValueError(f"override for tables that are not captured: {sorted(unknown)}")
    pks = pks or {}
    return {
        name: table_snapshot(
            overrides[name](df) if name in overrides else df, name, as_of_lsn, pks.get(name, ())
        )
        for name, df in tables.items()
    }

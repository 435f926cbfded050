"""Table state and log maintenance.

The latest row per key comes from ``max_by``, which Spark aggregates before the
shuffle: every task sends at most one row per key, so a key with a third of all
events costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import Key, long_block, row_index, running_sum
from .decode import LIVE_OPS

POSITION = ("lsn", "partition", "offset")


def _position(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def settling(change: DataFrame, op: str = "op", flag: str = "is_tombstone") -> DataFrame:
    """Events that say what a row is: reads, changes, deletes and tombstones.

    A tombstone is an event flagged as one.  Events with an unknown operation, and events without an
    operation that are no tombstones (text that could not be decoded), say nothing about a row.
    """
    known = F.coalesce(F.col(op).isin(*LIVE_OPS, "d"), F.lit(False))
    if flag in change.columns:
        known = known | (F.col(op).isNull() & F.coalesce(F.col(flag), F.lit(False)))
    return change.where(known)


def latest_per_key(
    change: DataFrame, pk: Sequence[str], order: Sequence[str] = POSITION
) -> DataFrame:
    """Last event per key; column order is kept."""
    rest = [c for c in change.columns if c not in pk]
    picked = change.groupBy(*pk).agg(
        F.max_by(F.struct(*rest), _position(order)).alias("__last")
    )
    return picked.select(*pk, "__last.*").select(*change.columns)


def materialize(
    change: DataFrame,
    pk: Sequence[str],
    order: Sequence[str] = POSITION,
    op: str = "op",
) -> DataFrame:
    """Current rows: the latest event per key, unless it is a delete or tombstone.

    Events that :func:`settling` leaves out are skipped.
    """
    return latest_per_key(settling(change, op), pk, order).where(F.col(op).isin(*LIVE_OPS))


def state_as_of(
    change: DataFrame,
    pk: Sequence[str],
    position,
    order: Sequence[str] = POSITION,
    op: str = "op",
) -> DataFrame:
    """Table rows as of a log position."""
    return materialize(change.where(F.col(order[0]) <= F.lit(position)), pk, order, op)


def in_range(change: DataFrame, lo, hi, position: str = "lsn") -> DataFrame:
    return change.where(F.col(position).between(F.lit(lo), F.lit(hi)))


def all_changes(
    change: DataFrame, lo, hi, order: Sequence[str] = POSITION
) -> DataFrame:
    """Every change in a position range, in log order."""
    return in_range(change, lo, hi, order[0]).orderBy(*order)


def net_changes(
    change: DataFrame,
    pk: Sequence[str],
    lo,
    hi,
    order: Sequence[str] = POSITION,
) -> DataFrame:
    """One collapsed change per key in a position range.

    A key first seen as new and last seen deleted gives nothing; new keys give an
    insert; keys that end deleted give a delete; all others give an update.
    """
    at = _position(order)
    ends = (
        in_range(change, lo, hi, order[0])
        .where(F.col("op").isin(*LIVE_OPS, "d"))
        .groupBy(*pk)
        .agg(
            F.min_by("op", at).alias("__first"),
            F.max_by(F.struct("op", "before", "after", *order), at).alias("__last"),
        )
    )
    born = F.col("__first").isin("c", "r")
    gone = F.col("__last.op") == "d"
    net = F.when(born, "c").when(gone, "d").otherwise("u")
    return ends.where(~(born & gone)).select(
        *pk,
        net.alias("op"),
        F.when(gone, F.col("__last.before")).alias("before"),
        F.when(~gone, F.col("__last.after")).alias("after"),
        *[F.col(f"__last.{c}").alias(c) for c in order],
    )


def compact_log(
    log: DataFrame,
    key: Sequence[str] = ("topic", "partition", "key"),
    order: Sequence[str] = ("offset",),
    drop_tombstoned: bool = False,
    value: str = "value",
) -> DataFrame:
    """Newest record per key; optionally without keys whose newest value is null."""
    newest = latest_per_key(log, key, order)
    return newest.where(F.col(value).isNotNull()) if drop_tombstoned else newest


def retain(
    log: DataFrame,
    not_before: Column | None = None,
    max_bytes: int | None = None,
    size: Column | None = None,
    by: Sequence[str] = ("topic", "partition"),
    offset: str = "offset",
    timestamp: str = "timestamp",
    bits: int = 20,
) -> DataFrame:
    """Drop records older than ``not_before``, then keep the newest bytes.

    Per partition the newest records are kept while their total size does not
    exceed ``max_bytes``.
    """
    kept = log
    if not_before is not None:
        kept = kept.where(F.col(timestamp) >= not_before)
    if max_bytes is None:
        return kept
    newest_first = -F.col(offset)
    summed = running_sum(
        kept, by, [newest_first], [-long_block(offset, bits)], size.cast("long"), "__bytes"
    )
    return summed.where(F.col("__bytes") <= max_bytes).drop("__bytes")


def dedupe(
    change: DataFrame, key: Sequence[str] = ("topic", "partition", "offset")
) -> DataFrame:
    """Drop redelivered events.  Copies are equal, so any one of them is kept."""
    return change.dropDuplicates(list(key))


def assign_partition(
    change: DataFrame,
    pk: Sequence[str],
    partitions: int,
    out: str = "partition",
    by_value: bool = False,
) -> DataFrame:
    """Same key, same partition; ``by_value`` uses an integer key directly."""
    base = F.col(pk[0]) if by_value else F.xxhash64(*pk)
    return change.withColumn(out, F.pmod(base, F.lit(partitions)).cast("int"))


def with_tombstones(
    change: DataFrame,
    enabled: bool = True,
    emptied: Sequence[str] = ("value",),
    op: str = "op",
    flag: str = "is_tombstone",
) -> DataFrame:
    """After each delete add a record with the same key and no value.

    ``emptied`` names the columns a tombstone has no content in.  One pass: each
    delete becomes two rows.
    """
    base = change.drop(flag)
    if not enabled:
        return base.withColumn(flag, F.lit(False))
    copies = F.when(F.col(op) == "d", F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False))
    )
    doubled = base.select("*", F.explode(copies).alias(flag))
    return doubled.select(
        *[
            F.when(~F.col(flag), F.col(c)).alias(c) if c in emptied else F.col(c)
            for c in base.columns
        ],
        flag,
    )


def missing_before(
    change: DataFrame, pk: Sequence[str], order: Sequence[str] = POSITION
) -> DataFrame:
    """Keys whose first event is an update, with the position of that event."""
    at = _position(order)
    first = change.where(F.col("op").isin(*LIVE_OPS, "d")).groupBy(*pk).agg(
        F.min_by("op", at).alias("__op"),
        F.min(at).alias("__at"),
    )
    hits = first.where(F.col("__op") == "u")
    if len(order) == 1:
        return hits.select(*pk, F.col("__at").alias(order[0]))
    return hits.select(*pk, "__at.*")


def surrogate_key(
    df: DataFrame, order: Sequence[Key], block: Sequence[Key], out: str = "row_key", start: int = 1
) -> DataFrame:
    """A gapless row number over the whole frame, in a defined order."""
    return row_index(df, [], order, block, out, start)

"""Chunked backfill that runs while changes keep arriving.

Chunks are data: one plan handles all of them.  Only narrow columns (key, chunk,
position) take part in the matching; full rows meet just the keys to discard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.blocks import Key, range_index, row_index
from ..operators.filters import with_condition
from ..operators.joins import hot_key_join
from ..schema import SIGNAL_SCHEMA

# Position of a read whose chunk has no window: before every change, so any change of the key wins.
BEFORE_ALL = -1


def chunk_number(key: str, first_key, size: int) -> Column:
    """Chunk of a key when chunks are ``size`` consecutive key values."""
    return F.call_function("div", F.col(key) - first_key, F.lit(size))


def with_chunks(
    df: DataFrame,
    pk: str | Sequence[str],
    size: int,
    mode: str = "key_range",
    block: Sequence[Key] = (),
) -> DataFrame:
    """Add ``chunk_id``.

    ``key_range`` chunks hold ``size`` values of one whole-number key and are computed
    per row; ``rows`` chunks hold ``size`` rows in key order, also of a composite key,
    and need a global row number.  ``block`` cuts the key order (see
    :mod:`changeloom.operators.blocks`); by default, rows are range partitioned and written once with their number.
    ``numbered`` rows have a ``chunk_id`` already, so that planning and reading share one numbering.
    """
    keys = [pk] if isinstance(pk, str) else list(pk)
    if mode == "key_range":
        if len(keys) > 1:
            raise ValueError("key ranges need a single key column; use mode='rows'")
        lowest = df.select(F.min(keys[0]).alias("k")).scalar()
        return df.withColumn("chunk_id", chunk_number(keys[0], lowest, size))
    if mode == "rows":
        ranked = row_index(df, [], keys, block, "__rank") if block else range_index(df, keys, "__rank")
        return ranked.withColumn(
            "chunk_id", F.floor(F.col("__rank") / F.lit(size)).cast("long")
        ).drop("__rank")
    if mode == "numbered":
        return df
    raise ValueError(f"unknown chunk mode {mode!r}")


def plan_chunks(
    df: DataFrame,
    pk: str | Sequence[str],
    size: int,
    mode: str = "key_range",
    block: Sequence[Key] = (),
) -> DataFrame:
    """Chunks with first key, last key, rows and the end position of the table.

    Keys are structs when the key is composite.
    """
    key = F.col(pk) if isinstance(pk, str) else F.struct(*pk)
    keys = [pk] if isinstance(pk, str) else list(pk)
    end = df.select(F.max(key).alias("k")).scalar()
    held = [*keys, "chunk_id"] if mode == "numbered" else keys
    chunked = with_chunks(df.select(*held), pk, size, mode, block)
    return chunked.groupBy("chunk_id").agg(
        F.min(key).alias("first_key"),
        F.max(key).alias("last_key"),
        F.count(F.lit(1)).alias("rows"),
    ).select("*", end.alias("end_key"))


def read_chunk(df: DataFrame, pk: str, lo, hi, condition: str | None = None) -> DataFrame:
    """One chunk in key order, with an optional extra condition, as ``r`` rows."""
    part = with_condition(df, condition, pk, lo, hi)
    return part.select("*", F.lit("r").alias("op")).orderBy(pk)


def sequential_windows(chunks: DataFrame, length: int) -> DataFrame:
    """Position windows of equal length, one after the other, both edges inside."""
    opened = F.col("chunk_id") * F.lit(length)
    return chunks.select(
        "chunk_id", opened.alias("open_pos"), (opened + F.lit(length - 1)).alias("close_pos")
    )


def stale_keys(
    reads: DataFrame, live: DataFrame, windows: DataFrame, pk: Sequence[str], position: str
) -> DataFrame:
    """Keys and chunks whose read met a live event inside the chunk's window.

    Only reads whose window reaches into the positions of the live events are
    joined to these.  A key may hold a large share of the changes, so hot keys
    are found first and spread.
    """
    pk = list(pk)
    narrow = live.select(*pk, F.col(position).alias("__pos"))
    low, high = (narrow.select(f("__pos").alias("__p")).scalar() for f in (F.min, F.max))
    spans = windows.select("chunk_id", "open_pos", "close_pos")
    spans = spans.where((F.col("close_pos") >= low) & (F.col("open_pos") <= high))
    touched = reads.select(*pk, "chunk_id").join(spans, on="chunk_id")
    met = hot_key_join(narrow, touched, pk, "inner").where(
        F.col("__pos").between(F.col("open_pos"), F.col("close_pos"))
    )
    return met.select(*pk, "chunk_id").distinct()


def discard_stale_reads(
    reads: DataFrame, live: DataFrame, windows: DataFrame, pk: Sequence[str], position: str = "lsn"
) -> DataFrame:
    """Reads without a live event of the same key inside their chunk's window."""
    stale = stale_keys(reads, live, windows, pk, position)
    return reads.join(stale, on=[*pk, "chunk_id"], how="left_anti").select(*reads.columns)


def incremental_snapshot(
    df: DataFrame,
    live: DataFrame,
    pk: str | Sequence[str],
    size: int,
    windows: DataFrame,
    position: str = "lsn",
    condition: str | None = None,
    chunks: DataFrame | None = None,
    mode: str = "key_range",
    block: Sequence[Key] = (),
    missing: str = "keep",
) -> DataFrame:
    """Reads that survive a chunked backfill, each at its window's close position.

    ``live`` holds the changes with the key and ``position``.  Windows name the log positions between which
    each chunk was read; ``chunks`` limits the run to the chunks still to do.  Chunks are those of
    :func:`with_chunks`: key ranges of one whole-number key, or (``mode='rows'``) equal numbers of rows of any key,
    composite or text, or (``mode='numbered'``) those in column ``chunk_id`` of ``df``.  A chunk without a window keeps its reads at ``BEFORE_ALL``, or fails with ``missing='raise'``.
    """
    if missing not in ("keep", "raise"):
        raise ValueError("missing is 'keep' or 'raise'")
    keys = [pk] if isinstance(pk, str) else list(pk)
    numbered = with_chunks(df, pk, size, mode, block)
    reads = with_condition(numbered, condition)
    if chunks is not None:
        reads = reads.join(chunks.select("chunk_id").distinct(), on="chunk_id", how="left_semi")
    spans = windows.select("chunk_id", "open_pos", "close_pos")
    if mode == "key_range":
        # A live event's chunk follows from its key, so only chunks have to be looked up.
        lowest = df.select(F.min(keys[0]).alias("k")).scalar()
        placed = live.select(*keys, F.col(position).alias("__pos"), chunk_number(keys[0], lowest, size).alias("chunk_id"))
        met = hot_key_join(placed, spans, ["chunk_id"], "inner")
        stale = met.where(F.col("__pos").between(F.col("open_pos"), F.col("close_pos"))).select("chunk_id", *keys).distinct()
    else:
        stale = stale_keys(reads.select(*keys, "chunk_id"), live, windows, keys, position)
    kept = reads.join(stale, on=["chunk_id", *keys], how="left_anti")
    closing = spans.select("chunk_id", F.col("close_pos").alias("__close"))
    without = (
        F.lit(BEFORE_ALL).cast("long")
        if missing == "keep"
        else F.raise_error(F.concat(F.lit("no window for chunk "), F.col("chunk_id").cast("string"))).cast("long")
    )
    at = F.when(F.col("__close").isNotNull(), F.col("__close")).otherwise(without)
    return kept.join(closing, on="chunk_id", how="left").select(
        *[c for c in df.columns if c != "chunk_id"], "chunk_id", F.lit("r").alias("op"), at.alias(position)
    )


def interleave(reads: DataFrame, live: DataFrame) -> DataFrame:
    """Backfill and live changes as one log; consumers go by position, not arrival."""
    return reads.unionByName(live, allowMissingColumns=True)


def parse_signals(log: DataFrame, prefix: str) -> DataFrame:
    """Decode signals; those keyed by another prefix or of unknown type are rejected.

    One row per signal and collection, with its place in the list.
    """
    parsed = log.select(
        "offset", F.col("key").cast("string").alias("key"), F.from_json(F.col("value").cast("string"), SIGNAL_SCHEMA).alias("__s")
    )
    reason = (
        F.when(~F.col("key").eqNullSafe(F.lit(prefix)), "key does not match the prefix")
        .when(F.col("__s.type").isNull(), "not a signal")
        .when(~F.col("__s.type").isin("execute-snapshot", "stop-snapshot"), "unknown type")
    )
    signals = parsed.select(
        "offset",
        "key",
        F.col("__s.id").alias("id"),
        F.col("__s.type").alias("type"),
        F.col("__s.data").getField("additional-condition").alias("condition"),
        F.transform(
            F.col("__s.data").getField("data-collections"), lambda c: F.trim(c)
        ).alias("collections"),
        reason.alias("reason"),
    )
    exploded = signals.select("*", F.posexplode_outer("collections").alias("pos", "collection"))
    return exploded.select(
        "offset",
        "key",
        "id",
        "type",
        "condition",
        "pos",
        "collection",
        F.col("reason").isNull().alias("accepted"),
        "reason",
    )


def snapshot_schedule(signals: DataFrame, bits: int = 20) -> DataFrame:
    """Run order: signals by offset, the tables of one signal in list order."""
    runs = signals.where(F.col("accepted") & (F.col("type") == "execute-snapshot"))
    return row_index(
        runs, [], ["offset", "pos"], [F.shiftright(F.col("offset"), bits)], "run_no", start=1
    )


def apply_stop(
    chunks: DataFrame, stops: DataFrame, table: str = "table", position: str = "stop_pos"
) -> DataFrame:
    """Chunks that run although stops arrive: those opened at or before the stop.

    ``chunks`` needs the table, open_pos and snapshot_pos, where the snapshot of the
    table began; a stop from before that does not touch it.
    """
    keys = [table, "snapshot_pos"]
    # Snapshots and stops of a table in order of position; each snapshot looks ahead to the next stop.
    begun = chunks.select(*keys, F.lit(None).cast("long").alias("__stop")).distinct()
    stopped = stops.select(table, F.col(position).alias("snapshot_pos"), F.col(position).cast("long").alias("__stop"))
    ahead = W.partitionBy(table).orderBy("snapshot_pos").rangeBetween(W.currentRow, W.unboundedFollowing)
    first = (
        begun.withColumn("__begins", F.lit(True))
        .unionByName(stopped.distinct().withColumn("__begins", F.lit(False)))
        .withColumn("__stop", F.min("__stop").over(ahead))
        .where("__begins")
        .select(*keys, "__stop")
    )
    joined = hot_key_join(chunks, first, keys, "left")
    return joined.where(
        F.col("__stop").isNull() | (F.col("open_pos") <= F.col("__stop"))
    ).select(*chunks.columns)


def resume_chunks(
    chunks: DataFrame, done: DataFrame, on: Sequence[str] = ("chunk_id",)
) -> DataFrame:
    """Chunks not in the ledger of completed ones."""
    return chunks.join(done.select(*on).distinct(), on=list(on), how="left_anti").select(
        *chunks.columns
    )

"""Sessions between silences: exact, complete and for topics of any size.

Two messages in one slot of the idle length belong to one session, so first, last and count per slot say all.  They are
added up inside tasks before any exchange, per batch, and merge in any order: late files, retries and compactions change
nothing, and no watermark decides which session comes out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.blocks import long_block, previous, running_sum
from ..sources.tables import compact_parts, deliver, delivered

# Slots next to each other that one ordered window takes, as a power of two.
SLOT_BITS = 16


def _micros(idle_seconds: float) -> int:
    width = round(idle_seconds * 1_000_000)
    if width <= 0:
        raise ValueError("the idle time must be above 0")
    return width


def session_slots(log: DataFrame, idle_seconds: float, by: Sequence[str], ts: str = "timestamp") -> DataFrame:
    """``slot, first_us, last_us, messages`` per slot of the idle length.  Rows without a time are in no session."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    width = F.lit(_micros(idle_seconds)).cast("long")
    slot = F.call_function("div", at - F.pmod(at, width), width)
    return (
        log.where(F.col(ts).isNotNull())
        .select(*by, slot.alias("slot"), at.alias("__at"))
        .groupBy(*by, "slot")
        .agg(F.min("__at").alias("first_us"), F.max("__at").alias("last_us"), F.count(F.lit(1)).alias("messages"))
    )


def merge_slots(slots: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per slot from the slots of several batches."""
    return slots.groupBy(*by, "slot").agg(
        F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"), F.sum("messages").alias("messages")
    )


def sessions_of(slots: DataFrame, idle_seconds: float, by: Sequence[str], now: Column | None = None) -> DataFrame:
    """All sessions, the last ones too: ``session_start``, ``last_message`` and ``messages``.

    A silence longer than the idle time ends a session; one as long goes on.  With ``now``, ``ended`` says whether the silence
    after a session has already been longer than that.  Columns of ``by`` must not be null.
    """
    width, by = _micros(idle_seconds), list(by)
    block = [long_block("slot", SLOT_BITS)]
    seen = previous(merge_slots(slots, by), by, ["slot"], block, {"__last_before": "last_us"})
    silent = F.col("__last_before").isNull() | (F.col("first_us") - F.col("__last_before") > width)
    numbered = running_sum(seen, by, ["slot"], block, F.when(silent, 1).otherwise(0).cast("long"), "__session")
    found = numbered.groupBy(*by, "__session").agg(
        F.min("first_us").alias("__a"), F.max("last_us").alias("__b"), F.sum("messages").alias("messages")
    )
    columns = [*by, F.timestamp_micros("__a").alias("session_start"), F.timestamp_micros("__b").alias("last_message"), "messages"]
    if now is not None:
        columns.append((F.unix_micros(now.cast("timestamp")) - F.col("__b") > width).alias("ended"))
    return found.select(*columns)


def session_stream(stream: DataFrame, target: str, idle_seconds: float, by: Sequence[str], checkpoint: str, ts: str = "timestamp"):
    """Deliver the slots of each micro-batch to ``target``; returns the query.  :func:`stored_sessions` reads sessions back."""
    return (
        stream.writeStream.foreachBatch(lambda batch, number: deliver(session_slots(batch, idle_seconds, by, ts), number, target))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_sessions(spark: SparkSession, target: str, idle_seconds: float, by: Sequence[str], now: Column | None = None) -> DataFrame:
    """Sessions of all delivered batches."""
    return sessions_of(delivered(spark, target), idle_seconds, by, now)


def compact_sessions(spark: SparkSession, target: str, by: Sequence[str]) -> int | None:
    """Merge the slots of all finished batches into one base; returns the last batch merged."""
    return compact_parts(spark, target, lambda slots: merge_slots(slots, by))

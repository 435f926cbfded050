"""Streaming forms of the operators.

Decoding, filters and row images need nothing special: the batch functions take a
streaming frame.  What is here keeps state or writes.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import MB, consumer_lag
from ..operators.decode import LIVE_OPS, render_summary
from ..operators.order_stats import lower_middle, order_statistics, percentile_rank, upper_middle
from ..operators.state import latest_per_key, settling
from ..sources.tables import delivered, upsert_batch


def consume_once(stream: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Consume what is there, commit the progress and stop; at least once.

    Called again with the same checkpoint, it goes on where it ended.
    """
    query = (
        stream.writeStream.format(fmt)
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def console_summary(
    change: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, **render
):
    """Render each event and hand every micro-batch to ``write``; returns the query."""
    lines = render_summary(change, **render).select("topic", "partition", "offset", "summary")
    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def tumbling_metrics(
    log: DataFrame,
    every: str = "2 seconds",
    delay: str = "1 minute",
    by: Sequence[str] = (),
    ts: str = "timestamp",
    size: str = "message_bytes",
    latency: str = "latency_ms",
) -> DataFrame:
    """Messages, bytes, rates and latency per fixed window, with a watermark.

    One pass over the stream, so percentiles are approximate, and the last windows stay open.  Exact ones, for all
    windows, come from :func:`window_rows` and :func:`window_metrics`.
    """
    seconds = F.unix_timestamp("window.end") - F.unix_timestamp("window.start")
    counted = (
        log.withWatermark(ts, delay)
        .groupBy(F.window(ts, every), *by)
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.sum(size).alias("bytes"),
            F.percentile_approx(latency, 0.5).alias("approx_p50"),
            F.percentile_approx(latency, 0.99).alias("approx_p99"),
        )
    )
    return counted.select(
        F.col("window.start").alias("window_start"),
        *by,
        "messages",
        "bytes",
        (F.col("messages") / seconds).alias("msg_s"),
        (F.col("bytes") / F.lit(MB) / seconds).alias("mb_s"),
        (F.col("bytes") / F.col("messages")).alias("avg_bytes"),
        "approx_p50",
        "approx_p99",
    )


def window_rows(
    log: DataFrame,
    every: str = "2 seconds",
    by: Sequence[str] = (),
    ts: str = "timestamp",
    size: str = "message_bytes",
    latency: str = "latency_ms",
) -> DataFrame:
    """The narrow rows that window metrics need; consume them to a folder as they come.  Works on a stream."""
    start = F.window(ts, every).getField("start")
    return log.select(start.alias("window_start"), *by, F.col(size).alias("message_bytes"), F.col(latency).alias("latency_ms"))


def window_metrics(rows: DataFrame, seconds: float, by: Sequence[str] = (), closed_before: Column | None = None) -> DataFrame:
    """Messages, bytes, rates, median and P99 latency of the consumed rows' windows.

    The median is the mean of the two middle values and P99 the element at index ``n * 99 div 100``, as in a batch.
    ``closed_before`` leaves out windows that end later; without it all windows are finished, also the last ones.
    """
    keys = ["window_start", *by]
    if closed_before is not None:
        rows = rows.where(F.unix_micros("window_start") + int(seconds * 1_000_000) <= F.unix_micros(closed_before))
    ranks = {"__low": lower_middle, "__high": upper_middle, "p99": percentile_rank(99)}
    exact = order_statistics(rows, keys, "latency_ms", ranks)
    middle = (F.col("__low").cast("double") + F.col("__high").cast("double")) / 2
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("messages"), F.sum("message_bytes").alias("bytes"))
    return counted.join(exact.select(*keys, middle.alias("p50"), "p99"), keys, "left").select(
        *keys,
        "messages",
        "bytes",
        (F.col("messages") / F.lit(float(seconds))).alias("msg_s"),
        (F.col("bytes") / F.lit(MB) / F.lit(float(seconds))).alias("mb_s"),
        (F.col("bytes") / F.col("messages")).alias("avg_bytes"),
        "p50",
        "p99",
    )


def idle_sessions(
    log: DataFrame, idle: str, by: Sequence[str], ts: str = "timestamp", delay: str = "1 minute"
) -> DataFrame:
    """Runs of messages ended by a silence longer than ``idle``."""
    return (
        log.withWatermark(ts, delay)
        .groupBy(F.session_window(ts, idle).alias("session"), *by)
        .agg(F.count(F.lit(1)).alias("messages"), F.max(ts).alias("last_message"))
        .select(F.col("session.start").alias("session_start"), *by, "messages", "last_message")
    )


def latest_state(change: DataFrame, pk: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest event per key as streaming state, for update or complete mode.

    By position, so backfill and live events may arrive in any order.  Deleted keys
    stay in the state as deletes; filter them when reading.
    """
    return latest_per_key(settling(change), pk, order) if "op" in change.columns else latest_per_key(change, pk, order)


def materialize_stream(
    change: DataFrame, target: str, pk: Sequence[str], order: Sequence[str], checkpoint: str
):
    """Deliver the newest event per key of each micro-batch; returns the query.

    :func:`live_rows` reads the table back.  No state is held between batches.
    """
    return (
        change.writeStream.foreachBatch(
            lambda batch, batch_id: upsert_batch(batch, batch_id, target, pk, order)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def live_rows(
    spark: SparkSession, target: str, pk: Sequence[str], order: Sequence[str], op: str = "op"
) -> DataFrame:
    """Current rows of a target written by :func:`materialize_stream`: its base, if it was compacted, and later batches."""
    return latest_per_key(delivered(spark, target), pk, order).where(F.col(op).isin(*LIVE_OPS))


def dedupe_stream(
    change: DataFrame,
    key: Sequence[str] = ("topic", "partition", "offset"),
    ts: str = "timestamp",
    delay: str = "10 minutes",
) -> DataFrame:
    """Drop redelivered events that arrive within ``delay`` of the first copy."""
    return change.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def late_rows(query) -> int:
    """Rows dropped by the watermark in all reported progress of a query."""
    return sum(
        int(state.numRowsDroppedByWatermark)
        for progress in query.recentProgress
        for state in progress.stateOperators
    )


def progress_lag(query) -> list[tuple[str, int, int]]:
    """``(topic, partition, lag)`` from the last progress of a Kafka query."""
    found = []
    progress = query.lastProgress
    for source in progress.sources if progress else []:
        latest, ended = (json.loads(o or "{}") for o in (source.latestOffset, source.endOffset))
        for topic, partitions in latest.items():
            for partition, offset in partitions.items():
                done = ended.get(topic, {}).get(partition, 0)
                found.append((topic, int(partition), max(0, offset - done)))
    return found


def lag_series(end: DataFrame, committed: DataFrame) -> DataFrame:
    """Consumer lag per topic and sample time."""
    return consumer_lag(end, committed, by=("topic", "ts"))

"""Exact window metrics that are kept up batch by batch.

Each batch stores its narrow rows by day, and only windows that the batch has rows of are computed again, from the days
they lie on.  A window's newest result counts, so rows may come late and in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import latest_per_key
from ..sources.tables import compact_parts, deliver, delivered
from .jobs import window_metrics


def touched_rows(batch: DataFrame, staged: DataFrame, by: Sequence[str]) -> DataFrame:
    """Staged rows of the windows that the batch has rows of.

    Days outside the batch are not read, nor are row groups outside its range of windows: both are literals in the scan.
    """
    facts = batch.agg(F.min("window_start").alias("a"), F.max("window_start").alias("b"), F.collect_set("day").alias("days")).first()
    near = staged.where(F.col("day").isin(facts["days"]) & F.col("window_start").between(facts["a"], facts["b"]))
    windows = batch.select("window_start", *by).distinct()
    return near.join(windows, ["window_start", *by], "left_semi")


def settle_windows(batch: DataFrame, number: int, staging: str, target: str, seconds: float, by: Sequence[str] = ()) -> None:
    """Store the rows of one batch (as made by ``window_rows``) and compute its windows again.  A retry changes nothing."""
    spark = batch.sparkSession
    # Rows without a time are in no window.
    rows = batch.where(F.col("window_start").isNotNull()).withColumn("day", F.unix_date(F.to_date("window_start")))
    deliver(rows.sortWithinPartitions("day", "window_start"), number, staging, ["day"])
    if rows.isEmpty():
        return
    metrics = window_metrics(touched_rows(rows, delivered(spark, staging, partitioned=True), by), seconds, by)
    deliver(metrics.withColumn("settled_in", F.lit(number).cast("long")), number, target)


def window_stream(rows: DataFrame, staging: str, target: str, seconds: float, checkpoint: str, by: Sequence[str] = ()):
    """Keep up the windows of a stream of ``window_rows``; returns the query.  :func:`settled_windows` reads them."""
    return (
        rows.writeStream.foreachBatch(lambda batch, number: settle_windows(batch, number, staging, target, seconds, by))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def settled_windows(spark: SparkSession, target: str, by: Sequence[str] = ()) -> DataFrame:
    """The newest result of every window, with the batch that gave it in ``settled_in``."""
    return latest_per_key(delivered(spark, target), ["window_start", *by], ["settled_in"])


def compact_windows(spark: SparkSession, target: str, by: Sequence[str] = ()) -> int | None:
    """Merge the results of all finished batches into one base; returns the last batch merged."""
    return compact_parts(spark, target, lambda found: latest_per_key(found, ["window_start", *by], ["settled_in"]))

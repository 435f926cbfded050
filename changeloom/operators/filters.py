"""Row filters.  All are plain predicates, so Spark can push them into a scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_tables(change: DataFrame, include: Sequence[str], column: str = "table") -> DataFrame:
    """Keep captured tables."""
    return change.where(F.col(column).isin(*include))


def filter_ops(change: DataFrame, ops: Sequence[str], column: str = "op") -> DataFrame:
    """Keep operations."""
    return change.where(F.col(column).isin(*ops))


def is_recent(column: str, as_of: str, interval: str = "1 YEAR") -> Column:
    """``column >= as_of - interval``.

    The bound is computed from literals, so the scan gets a constant to compare.
    """
    bound = F.expr(f"TIMESTAMP_NTZ '{as_of}' - INTERVAL {interval}")
    return F.col(column) >= bound


def in_previous_year(column: str, as_of: str) -> Column:
    """The calendar year before the year of ``as_of``, as a half-open range."""
    year = int(as_of[:4]) - 1
    low = F.expr(f"TIMESTAMP_NTZ '{year}-01-01 00:00:00'")
    high = F.expr(f"TIMESTAMP_NTZ '{year + 1}-01-01 00:00:00'")
    return (F.col(column) >= low) & (F.col(column) < high)


def recent_rows(
    df: DataFrame, column: str, as_of: str, interval: str = "1 YEAR", variant: str = "interval"
) -> DataFrame:
    """Rows of the last ``interval``, the last 365 days or the last calendar year."""
    if variant == "calendar_year":
        return df.where(in_previous_year(column, as_of))
    if variant == "days_365":
        interval = "365 DAYS"
    elif variant != "interval":
        raise ValueError(f"unknown variant {variant!r}")
    return df.where(is_recent(column, as_of, interval))


def with_condition(
    df: DataFrame, predicate: str | None, key: str | None = None, lo=None, hi=None
) -> DataFrame:
    """A key range and a user predicate, joined by AND."""
    if key is not None and lo is not None:
        df = df.where(F.col(key) >= F.lit(lo))
    if key is not None and hi is not None:
        df = df.where(F.col(key) <= F.lit(hi))
    return df.where(F.expr(predicate)) if predicate else df


def valid_latency(
    log: DataFrame, arrival_ms: str, ts_ms: str, out: str = "latency_ms"
) -> DataFrame:
    """``arrival - ts`` where the time is positive and the result not negative."""
    return log.withColumn(out, F.col(arrival_ms) - F.col(ts_ms)).where(
        (F.col(ts_ms) > 0) & (F.col(out) >= 0)
    )


def valid_lag(samples: DataFrame, lag: str = "lag") -> DataFrame:
    """Drop samples whose lag is unknown (negative)."""
    return samples.where(F.col(lag) >= 0)

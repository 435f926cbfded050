"""Exact order statistics without sorting or collecting a group.

The first level counts rows per slice of a logarithmic scale; each further level
splits the slice that still holds the wanted element into equal parts and counts
again.  Counting is a partial aggregation, so one group may hold any number of rows.
A slice is tightened to the smallest and largest value seen in it.  The last step
ranks the distinct values left.  The answer is exact for any data; the levels only
make the last step small.

After the first count, rows outside the wanted slices are dropped where they are read:
a table of fixed size holds, for each hash slot of the groups, the range that each rank
still needs.  Only rows inside those ranges are shuffled to meet their group's slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .joins import salted_join

# Slices per unit of the logarithm in the first level, and per range in the others.
LOG_SLICES = 1_024
SLICES = 65_536
TARGET_SALTS = 64
# Groups share so many slots of the table that rows are checked with before they are shuffled.
RANGE_SLOTS = 4_096


def percentile_rank(percent: int):
    """0-based index ``n * percent div 100``, kept inside the group."""

    def index(n: Column) -> Column:
        at = F.floor(n * F.lit(percent) / F.lit(100)).cast("long")
        return F.least(at, n - 1)

    return index


def lower_middle(n: Column) -> Column:
    return F.floor((n - 1) / 2).cast("long")


def upper_middle(n: Column) -> Column:
    return F.floor(n / 2).cast("long")


def order_statistics(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    ranks: dict,
    levels: int = 2,
) -> DataFrame:
    """One row per group with ``n`` and the element at each named rank.

    ``ranks`` maps an output name to a function from the row count to a 0-based
    index.  Null values are ignored.  ``by`` must name at least one column.
    """
    by = list(by)
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("__v"))
    targets = _first_level(rows, by, ranks)
    rows = _near(rows, targets, by, ranks)
    for _ in range(levels - 1):
        targets = _narrow(rows, targets, by)
    final = _in_range(rows, targets, by).groupBy(*by, "__stat", "__v").agg(
        F.count(F.lit(1)).alias("__c"), F.first("n").alias("n"), F.first("__at").alias("__at")
    )
    picked = _locate(final, by, "__v").select(*by, "n", "__stat", "__v")
    return picked.groupBy(*by).agg(
        F.first("n").alias("n"),
        *[
            F.max(F.when(F.col("__stat") == name, F.col("__v"))).alias(name)
            for name in ranks
        ],
    )


def _first_level(rows, by, ranks):
    """The slice of each wanted element, for all ranks from one count of the rows."""
    v = F.col("__v").cast("double")
    slice_no = F.signum(v) * F.floor(F.log1p(F.abs(v)) * LOG_SLICES)
    counts = (
        rows.withColumn("__slice", slice_no.cast("int"))
        .groupBy(*by, "__slice")
        .agg(F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    )
    group = W.partitionBy(*by)
    running = counts.select(
        *by,
        "__lo",
        "__hi",
        "__c",
        F.sum("__c").over(group).alias("n"),
        F.sum("__c")
        .over(group.orderBy("__slice").rowsBetween(W.unboundedPreceding, 0))
        .alias("__upto"),
    )
    wanted = [
        F.struct(F.lit(name).alias("stat"), rank(F.col("n")).alias("at"))
        for name, rank in ranks.items()
    ]
    located = running.withColumn("__w", F.explode(F.array(*wanted))).where(_holds("__w.at"))
    skipped = F.col("__upto") - F.col("__c")
    return located.select(
        *by,
        "n",
        "__lo",
        "__hi",
        F.col("__w.stat").alias("__stat"),
        (F.col("__w.at") - skipped).alias("__at"),
    )


def _holds(at):
    """The running count passes the wanted index in this row."""
    return (F.col("__upto") > F.col(at)) & (F.col("__upto") - F.col("__c") <= F.col(at))


def _slot(by):
    return F.pmod(F.xxhash64(*by), F.lit(RANGE_SLOTS)).cast("int")


def _near(rows, targets, by, ranks):
    """Rows inside a range of their slot, checked in the scan's stage.

    A slot's range for a rank spans those of all its groups, so no wanted row is lost,
    and the table has ``RANGE_SLOTS`` entries whatever the number of groups.
    """
    names = list(ranks)
    ends = [
        (F.min(F.when(F.col("__stat") == n, F.col("__lo"))), F.max(F.when(F.col("__stat") == n, F.col("__hi")))) for n in names
    ]
    # Every slot has an entry, so an entry's place in the sorted array is its slot.
    every = rows.sparkSession.range(RANGE_SLOTS).select(F.col("id").cast("int").alias("__slot"))
    held = targets.select(_slot(by).alias("__slot"), "__stat", "__lo", "__hi").unionByName(every, allowMissingColumns=True)
    spans = held.groupBy("__slot").agg(
        *[c.alias(f"{end}{i}") for i, pair in enumerate(ends) for end, c in zip(("lo", "hi"), pair)]
    )
    table = spans.agg(F.array_sort(F.collect_list(F.struct("__slot", *spans.columns[1:])))).scalar()
    span = F.element_at(table, _slot(by) + 1)
    inside = [F.col("__v").between(span.getField(f"lo{i}"), span.getField(f"hi{i}")) for i in range(len(names))]
    return rows.where(reduce(or_, inside))


def _in_range(rows, targets, by):
    joined = salted_join(rows, targets, by, "inner", TARGET_SALTS)
    return joined.where(F.col("__v").between(F.col("__lo"), F.col("__hi")))


def _locate(counts, by, order):
    """The row in which the running count first passes the wanted index."""
    upto = W.partitionBy(*by, "__stat").orderBy(order)
    running = counts.withColumn(
        "__upto", F.sum("__c").over(upto.rowsBetween(W.unboundedPreceding, 0))
    )
    return running.where(_holds("__at"))


def _narrow(rows, targets, by):
    # Halved before subtracting, so that the width cannot overflow.
    v, lo, hi = (F.col(c).cast("double") / 2 for c in ("__v", "__lo", "__hi"))
    share = F.when(hi > lo, (v - lo) / (hi - lo)).otherwise(F.lit(0.0))
    slice_no = F.least(F.floor(share * SLICES), F.lit(SLICES - 1)).cast("int")
    counts = (
        _in_range(rows, targets, by)
        .withColumn("__slice", slice_no)
        .groupBy(*by, "__stat", "__slice")
        .agg(
            F.count(F.lit(1)).alias("__c"),
            F.min("__v").alias("__lo"),
            F.max("__v").alias("__hi"),
            F.first("n").alias("n"),
            F.first("__at").alias("__at"),
        )
    )
    hit = _locate(counts, by, "__slice")
    skipped = F.col("__upto") - F.col("__c")
    return hit.select(
        *by, "n", "__lo", "__hi", "__stat", (F.col("__at") - skipped).alias("__at")
    )


def exact_percentile(
    df: DataFrame, by: Sequence[str], value: str, percents: dict[str, int], levels: int = 2
) -> DataFrame:
    """Element at index ``n * percent div 100`` of the sorted values, per group."""
    ranks = {name: percentile_rank(percent) for name, percent in percents.items()}
    return order_statistics(df, by, value, ranks, levels)


def median_of(
    df: DataFrame, by: Sequence[str], value: str, out: str = "median", levels: int = 2
) -> DataFrame:
    """Mean of the two middle values, per group."""
    found = order_statistics(
        df, by, value, {"__low": lower_middle, "__high": upper_middle}, levels
    )
    middle = (F.col("__low").cast("double") + F.col("__high").cast("double")) / 2
    return found.select(*by, "n", middle.alias(out))


def approx_percentile(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    percents: dict[str, int],
    accuracy: int = 10_000,
) -> DataFrame:
    """One-pass approximate percentiles; rank error at most ``n / accuracy``."""
    return df.groupBy(*by).agg(
        *[
            F.percentile_approx(value, percent / 100.0, accuracy).alias(name)
            for name, percent in percents.items()
        ]
    )

"""Ordered windows over groups of any size.

A plain ``Window.partitionBy(group).orderBy(...)`` puts a whole group into one
task, which fails when one topic, partition or key holds a third of the rows.
The functions here cut every group into blocks: the caller names expressions
that never decrease along the sort order (``offset >> 20``, an hour number, a
date and a key range).  Work inside a block is an ordinary window; what crosses
a block edge travels through a table with one row per block.

The blocks come from the data alone, so a recomputed task sees the same blocks.
Rows are shuffled once: the join that brings the block carry back uses the
columns the window was partitioned by.

Group and block columns must not be null, and the order must be total.
"""

from __future__ import annotations

from collections.abc import Sequence
from copy import copy

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .joins import hot_keys

Key = str | Column

# Blocks of a whole-number column are taken together in groups of ``2**SUPER_BITS`` numbers.
SUPER_BITS = 12


def long_block(name: Key, bits: int = 20) -> Column:
    """Blocks of ``2**bits`` consecutive values of a LONG."""
    return F.shiftright(_col(name).cast("long"), bits)


def time_block(name: Key, seconds: int = 3600) -> Column:
    """Blocks of ``seconds`` seconds of a timestamp."""
    return F.floor(F.unix_timestamp(_col(name)) / F.lit(seconds)).cast("long")


# Bounds that cut a range into parts of about equal row counts; a power of two, less one.
BOUNDS = 1_023


def bounds_of(value: Column) -> Column:
    """Aggregate: ``BOUNDS`` rising values that cut the rows into parts of about equal size."""
    shares = F.array(*[F.lit(i / (BOUNDS + 1)) for i in range(1, BOUNDS + 1)])
    return F.percentile_approx(value, shares, 10 * (BOUNDS + 1))


def place_among(bounds: Column, value: Column) -> Column:
    """How many of the rising bounds are below the value, by binary search.

    A value that is a bound itself gets an odd number, so that it does not share a part with others;
    all other numbers are even.
    """
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(BOUNDS.bit_length()))])

    def step(at: Column, size: Column) -> Column:
        bound = F.get(bounds, at + size - 1)
        return F.when(F.coalesce(bound < value, F.lit(False)), at + size).otherwise(at)

    below = F.aggregate(steps, F.lit(0), step)
    return below * 2 + F.when(F.coalesce(F.get(bounds, below) == value, F.lit(False)), 1).otherwise(0)


def _number(df: DataFrame, name: str) -> Column:
    """The column as a number that never decreases along its order."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        # The first six bytes say enough to cut a range; ties stay in one part.
        head = F.rpad(F.hex(F.substring(F.encode(F.col(name), "UTF-8"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def range_block(df: DataFrame, name: str, rows: int = 1 << 20) -> Column:
    """Parts of the range of a column with about ``rows`` rows in each, however the values are spread.

    Bounds come from one pass with a sketch of fixed size, made when the plan is built, so an outlier does not stretch the
    parts; very large tables cut each part into equal slices.  Only rows of equal value always stay together.
    """
    return range_blocks(df, [name], rows)[0]


def range_blocks(df: DataFrame, names: Sequence[str], rows: int = 1 << 20) -> list[Column]:
    """:func:`range_block` for a composite key: where one value of a column fills parts by itself, the next column
    cuts them further."""
    numbers = [_number(df, n) for n in names]
    # One row of bounded size reaches the driver; as literals, the bounds are the same in every task.
    facts = df.select(F.count(F.lit(1)).alias("n"), *[bounds_of(v).alias(f"b{i}") for i, v in enumerate(numbers)]).first()
    slices = max(1, -(-facts["n"] // (rows * (BOUNDS + 1))))
    blocks, alone = [], F.lit(True)
    for i, value in enumerate(numbers):
        bounds = F.array(*[F.lit(float(x)) for x in facts[f"b{i}"] or []]).cast("array<double>")
        place = place_among(bounds, value)
        part = F.floor(place / 2).cast("int")
        low, high = F.get(bounds, part - 1), F.get(bounds, part)
        # Inside a part, equal slices of its own range; the outer parts have one open end and stay whole.
        share = F.when((place % 2 == 0) & (high > low), (value - low) / (high - low)).otherwise(F.lit(0.0))
        code = place.cast("long") * (1 << 32) + F.least(F.floor(share * slices), F.lit(slices - 1))
        blocks.append(F.when(alone, code).otherwise(F.lit(0)).cast("long"))
        alone = alone & (place % 2 == 1)
    return blocks


def hot_block(df: DataFrame, by: Sequence[str], block: Column, share: int = 4_096) -> Column:
    """``block`` for groups with at least ``1/share`` of all rows, one block for others.

    For groups such as keys, most of which are small: they then cost one row in the
    block table, however far apart their rows lie.
    """
    hot = F.array_contains(hot_keys(df, by, share), F.xxhash64(*by))
    return F.when(hot, block).otherwise(F.lit(0)).cast("long")


def _col(key: Key) -> Column:
    return F.col(key) if isinstance(key, str) else key


class _Blocked:
    """A frame with its block and order columns attached under private names."""

    def __init__(self, df, by, order, block):
        self.names = df.columns
        self.by = list(by)
        self.blocks = [f"__block{i}" for i in range(len(block))]
        self.order = [f"__order{i}" for i in range(len(order))]
        self.df = df.select(
            "*",
            *[_col(c).alias(n) for c, n in zip(block, self.blocks)],
            *[_col(c).alias(n) for c, n in zip(order, self.order)],
        )
        self.group = [*self.by, *self.blocks]
        self.local = W.partitionBy(*self.group).orderBy(*self.order)
        self.within = W.partitionBy(*self.by, "__super").orderBy(*self.blocks)
        self.across = W.partitionBy(*self.by).orderBy("__super")

    def per_block(self, *aggs: Column) -> DataFrame:
        """One row per block, with ``__super``: blocks next to each other, so that no task sorts them all."""
        table = self.df.groupBy(*self.group).agg(*aggs)
        first = F.col(self.blocks[0])
        whole = isinstance(table.schema[self.blocks[0]].dataType, T.IntegralType)
        return table.withColumn("__super", F.shiftright(first, SUPER_BITS) if whole else first)

    def per_super(self, blocks: DataFrame, *aggs: Column) -> DataFrame:
        return blocks.groupBy(*self.by, "__super").agg(*aggs)

    def on(self, df: DataFrame) -> _Blocked:
        """The same blocks over a frame with more columns."""
        other = copy(self)
        other.df = df
        return other

    def carry_in(self, local: DataFrame, carried: DataFrame) -> DataFrame:
        return local.join(carried, on=self.group, how="left")

    def result(self, df: DataFrame, *extra: Column) -> DataFrame:
        return df.select(*[F.col(f"`{n}`") for n in self.names], *extra)


def running_sum(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Key],
    block: Sequence[Key],
    value: Column,
    out: str,
    total: str | None = None,
) -> DataFrame:
    """Running sum of ``value`` within ``by``; optionally the group total too."""
    b = _Blocked(df.withColumn("__value", value), by, order, block)
    names = [n for n in b.names if n != "__value"]
    local = b.df.withColumn(
        "__local", F.sum("__value").over(b.local.rowsBetween(W.unboundedPreceding, 0))
    )
    sums = b.per_block(F.sum("__value").alias("__sum"))
    columns = [*b.by, "__super", F.sum("__all").over(b.across.rowsBetween(W.unboundedPreceding, -1)).alias("__earlier")]
    if total:
        columns.append(F.sum("__all").over(W.partitionBy(*b.by)).alias("__total"))
    supers = b.per_super(sums, F.sum("__sum").alias("__all")).select(*columns)
    inside = F.sum("__sum").over(b.within.rowsBetween(W.unboundedPreceding, -1))
    carried = (
        sums.withColumn("__inside", inside)
        .join(supers, on=[*b.by, "__super"])
        .withColumn("__before", F.coalesce("__inside", F.lit(0)) + F.coalesce("__earlier", F.lit(0)))
    )
    joined = b.carry_in(local, carried.select(*b.group, "__before", *(["__total"] if total else [])))
    extra = [
        (F.coalesce("__local", F.lit(0)) + F.coalesce("__before", F.lit(0))).alias(out)
    ]
    if total:
        extra.append(F.col("__total").alias(total))
    b.names = names
    return b.result(joined, *extra)


def row_index(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Key],
    block: Sequence[Key],
    out: str = "row_index",
    start: int = 0,
    total: str | None = None,
) -> DataFrame:
    """Position of each row within ``by``, counted from ``start``."""
    counted = running_sum(df, by, order, block, F.lit(1).cast("long"), out, total)
    return counted.withColumn(out, F.col(out) + F.lit(start - 1))


# ``monotonically_increasing_id`` holds the partition above so many bits, the row's place in it below.
PLACE_BITS = 33


def range_index(df: DataFrame, order: Sequence[str], out: str = "row_index", start: int = 0) -> DataFrame:
    """Position of each row of the whole frame along ``order``, counted from ``start``; null comes first.

    Rows are range partitioned and sorted once and written to the shared folder with their place, so that they are not
    sorted again by each plan that reads them, and equal rows keep their position.  One count per
    partition goes through the driver.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "range-index")
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id())
    placed.write.parquet(path)
    kept = spark.read.schema(placed.schema).parquet(path)
    part = F.shiftright("__place", PLACE_BITS)
    counts = sorted(tuple(r) for r in kept.groupBy(part).agg(F.count(F.lit(1))).collect())
    parts, befores, total = [], [], start
    for number, rows in counts:
        parts.append(number)
        befores.append(total)
        total += rows
    starts = pa.table({"__part": pa.array(parts, pa.int64()), "__before": pa.array(befores, pa.int64())})
    within = F.col("__place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    met = kept.withColumn("__part", part).join(spark.createDataFrame(starts), on="__part")
    return met.select(*[F.col(f"`{n}`") for n in df.columns], (F.col("__before") + within).alias(out))


def _neighbour(df, by, order, block, columns, step):
    b = _Blocked(df, by, order, block)
    picked = F.struct(*[_col(c).alias(n) for n, c in columns.items()])
    frame = b.df.withColumn("__picked", picked)
    shift = F.lag if step < 0 else F.lead
    edge = F.max_by if step < 0 else F.min_by
    local = frame.withColumn("__near", shift("__picked").over(b.local))
    if len(b.order) == 1:
        # One maximum per column: Spark can hash-aggregate plain values, but has to
        # sort for a struct.
        kept = [edge(f"__picked.{n}", b.order[0]).alias(n) for n in columns]
        edges = b.on(frame).per_block(*kept)
        edges = edges.select(*b.group, "__super", F.struct(*columns).alias("__edge"))
    else:
        edges = b.on(frame).per_block(edge("__picked", F.struct(*b.order)).alias("__edge"))
    # The neighbouring block of the same super-block, or else the nearest block of the super-block beyond.
    nearest = b.per_super(edges, edge("__edge", F.struct(*b.blocks)).alias("__edge"))
    beyond = nearest.select(*b.by, "__super", shift("__edge").over(b.across).alias("__beyond"))
    carried = (
        edges.withColumn("__beside", shift("__edge").over(b.within))
        .join(beyond, on=[*b.by, "__super"])
        .select(*b.group, F.coalesce("__beside", "__beyond").alias("__far"))
    )
    joined = b.carry_in(local, carried)
    near = F.coalesce("__near", "__far")
    return b.result(joined, *[near.getField(n).alias(n) for n in columns])


def previous(df, by, order, block, columns: dict[str, Key]) -> DataFrame:
    """Add values of the row before, as ``{new name: column}``; null at the start."""
    return _neighbour(df, by, order, block, columns, -1)


def following(df, by, order, block, columns: dict[str, Key]) -> DataFrame:
    """Add values of the row after, as ``{new name: column}``; null at the end."""
    return _neighbour(df, by, order, block, columns, 1)


def moving_mean(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Key],
    block: Sequence[Key],
    value: str,
    width: int,
    out: str,
    rows_per_block: int = 65_536,
) -> DataFrame:
    """Centred mean over ``width // 2`` rows on each side, cut at the ends.

    Groups with fewer than ``width`` rows keep their values.  Rows near a block
    edge are copied into the neighbouring block so that each frame is complete.
    """
    half = width // 2
    indexed = row_index(df, by, order, block, "__idx", total="__n")
    home = F.floor(F.col("__idx") / rows_per_block)
    first = F.floor(F.greatest(F.col("__idx") - half, F.lit(0)) / rows_per_block)
    last = F.floor((F.col("__idx") + half) / rows_per_block)
    copies = indexed.withColumn("__home", home).withColumn(
        "__part", F.explode(F.sequence(first, last))
    )
    frame = W.partitionBy(*by, "__part").orderBy("__idx").rowsBetween(-half, half)
    smoothed = copies.withColumn("__mean", F.avg(value).over(frame)).where(
        F.col("__part") == F.col("__home")
    )
    return smoothed.select(
        *df.columns,
        F.when(F.col("__n") < width, F.col(value).cast("double"))
        .otherwise(F.col("__mean"))
        .alias(out),
    )

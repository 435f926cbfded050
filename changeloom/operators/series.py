"""Operators over samples in time order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import duration_text
from .aggregates import MB
from .blocks import Key, following, long_block, moving_mean, previous, row_index, running_sum, time_block
from .joins import salted_join
from .order_stats import TARGET_SALTS, lower_middle, order_statistics, percentile_rank, upper_middle

FILL_STEP = 4_096


def sample_series(
    log: DataFrame,
    every: int,
    by: Sequence[str],
    ts: str = "timestamp",
    size: str = "message_bytes",
    latency: str = "latency_ms",
) -> DataFrame:
    """One row per fixed window of ``every`` seconds and group.

    Rates, mean size and exact latency median and P99; windows without messages
    give zeros.  ``bucket`` is the window start in epoch seconds.
    """
    every = int(every)
    start = (F.floor(F.unix_timestamp(ts) / every) * every).cast("long")
    rows = log.select(*by, start.alias("bucket"), F.col(size).alias("__s"), F.col(latency).alias("__l"))
    keys = [*by, "bucket"]
    totals = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("messages"), F.sum("__s").alias("bytes")
    )
    ranks = {"__low": lower_middle, "__high": upper_middle, "p99": percentile_rank(99)}
    stats = order_statistics(rows, keys, "__l", ranks, levels=1).drop("n")
    spans = totals.groupBy(*by).agg(F.min("bucket").alias("__a"), F.max("bucket").alias("__b"))
    filled = _every_bucket(spans, by, every)
    wide = filled.join(totals, on=keys, how="left").join(stats, on=keys, how="left")
    zero = F.lit(0)
    count = F.coalesce("messages", zero.cast("long"))
    total = F.coalesce("bytes", zero.cast("long"))
    median = (F.col("__low").cast("double") + F.col("__high").cast("double")) / 2
    return wide.select(
        *keys,
        count.alias("messages"),
        total.alias("bytes"),
        (count / F.lit(every)).alias("msg_s"),
        (total / F.lit(MB) / F.lit(every)).alias("mb_s"),
        F.when(count > 0, total / count).otherwise(0.0).alias("avg_bytes"),
        F.coalesce(median, F.lit(0.0)).alias("p50"),
        F.coalesce(F.col("p99").cast("double"), F.lit(0.0)).alias("p99"),
    )


def _every_bucket(spans: DataFrame, by: Sequence[str], every: int) -> DataFrame:
    """All window starts between ``__a`` and ``__b``, generated in two steps.

    The outer step makes one row per ``FILL_STEP`` windows, so no row ever holds
    an array longer than that.
    """
    stride = every * FILL_STEP
    coarse = spans.select(
        *by, "__b", F.explode(F.sequence(F.col("__a"), F.col("__b"), F.lit(stride))).alias("__s")
    )
    last = F.least(F.col("__b"), F.col("__s") + F.lit(stride - every))
    return coarse.select(
        *by, F.explode(F.sequence(F.col("__s"), last, F.lit(every).cast("long"))).alias("bucket")
    )


def cumulative(
    series: DataFrame,
    by: Sequence[str],
    order: str,
    value: str,
    expected: int | None = None,
    bits: int = 20,
) -> DataFrame:
    """Running total of a series, and its share of the expected total in percent."""
    total = running_sum(series, by, [order], [long_block(order, bits)], F.col(value), "cumulative")
    if expected is None:
        return total
    return total.withColumn("pct_of_expected", F.col("cumulative") * 100.0 / F.lit(expected))


def flatten_stats(raw: DataFrame) -> DataFrame:
    """Sum the per-interface and per-device counters of nested container samples."""

    def interfaces(name):
        return F.aggregate(
            F.map_values("networks"),
            F.lit(0).cast("long"),
            lambda acc, v: acc + F.coalesce(v.getField(name), F.lit(0)),
        )

    def devices(op):
        hits = F.filter("blkio", lambda e: F.lower(e.getField("op")) == op)
        return F.aggregate(
            hits, F.lit(0).cast("long"), lambda acc, e: acc + F.coalesce(e.getField("value"), F.lit(0))
        )

    def or_zero(c):
        return F.coalesce(c, F.lit(0).cast("long"))

    return raw.select(
        *[c for c in raw.columns if c not in ("networks", "blkio")],
        or_zero(interfaces("rx_bytes")).alias("net_rx"),
        or_zero(interfaces("tx_bytes")).alias("net_tx"),
        or_zero(devices("read")).alias("disk_read"),
        or_zero(devices("write")).alias("disk_write"),
    )


def counter_rates(
    samples: DataFrame,
    counters: Sequence[str],
    by: Sequence[str] = ("container",),
    ts: str = "ts",
    block_seconds: int = 3600,
) -> DataFrame:
    """MB/s of each counter since the sample before; 0 for the first sample.

    ``ts`` is a timestamp; two samples are taken at least 1 ms apart.
    """
    prior = previous(
        samples,
        by,
        [ts],
        [time_block(ts, block_seconds)],
        {"__ts": ts, **{f"__{c}": c for c in counters}},
    )
    seconds = F.greatest(_seconds(F.col(ts)) - _seconds(F.col("__ts")), F.lit(0.001))
    rates = [
        F.when(F.col("__ts").isNull(), F.lit(0.0))
        .otherwise((F.col(c) - F.col(f"__{c}")) / F.lit(MB) / seconds)
        .alias(f"{c}_mb_s")
        for c in counters
    ]
    return prior.select(*samples.columns, *rates)


def _seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000.0)


def cpu_percent(
    samples: DataFrame,
    by: Sequence[str] = ("container",),
    ts: str = "ts",
    block_seconds: int = 3600,
) -> DataFrame:
    """CPU share since the sample before, in percent of one core.

    Uses cpu_total, system_cpu and online_cpus; 0 for the first sample or when the
    system counter did not advance.
    """
    prior = previous(
        samples,
        by,
        [ts],
        [time_block(ts, block_seconds)],
        {"__cpu": "cpu_total", "__sys": "system_cpu"},
    )
    used = F.col("cpu_total") - F.col("__cpu")
    passed = F.col("system_cpu") - F.col("__sys")
    cores = F.coalesce(F.col("online_cpus"), F.lit(1))
    share = F.when(passed > 0, used / passed * cores * 100.0)
    return prior.select(*samples.columns, F.coalesce(share, F.lit(0.0)).alias("cpu_pct"))


def memory_rss(samples: DataFrame) -> DataFrame:
    """Add resident memory without page cache, in MB and percent of the limit."""
    rss = F.col("mem_usage") - F.coalesce(F.col("cache"), F.lit(0))
    return samples.select(
        "*",
        (rss / F.lit(MB)).alias("mem_mb"),
        (F.col("mem_limit") / F.lit(MB)).alias("mem_limit_mb"),
        F.when(F.col("mem_limit") > 0, rss / F.col("mem_limit") * 100.0)
        .otherwise(0.0)
        .alias("mem_pct"),
    )


def drain_rate_eta(
    samples: DataFrame,
    by: Sequence[str] = ("topic",),
    ts: str = "ts",
    block_seconds: int = 3600,
) -> DataFrame:
    """Whole-number drain rate and time left from consecutive lag samples.

    Needs end_offset and committed.  Lag is never below 0.  The rate is 0 and the
    time unknown (``--``) for a first sample or when the lag did not fall.
    """
    lag = F.greatest(F.col("end_offset") - F.col("committed"), F.lit(0))
    seconds = F.unix_timestamp(ts)
    base = samples.withColumn("lag", lag).withColumn("__t", seconds)
    prior = previous(
        base, by, [ts], [time_block(ts, block_seconds)], {"__lag": "lag", "__before": "__t"}
    )
    elapsed = F.col("__t") - F.col("__before")
    drained = F.col("__lag") - F.col("lag")
    rate = F.when((elapsed > 0) & (drained > 0), F.floor(drained / elapsed)).otherwise(F.lit(0))
    staged = prior.withColumn("rate", F.coalesce(rate, F.lit(0)).cast("long"))
    eta = F.when(F.col("rate") > 0, F.floor(F.col("lag") / F.col("rate")))
    consumed = F.when(
        F.col("end_offset") > 0,
        F.floor((F.col("end_offset") - F.col("lag")) * 100 / F.col("end_offset")),
    ).otherwise(F.lit(0))
    return staged.select(
        *[c for c in samples.columns if c != "lag"],
        "lag",
        consumed.cast("long").alias("consumed_pct"),
        "rate",
        duration_text(eta).alias("eta"),
    )


def smooth(
    series: DataFrame, by: Sequence[str], order: str, value: str, width: int = 5,
    out: str = "smoothed", bits: int = 20,
) -> DataFrame:
    """Centred moving mean, cut at the ends; short series stay as they are."""
    return moving_mean(series, by, [order], [long_block(order, bits)], value, width, out)


def phase_durations(
    starts: DataFrame, by: Sequence[str] = ("run",), ts: str = "ts", rows: str = "rows",
    block_seconds: int = 86_400,
) -> DataFrame:
    """Time from each phase start to the next one, with rows and rows/s.

    The last phase of a run has no next start and gets null.
    """
    nexts = following(starts, by, [ts], [time_block(ts, block_seconds)], {"__next": ts})
    seconds = _seconds(F.col("__next")) - _seconds(F.col(ts))
    return nexts.select(
        *starts.columns,
        seconds.alias("duration_sec"),
        F.when(seconds > 0, F.col(rows) / seconds).alias("rows_s"),
    )


def stop_at_idle(
    log: DataFrame,
    idle_seconds: int,
    by: Sequence[str],
    ts: str = "timestamp",
    limit: int | None = None,
    order: Sequence[Key] = (),
    block_seconds: int = 60,
) -> DataFrame:
    """Messages up to the first silence longer than the limit, at most ``limit``.

    Messages in one time slot of the idle length are never further apart than
    that, so a long silence can only lie between two slots: first and last time
    per slot are enough to find it.  ``order`` breaks ties of equal times.
    """
    idle = idle_seconds * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    slots = (
        log.select(*by, micros.alias("__t"))
        .groupBy(*by, F.floor(F.col("__t") / idle).alias("__slot"))
        .agg(F.min("__t").alias("__a"), F.max("__t").alias("__b"))
    )
    ahead = F.lead("__a").over(W.partitionBy(*by).orderBy("__slot"))
    cuts = (
        slots.select(*by, "__b", (ahead - F.col("__b")).alias("__gap"))
        .groupBy(*by)
        .agg(F.min(F.when(F.col("__gap") > idle, F.col("__b"))).alias("__cut"))
    )
    joined = salted_join(log.withColumn("__t", micros), cuts, by, "left", TARGET_SALTS)
    kept = joined.where(F.col("__cut").isNull() | (F.col("__t") <= F.col("__cut")))
    if limit is not None:
        kept = row_index(
            kept,
            by,
            ["__t", *order],
            [F.floor(F.col("__t") / F.lit(block_seconds * 1_000_000))],
            "__row",
            start=1,
        ).where(F.col("__row") <= limit)
    return kept.select(*log.columns)

"""Totals and rates.  All of them aggregate before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .order_stats import order_statistics, lower_middle, percentile_rank, upper_middle

MB = 1_048_576


def per_second(amount: Column, seconds: Column) -> Column:
    """``amount / seconds``, 0 when no time passed."""
    return F.when(seconds > 0, amount / seconds).otherwise(F.lit(0.0))


def key_value_sizes(log: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Add key, value and message bytes; a missing part counts 0."""
    key_bytes = F.coalesce(F.octet_length(key), F.lit(0)).cast("long")
    value_bytes = F.coalesce(F.octet_length(value), F.lit(0)).cast("long")
    return log.select(
        "*",
        key_bytes.alias("key_bytes"),
        value_bytes.alias("value_bytes"),
        (key_bytes + value_bytes).alias("message_bytes"),
    )


def message_summary(
    log: DataFrame,
    by: Sequence[str],
    size: str = "message_bytes",
    arrival: str = "arrival",
    start: Column | None = None,
    end: str = "last_message",
    run_end: Column | None = None,
) -> DataFrame:
    """Count, bytes, MB, elapsed seconds, rates and mean size per group.

    Time runs from ``start`` (default: the first message) to the last message or,
    with ``end='run_end'``, to ``run_end``.  ``arrival`` is in epoch seconds.
    """
    totals = log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(size).alias("total_bytes"),
        F.min(arrival).alias("first_arrival"),
        F.max(arrival).alias("last_arrival"),
    )
    began = F.col("first_arrival") if start is None else start
    ended = F.col("last_arrival") if end == "last_message" else run_end
    seconds = (ended - began).cast("double")
    mb = F.col("total_bytes") / F.lit(MB)
    return totals.select(
        *by,
        "messages",
        "total_bytes",
        mb.alias("total_mb"),
        seconds.alias("elapsed_sec"),
        per_second(F.col("messages"), seconds).alias("msg_s"),
        per_second(mb, seconds).alias("mb_s"),
        F.when(F.col("messages") > 0, F.col("total_bytes") / F.col("messages"))
        .otherwise(0.0)
        .alias("avg_bytes"),
    )


def size_and_latency(
    log: DataFrame, by: Sequence[str], size: str = "message_bytes", latency: str = "latency_ms"
) -> DataFrame:
    """Exact median and P99 size, and exact median, P95 and P99 latency per group."""
    middle = {"__low": lower_middle, "__high": upper_middle}

    def medians(name):
        low, high = F.col("__low").cast("double"), F.col("__high").cast("double")
        return ((low + high) / 2).alias(name)

    sizes = order_statistics(log, by, size, {**middle, "p99_size": percentile_rank(99)}).select(
        *by, medians("median_size"), "p99_size"
    )
    latencies = order_statistics(
        log,
        by,
        latency,
        {**middle, "p95_latency": percentile_rank(95), "p99_latency": percentile_rank(99)},
    ).select(*by, medians("median_latency"), "p95_latency", "p99_latency")
    return sizes.join(latencies, on=list(by), how="left")


def op_counts(
    change: DataFrame, table: str = "table", op: str = "op", wide: bool = False
) -> DataFrame:
    """Events per table and operation; ``wide`` gives one column per operation."""
    grouped = change.groupBy(table)
    if wide:
        counted = grouped.pivot(op, ["r", "c", "u", "d"]).agg(F.count(F.lit(1)))
        return counted.na.fill(0, ["r", "c", "u", "d"])
    return change.groupBy(table, op).agg(F.count(F.lit(1)).alias("events"))


def format_sizes(df: DataFrame, schema_bytes: int, by: Sequence[str] = ()) -> DataFrame:
    """The same rows as lean JSON and as JSON that repeats the schema per message.

    One pass over the rows; ``value_bytes`` is the text of the values alone.
    """
    names = [c for c in df.columns if c not in by]
    lean = F.octet_length(F.to_json(F.struct(*names))).cast("long")
    values = sum(
        (F.coalesce(F.octet_length(F.col(n).cast("string")), F.lit(0)) for n in names),
        F.lit(0),
    ).cast("long")
    totals = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(lean).alias("lean"),
        F.sum(values).alias("payload_bytes"),
    )
    wrapped = F.col("lean") + F.col("messages") * F.lit(schema_bytes)
    formats = F.explode(
        F.array(
            F.struct(F.lit("json_lean").alias("format"), F.col("lean").alias("total_bytes")),
            F.struct(F.lit("json_schema").alias("format"), wrapped.alias("total_bytes")),
        )
    )
    return totals.select(*by, "messages", "payload_bytes", "lean", formats.alias("__f")).select(
        *by,
        "__f.format",
        "messages",
        "payload_bytes",
        "__f.total_bytes",
        (F.col("__f.total_bytes") / F.col("messages")).alias("avg_bytes"),
        (F.col("__f.total_bytes") / F.col("lean")).alias("vs_lean"),
    )


def useful_share(formats: DataFrame) -> DataFrame:
    """Add payload bytes divided by total bytes."""
    return formats.withColumn(
        "useful_share",
        F.when(F.col("total_bytes") > 0, F.col("payload_bytes") / F.col("total_bytes")),
    )


def task_rollup(status: DataFrame, tasks: str = "tasks", state: str = "state") -> DataFrame:
    """Tasks total, running and failed per row of ``status``, and whether it is healthy.

    Healthy means the connector runs, has a task, and every task runs.
    """

    def in_state(name):
        return F.size(F.filter(tasks, lambda t: t.getField("state") == name))

    counted = status.select(
        *[c for c in status.columns if c != tasks],
        F.coalesce(F.size(tasks), F.lit(0)).alias("tasks_total"),
        F.coalesce(in_state("RUNNING"), F.lit(0)).alias("tasks_running"),
        F.coalesce(in_state("FAILED"), F.lit(0)).alias("tasks_failed"),
    )
    healthy = (
        (F.col(state) == "RUNNING")
        & (F.col("tasks_total") > 0)
        & (F.col("tasks_running") == F.col("tasks_total"))
    )
    return counted.withColumn("healthy", F.coalesce(healthy, F.lit(False)))


def task_state_series(
    status: DataFrame, by: Sequence[str] = ("run", "elapsed"), tasks: str = "tasks"
) -> DataFrame:
    """Running and failed tasks per sample."""
    return (
        task_rollup(status, tasks)
        .groupBy(*by)
        .agg(
            F.sum("tasks_total").alias("tasks_total"),
            F.sum("tasks_running").alias("tasks_running"),
            F.sum("tasks_failed").alias("tasks_failed"),
        )
    )


def consumer_lag(
    end: DataFrame, committed: DataFrame, by: Sequence[str] = ("topic",)
) -> DataFrame:
    """Messages not yet committed per ``by``; a partition never committed counts whole."""
    parts = end.join(committed, on=[*by, "partition"], how="left")
    behind = F.greatest(
        F.lit(0), F.col("end_offset") - F.coalesce(F.col("committed"), F.lit(0))
    )
    return parts.groupBy(*by).agg(
        F.sum("end_offset").alias("end_offset"),
        F.sum(F.coalesce("committed", F.lit(0))).alias("committed"),
        F.sum(behind).alias("lag"),
    )


def lag_extremes(samples: DataFrame, by: Sequence[str], lag: str = "lag") -> DataFrame:
    """Peak and lowest lag, leaving out unknown values; 0 when none is known."""
    known = F.when(F.col(lag) >= 0, F.col(lag))
    return samples.groupBy(*by).agg(
        F.coalesce(F.max(known), F.lit(0)).alias("peak_lag"),
        F.coalesce(F.min(known), F.lit(0)).alias("min_lag"),
    )


def nonzero_mean(samples: DataFrame, by: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Mean of the values above 0 for each metric, 0 when there are none."""
    return samples.groupBy(*by).agg(
        *[
            F.coalesce(F.avg(F.when(F.col(m) > 0, F.col(m))), F.lit(0.0)).alias(m)
            for m in metrics
        ]
    )


def peak(samples: DataFrame, by: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Largest value of each metric, 0 when there are none."""
    return samples.groupBy(*by).agg(
        *[F.coalesce(F.max(m), F.lit(0)).alias(m) for m in metrics]
    )


def duplicate_keys(change: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Keys that appear more than once."""
    counted = change.groupBy(*pk).agg(F.count(F.lit(1)).alias("copies"))
    return counted.where(F.col("copies") > 1)


def table_check(df: DataFrame, key: str) -> DataFrame:
    """Row count, smallest and largest key."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min(key).alias("min_key"),
        F.max(key).alias("max_key"),
    )


def topic_sizes(log: DataFrame, topic: str = "topic", size: str = "message_bytes") -> DataFrame:
    """Messages, MB and mean bytes per topic, with a ``TOTAL`` row."""
    rolled = log.rollup(topic).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(size).alias("total_bytes"),
        F.grouping(topic).alias("__total"),
    )
    name = F.when(F.col("__total") == 1, F.lit("TOTAL")).otherwise(F.col(topic))
    return rolled.select(
        name.alias(topic),
        "messages",
        "total_bytes",
        (F.col("total_bytes") / F.lit(MB)).alias("total_mb"),
        (F.col("total_bytes") / F.col("messages")).alias("avg_bytes"),
    )


def health_rollup(checks: DataFrame, label: str = "label", ok: str = "ok") -> DataFrame:
    """PASS or FAIL per check, and a total row with both counts."""
    passed = F.coalesce(F.col(ok), F.lit(False))
    rolled = checks.rollup(label).agg(
        F.count_if(passed).alias("passed"),
        F.count_if(~passed).alias("failed"),
        F.grouping(label).alias("__total"),
    )
    return rolled.select(
        F.when(F.col("__total") == 1, F.lit("TOTAL")).otherwise(F.col(label)).alias(label),
        F.when(F.col("failed") == 0, "PASS").otherwise("FAIL").alias("result"),
        "passed",
        "failed",
    )


def end_offsets(log: DataFrame) -> DataFrame:
    """Log-end offset summed over the partitions of each topic."""
    ends = log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("__end"))
    return ends.groupBy("topic").agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("__end").alias("end_offset")
    )

"""Results of benchmark runs: one JSON document per execution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NUMBERS = "array<double>"

# The names in a result document.
RUN_FIELDS = {
    "connector": "string",
    "short_label": "string",
    "label": "string",
    "tasks_max": "int",
    "batch_size": "int",
    "queue_size": "int",
    "poll_ms": "int",
    "messages_consumed": "bigint",
    "total_time_sec": "double",
    "throughput_msg_sec": "double",
    "throughput_mb_sec": "double",
    "total_data_mb": "double",
    "avg_msg_size_bytes": "double",
    "peak_consumer_lag": "bigint",
    "min_consumer_lag": "bigint",
    "error": "string",
}
SERIES_FIELDS = (
    "elapsed_sec",
    "msg_rate",
    "mb_rate",
    "cumulative_msgs",
    "avg_size_bytes",
    "latency_p50_ms",
    "latency_p99_ms",
)
STATUS_FIELDS = {
    "elapsed": "double",
    "connector_state": "string",
    "tasks_running": "int",
    "tasks_failed": "int",
    "tasks_total": "int",
    "consumer_lag": "bigint",
}
SYSTEM_FIELDS = (
    "elapsed",
    "cpu_pct",
    "mem_mb",
    "mem_limit_mb",
    "mem_pct",
    "net_rx_mbps",
    "net_tx_mbps",
    "net_rx_total_mb",
    "net_tx_total_mb",
    "disk_read_mbps",
    "disk_write_mbps",
    "disk_read_total_mb",
    "disk_write_total_mb",
)


def _struct(fields) -> str:
    return "struct<" + ",".join(f"{n}:{t}" for n, t in fields.items()) + ">"


def result_schema() -> str:
    run = dict(RUN_FIELDS)
    run["timeseries"] = _struct({n: _NUMBERS for n in SERIES_FIELDS})
    run["connect_metrics"] = f"array<{_struct(STATUS_FIELDS)}>"
    run["system"] = f"map<string,array<{_struct({n: 'double' for n in SYSTEM_FIELDS})}>>"
    return f"results array<{_struct(run)}>"


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """All runs of all documents below ``path``, failed ones included."""
    documents = spark.read.schema(result_schema()).option("multiLine", True).json(path)
    return documents.select(F.explode("results").alias("r")).select("r.*")


def load_runs(spark: SparkSession, path: str) -> DataFrame:
    """Successful runs: those without an error."""
    return read_results(spark, path).where(F.col("error").isNull()).drop("error")


def run_samples(runs: DataFrame) -> DataFrame:
    """The time series of each run, one row per sample."""
    zipped = F.arrays_zip(*[F.col(f"timeseries.{n}").alias(n) for n in SERIES_FIELDS])
    return runs.select(F.col("connector").alias("run"), F.explode(zipped).alias("s")).select(
        "run", *[F.col("s").getField(n).alias(n) for n in SERIES_FIELDS]
    )


def connect_samples(runs: DataFrame) -> DataFrame:
    """Connector state and lag over time, one row per sample."""
    return runs.select(
        F.col("connector").alias("run"), F.explode("connect_metrics").alias("s")
    ).select("run", "s.*")


def sys_samples(runs: DataFrame) -> DataFrame:
    """Container resources over time, one row per run, container and sample."""
    return (
        runs.select(F.col("connector").alias("run"), F.explode("system").alias("container", "l"))
        .select("run", "container", F.explode("l").alias("s"))
        .select("run", "container", "s.*")
    )


def save_runs(runs: DataFrame, path: str, run_ts: str) -> None:
    """Append results under a timestamp; saving the same timestamp again replaces it."""
    runs.write.mode("overwrite").json(f"{path}/run_ts={run_ts}")


def saved_runs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All saved results, with ``run_ts``."""
    return spark.read.schema(f"{schema}, run_ts string").json(path)


def latest_runs(saved: DataFrame) -> DataFrame:
    """The results with the newest timestamp."""
    newest = saved.select(F.max("run_ts").alias("t")).scalar()
    return saved.where(F.col("run_ts") == newest)

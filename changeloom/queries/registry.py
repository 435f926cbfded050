"""Registry of queries, and the change logs the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.blocks import hot_block, long_block, previous, row_index

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

PARTITIONS = 4
CHUNK = 1_024
WINDOW = 4_000
AS_OF = "2001-08-01 00:00:00"


def query(sql: str | None = None, name: str | None = None):
    def register(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op_of(event_type: str = "event_type"):
    return (
        F.when(F.col(event_type) == "signup", "c")
        .when(F.col(event_type) == "view", "r")
        .when(F.col(event_type) == "error", "d")
        .otherwise("u")
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as changes of one row per user."""
    return table(spark, sf_dir, "events").select(
        F.lit("shop.events").alias("topic"),
        F.pmod("user_id", F.lit(PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("seq"),
        "ts",
        op_of().alias("op"),
        F.col("user_id").alias("pk"),
        "value",
        "props",
    )


def with_images(change: DataFrame) -> DataFrame:
    """Add before and after images holding ``value``."""
    block = hot_block(change, ["pk"], long_block("seq"))
    prior = previous(change, ["pk"], ["seq"], [block], {"prior": "value"})
    image = F.struct(F.col("value"))
    return prior.select(
        *change.columns,
        F.when(~F.col("op").isin("c", "r"), F.struct(F.col("prior").alias("value"))).alias("before"),
        F.when(F.col("op") != "d", image).alias("after"),
        F.lit(False).alias("is_tombstone"),
    )


def live_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read as changes of orders, numbered in a total order."""
    items = table(spark, sf_dir, "lineitem")
    order = [
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    ]
    block = ["l_shipdate", long_block("l_orderkey")]
    return row_index(items, [], order, block, "lsn", start=1).select(
        F.col("l_orderkey").alias("o_orderkey"),
        "lsn",
        F.when(F.col("l_returnflag") == "R", "d").otherwise("u").alias("op"),
        F.col("l_extendedprice").alias("o_totalprice"),
    )


def runs_of(spark: SparkSession, sf_dir: str, key: str = "event_type") -> DataFrame:
    """Events read as messages of benchmark runs, one run per ``key``."""
    per_run = table(spark, sf_dir, "events").groupBy(F.col(key).cast("string").alias("run")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.octet_length("props").cast("long")).alias("total_bytes"),
        F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("a"),
        F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("b"),
    )
    seconds = (F.col("b") - F.col("a")) / F.lit(1_000_000.0)
    return per_run.select(
        "run",
        "messages",
        seconds.alias("total_sec"),
        (F.col("messages") / seconds).alias("msg_s"),
        (F.col("total_bytes") / F.lit(1_048_576) / seconds).alias("mb_s"),
        (F.col("total_bytes") / F.lit(1_048_576)).alias("total_mb"),
        (F.col("total_bytes") / F.col("messages")).alias("avg_b"),
    )


CHANGE_SQL = f"""
change AS (
  SELECT 'shop.events' AS topic, CAST(user_id % {PARTITIONS} AS INTEGER) AS partition,
         event_id AS seq, ts,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         user_id AS pk, value, props
  FROM events)"""

IMAGES_SQL = f"""{CHANGE_SQL},
images AS (
  SELECT *, CASE WHEN op IN ('c', 'r') THEN NULL
                 ELSE lag(value) OVER (PARTITION BY pk ORDER BY seq) END AS before_value,
         CASE WHEN op = 'd' THEN NULL ELSE value END AS after_value
  FROM change)"""

LIVE_SQL = """
live AS (
  SELECT l_orderkey AS o_orderkey,
         row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                            l_quantity, l_extendedprice, l_discount, l_tax) AS lsn,
         CASE WHEN l_returnflag = 'R' THEN 'd' ELSE 'u' END AS op,
         l_extendedprice AS o_totalprice
  FROM lineitem)"""


def runs_sql(key: str = "event_type", name: str = "runs") -> str:
    return f"""
{name} AS (
  SELECT CAST({key} AS VARCHAR) AS run, count(*) AS messages,
         (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS total_sec,
         count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE) AS msg_s,
         CAST(sum(strlen(props)) AS BIGINT) / 1048576::DOUBLE
           / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE) AS mb_s,
         CAST(sum(strlen(props)) AS BIGINT) / 1048576::DOUBLE AS total_mb,
         CAST(sum(strlen(props)) AS BIGINT) / count(*)::DOUBLE AS avg_b
  FROM events GROUP BY 1)"""


def rounded(*names: str, digits: int = 6):
    return [F.round(F.col(n).cast("double"), digits).alias(n) for n in names]


def rounded_sql(*names: str, digits: int = 6) -> str:
    return ", ".join(f"round(CAST({n} AS DOUBLE), {digits}) AS {n}" for n in names)

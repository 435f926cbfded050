"""Message, size, latency and lag metrics over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import order_stats as O
from .registry import query, rounded, rounded_sql, table


def messages(spark, sf):
    """Events as messages: props is the value, the type the key and topic."""
    events = table(spark, sf, "events").select(
        F.col("event_type").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("user_id") % 3 != 0, F.col("event_type")).alias("key"),
        F.when(F.col("event_type") != "error", F.col("props")).alias("value"),
        F.col("value").alias("latency_ms"),
    )
    return A.key_value_sizes(events)


MESSAGES_SQL = """messages AS (
  SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset", ts,
         CAST(CASE WHEN user_id % 3 <> 0 THEN strlen(event_type) ELSE 0 END AS BIGINT) AS key_bytes,
         CAST(CASE WHEN event_type <> 'error' THEN strlen(props) ELSE 0 END AS BIGINT) AS value_bytes,
         CAST(CASE WHEN user_id % 3 <> 0 THEN strlen(event_type) ELSE 0 END
            + CASE WHEN event_type <> 'error' THEN strlen(props) ELSE 0 END AS BIGINT) AS message_bytes,
         value AS latency_ms
  FROM events)"""


@query(f"""WITH {MESSAGES_SQL} SELECT "offset", key_bytes, value_bytes, message_bytes FROM messages""")
def key_value_sizes(spark, sf):
    return messages(spark, sf).select("offset", "key_bytes", "value_bytes", "message_bytes")


@query(f"""WITH {MESSAGES_SQL}, totals AS (
  SELECT topic, count(*) AS messages, CAST(sum(message_bytes) AS BIGINT) AS total_bytes,
         (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS elapsed_sec FROM messages GROUP BY 1)
SELECT topic, messages, total_bytes, round(total_bytes / 1048576::DOUBLE, 6) AS total_mb,
       round(elapsed_sec, 3) AS elapsed_sec, round(messages / elapsed_sec, 6) AS msg_s,
       round(total_bytes / messages::DOUBLE, 6) AS avg_bytes FROM totals""")
def message_summary(spark, sf):
    log = messages(spark, sf).withColumn(
        "arrival", F.unix_micros(F.col("timestamp").cast("timestamp")) / F.lit(1_000_000.0)
    )
    return A.message_summary(log, ["topic"]).select(
        "topic",
        "messages",
        "total_bytes",
        *rounded("total_mb"),
        *rounded("elapsed_sec", digits=3),
        *rounded("msg_s", "avg_bytes"),
    )


_SORTED_SQL = """lat AS (SELECT topic, latency_ms, row_number() OVER (PARTITION BY topic ORDER BY latency_ms) - 1 AS i,
    count(*) OVER (PARTITION BY topic) AS n FROM messages)"""


@query(f"""WITH {MESSAGES_SQL}, {_SORTED_SQL}
SELECT topic, n, max(CASE WHEN i = n * 95 // 100 THEN latency_ms END) AS p95,
  max(CASE WHEN i = n * 99 // 100 THEN latency_ms END) AS p99 FROM lat GROUP BY 1, 2""")
def exact_percentile(spark, sf):
    return O.exact_percentile(messages(spark, sf), ["topic"], "latency_ms", {"p95": 95, "p99": 99})


@query(f"""WITH {MESSAGES_SQL}
SELECT topic, count(*) AS n, round(median(latency_ms), 6) AS median FROM messages GROUP BY 1""")
def median_of(spark, sf):
    return O.median_of(messages(spark, sf), ["topic"], "latency_ms").select(
        "topic", "n", *rounded("median")
    )


@query(f"""WITH {MESSAGES_SQL}, ranked AS (
  SELECT topic, latency_ms, message_bytes, count(*) OVER (PARTITION BY topic) AS n,
         row_number() OVER (PARTITION BY topic ORDER BY latency_ms) - 1 AS i,
         row_number() OVER (PARTITION BY topic ORDER BY message_bytes) - 1 AS j FROM messages)
SELECT topic, round(median(message_bytes), 6) AS median_size, max(CASE WHEN j = n * 99 // 100 THEN message_bytes END) AS p99_size,
  round(median(latency_ms), 6) AS median_latency,
  max(CASE WHEN i = n * 95 // 100 THEN latency_ms END) AS p95_latency,
  max(CASE WHEN i = n * 99 // 100 THEN latency_ms END) AS p99_latency FROM ranked GROUP BY 1""")
def size_and_latency(spark, sf):
    return A.size_and_latency(messages(spark, sf), ["topic"]).select(
        "topic", "p99_size", "p95_latency", "p99_latency", *rounded("median_size", "median_latency")
    )


@query(f"""WITH {MESSAGES_SQL}
SELECT topic, count(*) AS messages, TRUE AS p50_within, TRUE AS p99_within FROM messages GROUP BY 1""")
def approx_percentile(spark, sf):
    """Whether the approximate values keep the promised rank error of n / accuracy."""
    rows, accuracy = messages(spark, sf).select("topic", "latency_ms"), 10_000
    percents = {"p50": 50, "p99": 99}
    found = O.approx_percentile(rows, ["topic"], "latency_ms", percents, accuracy)
    value = F.col("latency_ms")
    counted = rows.join(found, "topic").groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"),
        *[F.count_if(value < F.col(p)).alias(f"{p}_below") for p in percents],
        *[F.count_if(value <= F.col(p)).alias(f"{p}_upto") for p in percents],
    )
    slack = F.col("messages") / accuracy + 1

    def within(p):
        rank = F.col("messages") * percents[p] / 100
        return ((F.col(f"{p}_below") <= rank + slack) & (F.col(f"{p}_upto") >= rank - slack)).alias(f"{p}_within")

    return counted.select("topic", "messages", *[within(p) for p in percents])


@query(f"""WITH {MESSAGES_SQL}
SELECT coalesce(topic, 'TOTAL') AS topic, count(*) AS messages, CAST(sum(message_bytes) AS BIGINT) AS total_bytes,
  round(CAST(sum(message_bytes) AS BIGINT) / 1048576::DOUBLE, 6) AS total_mb,
  round(CAST(sum(message_bytes) AS BIGINT) / count(*)::DOUBLE, 6) AS avg_bytes
FROM messages GROUP BY ROLLUP (topic)""")
def topic_sizes(spark, sf):
    return A.topic_sizes(messages(spark, sf)).select(
        "topic", "messages", "total_bytes", *rounded("total_mb", "avg_bytes")
    )


@query(f"""WITH {MESSAGES_SQL}, ends AS (
  SELECT topic, partition, max("offset") + 1 AS e FROM messages GROUP BY 1, 2)
SELECT topic, count(*) AS partitions, CAST(sum(e) AS BIGINT) AS end_offset FROM ends GROUP BY 1""")
def end_offsets(spark, sf):
    return A.end_offsets(messages(spark, sf))


@query(f"""WITH {MESSAGES_SQL}, ends AS (
  SELECT topic, partition, max("offset") + 1 AS e,
         max(CASE WHEN key_bytes > 0 AND partition < 3 THEN "offset" END) + 5 AS c FROM messages GROUP BY 1, 2)
SELECT topic, CAST(sum(e) AS BIGINT) AS end_offset, CAST(sum(coalesce(c, 0)) AS BIGINT) AS committed,
  CAST(sum(greatest(0, e - coalesce(c, 0))) AS BIGINT) AS lag FROM ends GROUP BY 1""")
def consumer_lag(spark, sf):
    log = messages(spark, sf)
    end = log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    committed = (
        log.where((F.col("key_bytes") > 0) & (F.col("partition") < 3))
        .groupBy("topic", "partition")
        .agg((F.max("offset") + 5).alias("committed"))
    )
    return A.consumer_lag(end, committed)


def _lags(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("run"),
        F.when(F.col("value") < 5, -1).otherwise(F.floor("value")).cast("long").alias("lag"),
        F.when(F.col("user_id") % 2 == 0, F.lit(0.0)).otherwise(F.col("value")).alias("cpu_pct"),
        F.col("value").alias("mem_mb"),
    )


_LAGS_SQL = """lags AS (SELECT event_type AS run, CASE WHEN value < 5 THEN -1 ELSE CAST(floor(value) AS BIGINT) END AS lag,
  CASE WHEN user_id % 2 = 0 THEN 0.0 ELSE value END AS cpu_pct, value AS mem_mb FROM events)"""


@query(f"""WITH {_LAGS_SQL}
SELECT run, coalesce(max(lag) FILTER (lag >= 0), 0) AS peak_lag, coalesce(min(lag) FILTER (lag >= 0), 0) AS min_lag
FROM lags GROUP BY 1""")
def lag_extremes(spark, sf):
    return A.lag_extremes(_lags(spark, sf), ["run"])


@query(f"""WITH {_LAGS_SQL}
SELECT run, round(coalesce(avg(cpu_pct) FILTER (cpu_pct > 0), 0), 6) AS cpu_pct,
  round(coalesce(avg(mem_mb) FILTER (mem_mb > 0), 0), 6) AS mem_mb FROM lags GROUP BY 1""")
def nonzero_mean(spark, sf):
    return A.nonzero_mean(_lags(spark, sf), ["run"], ["cpu_pct", "mem_mb"]).select(
        "run", *rounded("cpu_pct", "mem_mb")
    )


@query(f"""WITH {_LAGS_SQL} SELECT run, coalesce(max(cpu_pct), 0) AS cpu_pct, coalesce(max(mem_mb), 0) AS mem_mb
FROM lags GROUP BY 1""")
def peak(spark, sf):
    return A.peak(_lags(spark, sf), ["run"], ["cpu_pct", "mem_mb"])


def _status(spark, sf):
    """Orders as status samples of connectors with one to three tasks."""
    states = F.array(F.lit("RUNNING"), F.lit("FAILED"), F.lit("PAUSED"))

    def task(i):
        at = F.when(F.col("o_custkey") % 3 == 0, 0).otherwise((F.col("o_orderkey") + i) % 3)
        return F.struct(i.alias("id"), F.get(states, at.cast("int")).alias("state"))

    tasks = F.transform(F.sequence(F.lit(1), (F.col("o_custkey") % 3 + 1).cast("int")), task)
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("elapsed"),
        F.col("o_orderpriority").alias("run"),
        F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("RUNNING").alias("state"),
        F.when(F.col("o_orderkey") % 10 != 0, tasks).alias("tasks"),
    )


_TASKS_SQL = """task AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CASE WHEN o_orderkey % 10 = 0 THEN NULL
    WHEN o_custkey % 3 = 0 THEN 0 ELSE (o_orderkey + i) % 3 END AS s
  FROM (SELECT *, unnest(range(1, CAST(o_custkey % 3 + 2 AS BIGINT))) AS i FROM orders)),
status AS (
  SELECT o_orderkey AS elapsed, o_orderpriority AS run, CASE WHEN o_orderstatus = 'F' THEN 'FAILED' ELSE 'RUNNING' END AS state,
    count(s) AS total, count(*) FILTER (s = 0) AS running, count(*) FILTER (s = 1) AS failed
  FROM task GROUP BY ALL)"""


@query(f"""WITH {_TASKS_SQL}
SELECT elapsed, run, state, CAST(total AS INTEGER) AS tasks_total, CAST(running AS INTEGER) AS tasks_running,
  CAST(failed AS INTEGER) AS tasks_failed, state = 'RUNNING' AND total > 0 AND running = total AS healthy FROM status""")
def task_rollup(spark, sf):
    return A.task_rollup(_status(spark, sf))


@query(f"""WITH {_TASKS_SQL}
SELECT run, elapsed // 100 AS slot, CAST(sum(total) AS BIGINT) AS tasks_total, CAST(sum(running) AS BIGINT) AS tasks_running,
  CAST(sum(failed) AS BIGINT) AS tasks_failed FROM status GROUP BY 1, 2""")
def task_state_series(spark, sf):
    status = _status(spark, sf).withColumn("slot", F.floor(F.col("elapsed") / 100))
    return A.task_state_series(status, ["run", "slot"])


_FORMATS_SQL = """totals AS (
  SELECT event_type, count(*) AS messages,
    CAST(sum(strlen('{"event_id":' || event_id || ',"user_id":' || user_id || ',"value":' || value || '}')) AS BIGINT) AS lean,
    CAST(sum(strlen(CAST(event_id AS VARCHAR)) + strlen(CAST(user_id AS VARCHAR)) + strlen(CAST(value AS VARCHAR))) AS BIGINT) AS payload_bytes
  FROM events GROUP BY 1),
formats AS (
  SELECT event_type, 'json_lean' AS format, messages, payload_bytes, lean AS total_bytes, lean FROM totals
  UNION ALL SELECT event_type, 'json_schema', messages, payload_bytes, lean + messages * 300, lean FROM totals)"""


def _formats(spark, sf):
    rows = table(spark, sf, "events").select("event_type", "event_id", "user_id", "value")
    return A.format_sizes(rows, 300, ["event_type"])


@query(f"""WITH {_FORMATS_SQL}
SELECT event_type, format, messages, payload_bytes, total_bytes, round(total_bytes / messages::DOUBLE, 6) AS avg_bytes,
  round(total_bytes / lean::DOUBLE, 6) AS vs_lean FROM formats""")
def format_sizes(spark, sf):
    return _formats(spark, sf).select(
        "event_type", "format", "messages", "payload_bytes", "total_bytes", *rounded("avg_bytes", "vs_lean")
    )


@query(f"""WITH {_FORMATS_SQL}
SELECT event_type, format, round(payload_bytes / total_bytes::DOUBLE, 6) AS useful_share FROM formats""")
def useful_share(spark, sf):
    return A.useful_share(_formats(spark, sf)).select("event_type", "format", *rounded("useful_share"))

"""Samples in time order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series as S
from .metrics import MESSAGES_SQL, messages
from .registry import query, rounded, table

EVERY = 21_600


def _series(spark, sf):
    return S.sample_series(messages(spark, sf), EVERY, ["topic"])


_SERIES_SQL = f"""{MESSAGES_SQL}, placed AS (
  SELECT *, epoch_us(ts) // 1000000 // {EVERY} * {EVERY} AS bucket FROM messages),
ranked AS (
  SELECT topic, bucket, latency_ms, message_bytes, row_number() OVER (PARTITION BY topic, bucket ORDER BY latency_ms) - 1 AS i,
         count(*) OVER (PARTITION BY topic, bucket) AS n FROM placed),
seen AS (
  SELECT topic, bucket, count(*) AS messages, CAST(sum(message_bytes) AS BIGINT) AS bytes, median(latency_ms) AS p50,
         max(CASE WHEN i = n * 99 // 100 THEN latency_ms END) AS p99 FROM ranked GROUP BY 1, 2),
slots AS (
  SELECT topic, unnest(range(min(bucket), max(bucket) + 1, {EVERY})) AS bucket FROM seen GROUP BY topic),
series AS (
  SELECT topic, bucket, coalesce(messages, 0) AS messages, coalesce(bytes, 0) AS bytes, coalesce(p50, 0) AS p50, coalesce(p99, 0) AS p99
  FROM slots LEFT JOIN seen USING (topic, bucket))"""


@query(f"""WITH {_SERIES_SQL}
SELECT topic, bucket, messages, bytes, round(messages / {EVERY}::DOUBLE, 6) AS msg_s,
  round(bytes / 1048576::DOUBLE / {EVERY}, 9) AS mb_s,
  round(CASE WHEN messages > 0 THEN bytes / messages::DOUBLE ELSE 0 END, 6) AS avg_bytes,
  round(p50, 6) AS p50, round(p99, 6) AS p99 FROM series""")
def sample_series(spark, sf):
    return _series(spark, sf).select(
        "topic", "bucket", "messages", "bytes", *rounded("msg_s", "avg_bytes", "p50", "p99"), *rounded("mb_s", digits=9)
    )


_COUNTS_SQL = f"""{MESSAGES_SQL}, series AS (
  SELECT topic, epoch_us(ts) // 1000000 // {EVERY} * {EVERY} AS bucket, count(*) AS messages FROM messages GROUP BY 1, 2)"""


def _counts(spark, sf):
    bucket = (F.floor(F.unix_timestamp("timestamp") / EVERY) * EVERY).cast("long")
    return messages(spark, sf).groupBy("topic", bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("messages")
    )


@query(f"""WITH {_COUNTS_SQL}
SELECT topic, bucket, messages, CAST(sum(messages) OVER w AS BIGINT) AS cumulative,
  round(CAST(sum(messages) OVER w AS BIGINT) * 100.0 / 2000000, 6)::DOUBLE AS pct_of_expected
FROM series WINDOW w AS (PARTITION BY topic ORDER BY bucket)""")
def cumulative(spark, sf):
    return S.cumulative(_counts(spark, sf), ["topic"], "bucket", "messages", 2_000_000, bits=16).select(
        "topic", "bucket", "messages", "cumulative", *rounded("pct_of_expected")
    )


@query(f"""WITH {_COUNTS_SQL}
SELECT topic, bucket, messages, round(avg(messages) OVER (
  PARTITION BY topic ORDER BY bucket ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS smoothed FROM series""")
def smooth(spark, sf):
    return S.smooth(_counts(spark, sf), ["topic"], "bucket", "messages", 5, bits=16).select(
        "topic", "bucket", "messages", *rounded("smoothed")
    )


def _samples(spark, sf):
    """Events as counter samples of containers (event types)."""
    nets = F.create_map(
        F.lit("eth0"),
        F.struct(
            (F.col("event_id") * 1_000).alias("rx_bytes"), (F.col("event_id") * 10).alias("tx_bytes")
        ),
        F.lit("eth1"),
        F.struct(F.col("user_id").alias("rx_bytes"), F.lit(5).cast("long").alias("tx_bytes")),
    )
    blkio = F.array(
        F.struct(F.lit("Read").alias("op"), (F.col("event_id") * 7).alias("value")),
        F.struct(F.lit("WRITE").alias("op"), (F.col("user_id") * 3).alias("value")),
        F.struct(F.lit("sync").alias("op"), F.lit(1).cast("long").alias("value")),
    )
    return table(spark, sf, "events").select(
        F.col("event_type").alias("container"),
        "ts",
        F.col("event_id"),
        nets.alias("networks"),
        blkio.alias("blkio"),
        (F.col("event_id") * 900).alias("cpu_total"),
        (F.col("event_id") * 4_000 - F.col("user_id") * 100_000).alias("system_cpu"),
        F.lit(4).alias("online_cpus"),
        (F.col("user_id") * 1_000_000).alias("mem_usage"),
        F.when(F.col("user_id") % 5 == 0, 0).otherwise(F.lit(1 << 30)).cast("long").alias("mem_limit"),
        (F.col("user_id") * 1_000).alias("cache"),
    )


@query("""SELECT event_id, event_id * 1000 + user_id AS net_rx, event_id * 10 + 5 AS net_tx,
  event_id * 7 AS disk_read, user_id * 3 AS disk_write FROM events""")
def flatten_stats(spark, sf):
    return S.flatten_stats(_samples(spark, sf)).select(
        "event_id", "net_rx", "net_tx", "disk_read", "disk_write"
    )


@query("""WITH flat AS (
  SELECT event_id, event_type, ts, event_id * 1000 + user_id AS net_rx, user_id * 3 AS disk_write FROM events),
steps AS (
  SELECT event_id, lag(ts) OVER w IS NULL AS first, net_rx - lag(net_rx) OVER w AS rx, disk_write - lag(disk_write) OVER w AS dw,
    greatest(epoch_us(ts) / 1000000.0::DOUBLE - epoch_us(lag(ts) OVER w) / 1000000.0::DOUBLE, 0.001) AS dt
  FROM flat WINDOW w AS (PARTITION BY event_type ORDER BY ts))
SELECT event_id, round(CASE WHEN first THEN 0 ELSE rx / 1048576::DOUBLE / dt END, 6) + 0.0 AS net_rx_mb_s,
  round(CASE WHEN first THEN 0 ELSE dw / 1048576::DOUBLE / dt END, 6) + 0.0 AS disk_write_mb_s FROM steps""")
def counter_rates(spark, sf):
    flat = S.flatten_stats(_samples(spark, sf))
    return S.counter_rates(flat, ["net_rx", "disk_write"]).select(
        "event_id", *rounded("net_rx_mb_s", "disk_write_mb_s")
    )


@query("""WITH steps AS (
  SELECT event_id, 900 * (event_id - lag(event_id) OVER w) AS cpu,
    4000 * (event_id - lag(event_id) OVER w) - 100000 * (user_id - lag(user_id) OVER w) AS sys
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts))
SELECT event_id, round(CASE WHEN sys > 0 THEN cpu / sys::DOUBLE * 4 * 100.0 ELSE 0 END, 6) AS cpu_pct FROM steps""")
def cpu_percent(spark, sf):
    return S.cpu_percent(_samples(spark, sf)).select("event_id", *rounded("cpu_pct"))


@query("""SELECT event_id, round(user_id * 999000 / 1048576::DOUBLE, 6) AS mem_mb,
  round(CASE WHEN user_id % 5 = 0 THEN 0 ELSE 1024 END::DOUBLE, 6) AS mem_limit_mb,
  round(CASE WHEN user_id % 5 = 0 THEN 0 ELSE user_id * 999000 / 1073741824::DOUBLE * 100 END, 6) AS mem_pct FROM events""")
def memory_rss(spark, sf):
    return S.memory_rss(_samples(spark, sf)).select(
        "event_id", *rounded("mem_mb", "mem_limit_mb", "mem_pct")
    )


@query("""WITH samples AS (
  SELECT event_id, event_type, ts, event_id * 10 AS end_offset, greatest(event_id * 10 - (event_id * 10 - event_id * 9 + CAST(floor(value * 1000) AS BIGINT)), 0) AS lag,
    epoch_us(ts) // 1000000 AS t FROM events),
steps AS (
  SELECT *, t - lag(t) OVER w AS elapsed, lag(lag) OVER w - lag AS drained FROM samples WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
rates AS (SELECT *, CASE WHEN elapsed > 0 AND drained > 0 THEN drained // elapsed ELSE 0 END AS rate FROM steps),
etas AS (SELECT *, CASE WHEN rate > 0 THEN lag // rate END AS s FROM rates)
SELECT event_id, lag, CASE WHEN end_offset > 0 THEN (end_offset - lag) * 100 // end_offset ELSE 0 END AS consumed_pct, rate,
  CASE WHEN s IS NULL THEN '--' WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm ' || (s % 60) || 's'
       ELSE (s // 3600) || 'h ' || (s % 3600 // 60) || 'm' END AS eta FROM etas""")
def drain_rate_eta(spark, sf):
    samples = table(spark, sf, "events").select(
        "event_id",
        F.col("event_type").alias("topic"),
        "ts",
        (F.col("event_id") * 10).alias("end_offset"),
        (F.col("event_id") + F.floor(F.col("value") * 1000)).alias("committed"),
    )
    return S.drain_rate_eta(samples).select("event_id", "lag", "consumed_pct", "rate", "eta")


@query("""WITH starts AS (
  SELECT user_id AS run, event_type, min(ts) AS ts, count(*) AS rows FROM events GROUP BY 1, 2),
nexts AS (SELECT *, lead(ts) OVER (PARTITION BY run ORDER BY ts) AS nx FROM starts)
SELECT run, event_type, rows, round(epoch_us(nx) / 1000000.0::DOUBLE - epoch_us(ts) / 1000000.0::DOUBLE, 3) AS duration_sec,
  round(rows / (epoch_us(nx) / 1000000.0::DOUBLE - epoch_us(ts) / 1000000.0::DOUBLE), 6) AS rows_s FROM nexts""")
def phase_durations(spark, sf):
    starts = table(spark, sf, "events").groupBy(F.col("user_id").alias("run"), "event_type").agg(
        F.min("ts").alias("ts"), F.count(F.lit(1)).alias("rows")
    )
    return S.phase_durations(starts).select(
        "run", "event_type", "rows", *rounded("duration_sec", digits=3), *rounded("rows_s")
    )


@query("""WITH gaps AS (
  SELECT event_type, ts, epoch_us(lead(ts) OVER (PARTITION BY event_type ORDER BY ts)) - epoch_us(ts) AS gap FROM events),
cuts AS (SELECT event_type, min(ts) AS cut FROM gaps WHERE gap > 7200000000 GROUP BY 1),
kept AS (SELECT e.* FROM events e LEFT JOIN cuts c USING (event_type) WHERE c.cut IS NULL OR e.ts <= c.cut)
SELECT event_type, event_id FROM kept QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 1500""")
def stop_at_idle(spark, sf):
    log = table(spark, sf, "events").select("event_type", "event_id", "ts")
    return S.stop_at_idle(log, 7_200, ["event_type"], "ts", 1_500, ["event_id"]).select(
        "event_type", "event_id"
    )

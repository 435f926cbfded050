"""Streams over the event files, run until all input is consumed."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import streaming as K
from ..session import scratch_path
from .registry import (
    CHANGE_SQL,
    CHUNK,
    LIVE_SQL,
    WINDOW,
    live_changes,
    op_of,
    query,
    rounded,
    table,
)


def event_stream(spark, sf):
    """The events file as a stream, with a time zone for watermarks."""
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query(f"""WITH {CHANGE_SQL}, last AS (
SELECT pk, seq, op, value FROM change QUALIFY row_number() OVER (PARTITION BY pk ORDER BY seq DESC) = 1)
SELECT * FROM last WHERE op <> 'd'""")
def stream_materialize(spark, sf):
    change = event_stream(spark, sf).select(
        F.col("user_id").alias("pk"), F.col("event_id").alias("seq"), op_of().alias("op"), "value"
    )
    root = scratch_path(spark, "stream-materialize")
    K.materialize_stream(
        change, f"{root}/table", ["pk"], ["seq"], f"{root}/checkpoint"
    ).awaitTermination()
    return K.live_rows(spark, f"{root}/table", ["pk"], ["seq"])


@query(f"""WITH {CHANGE_SQL}, last AS (
SELECT pk, seq, op, value FROM change QUALIFY row_number() OVER (PARTITION BY pk ORDER BY seq DESC) = 1)
SELECT * FROM last WHERE op <> 'd'""")
def stream_latest_removed(spark, sf):
    """Live rows kept by state from which deleted keys go, over several batches in any order."""
    root = scratch_path(spark, "stream-latest")
    change = table(spark, sf, "events").select(
        F.col("user_id").alias("pk"), F.col("event_id").alias("seq"), op_of().alias("op"), "value", F.col("ts").cast("timestamp").alias("ts")
    )
    change.repartition(4, F.xxhash64("seq")).write.parquet(f"{root}/log")
    stream = spark.readStream.schema(change.schema).option("maxFilesPerTrigger", "2").parquet(f"{root}/log")
    # The files are in no order of time, so nothing may be late.
    K.latest_stream(stream, f"{root}/table", ["pk"], ["seq"], "ts", f"{root}/checkpoint", "36500 days").awaitTermination()
    return K.live_rows(spark, f"{root}/table", ["pk"], ["seq"]).drop("ts")


@query("""SELECT event_id, user_id, event_type FROM events""")
def stream_dedupe(spark, sf):
    stream = event_stream(spark, sf).select("event_id", "user_id", "event_type", "ts")
    copies = F.when(F.col("event_type") == "click", F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    redelivered = stream.withColumn("copy", F.explode(copies)).drop("copy")
    deduped = K.dedupe_stream(redelivered, ["event_id"], "ts").drop("ts")
    root = scratch_path(spark, "stream-dedupe")
    K.consume_once(deduped, f"{root}/out", f"{root}/checkpoint")
    return spark.read.schema(deduped.schema).parquet(f"{root}/out")


@query("""WITH ranked AS (
  SELECT event_type AS topic, epoch_us(ts) // 21600000000 * 21600 AS bucket, strlen(props) AS size, value,
         count(*) OVER w AS n, row_number() OVER (w ORDER BY value) - 1 AS i
  FROM events WINDOW w AS (PARTITION BY event_type, epoch_us(ts) // 21600000000))
SELECT topic, bucket, count(*) AS messages, CAST(sum(size) AS BIGINT) AS bytes, round(count(*) / 21600::DOUBLE, 6) AS msg_s,
  round(sum(size) / count(*)::DOUBLE, 6) AS avg_bytes, round(median(value), 6) AS p50,
  round(max(CASE WHEN i = n * 99 // 100 THEN value END), 6) AS p99
FROM ranked GROUP BY 1, 2""")
def stream_tumbling_metrics(spark, sf):
    """All windows of the consumed stream, with the percentiles of a batch."""
    stream = event_stream(spark, sf).select(
        F.col("event_type").alias("topic"),
        F.col("ts").alias("timestamp"),
        F.octet_length("props").cast("long").alias("message_bytes"),
        F.col("value").alias("latency_ms"),
    )
    rows = K.window_rows(stream, "6 hours", ["topic"])
    root = scratch_path(spark, "stream-metrics")
    K.consume_once(rows, f"{root}/rows", f"{root}/checkpoint")
    windows = K.window_metrics(spark.read.schema(rows.schema).parquet(f"{root}/rows"), 6 * 3600, ["topic"])
    return windows.select(
        "topic",
        F.unix_timestamp("window_start").alias("bucket"),
        "messages",
        "bytes",
        *rounded("msg_s", "avg_bytes", "p50", "p99"),
    )


@query(f"""WITH {LIVE_SQL},
base AS (SELECT o_orderkey, o_totalprice, o_orderkey // {CHUNK} AS chunk_id FROM orders),
kept AS (
  SELECT o_orderkey, chunk_id * {WINDOW} + {WINDOW - 1} AS lsn, 'r' AS op, o_totalprice FROM base b WHERE NOT EXISTS (
    SELECT 1 FROM live l WHERE l.o_orderkey = b.o_orderkey
      AND l.lsn BETWEEN b.chunk_id * {WINDOW} AND b.chunk_id * {WINDOW} + {WINDOW - 1}))
SELECT * FROM kept UNION ALL SELECT o_orderkey, lsn, op, o_totalprice FROM live""")
def stream_backfill(spark, sf):
    """Orders backfilled in chunks while line items change them, as one stream."""
    root = scratch_path(spark, "stream-backfill")
    chunk = F.floor(F.col("o_orderkey") / CHUNK).cast("long").alias("chunk_id")
    columns = ["chunk_id", "o_orderkey", "lsn", "op", "o_totalprice"]
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", chunk)
    opened = F.col("chunk_id") * WINDOW
    reads = orders.select(
        F.lit("read").alias("kind"), "chunk_id", "o_orderkey", opened.alias("lsn"), F.lit("r").alias("op"), "o_totalprice"
    )
    edges = orders.select("chunk_id").distinct().select(
        "chunk_id",
        F.explode(
            F.array(
                F.struct(F.lit("open").alias("kind"), opened.alias("lsn")),
                F.struct(F.lit("close").alias("kind"), (opened + (WINDOW - 1)).alias("lsn")),
            )
        ).alias("m"),
    ).select("m.kind", "chunk_id", "m.lsn")
    live = live_changes(spark, sf).select(F.lit("live").alias("kind"), "*", chunk)
    log = reads.unionByName(live).unionByName(edges, allowMissingColumns=True)
    # Files without any order, a few per batch: reads and changes also come after their window has closed.
    log.select("kind", *columns).repartition(6, F.xxhash64("kind", "lsn", "o_orderkey")).write.parquet(f"{root}/log")
    stream = (
        spark.readStream.schema(spark.read.parquet(f"{root}/log").schema)
        .option("maxFilesPerTrigger", "2")
        .parquet(f"{root}/log")
    )
    K.backfill_stream(
        stream, f"{root}/staging", f"{root}/table", ["o_orderkey"], f"{root}/checkpoint"
    ).awaitTermination()
    return K.backfilled(spark, f"{root}/table").select("o_orderkey", "lsn", "op", "o_totalprice")

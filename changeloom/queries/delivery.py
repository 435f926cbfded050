"""Logs, targets and run results written to the shared folder and read back, and the remaining streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import streaming as K
from ..operators import audit as U
from ..operators import decode as D
from ..session import scratch_path
from ..sources import log as L
from ..sources import runs as R
from ..sources import tables as TB
from .registry import CHANGE_SQL, change_log, op_of, query, rounded, rounded_sql, runs_of, runs_sql, table
from .stream import event_stream


def _log(spark, sf, value):
    """Events written as a topic log; returns its path."""
    path = scratch_path(spark, "log")
    records = table(spark, sf, "events").select(
        F.concat(F.lit("shop."), F.col("event_type")).alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("user_id").cast("string").alias("key"),
        value.alias("value"),
    )
    L.write_log(records, path, batch="all")
    return path


@query("""SELECT 'shop.' || event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
  CAST(user_id AS VARCHAR) AS key, props AS value FROM events
WHERE event_type IN ('click', 'signup') AND (event_type = 'signup' OR user_id % 4 <> 1 OR event_id >= 500)""")
def read_log(spark, sf):
    """Two topics of a written log, one of them from a position on."""
    path = _log(spark, sf, F.col("props"))
    log = L.read_log(spark, path, topics=["shop.click", "shop.signup"], position={"shop.click": {"1": 500}, "shop.signup": {}})
    return log.select(
        "topic", "partition", "offset", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def _framed(spark, sf):
    header = F.concat(
        F.when(F.col("event_type") == "click", F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00"))),
        F.unhex(F.lpad(F.hex(F.lit(200) + F.length("event_type") * 1_000), 8, "0")),
    )
    return L.read_log(spark, _log(spark, sf, F.concat(header, F.col("props").cast("binary"))))


@query("""SELECT 'shop.' || event_type AS topic, event_id AS "offset", event_type <> 'click' AS magic_ok,
  CASE WHEN event_type <> 'click' THEN CAST(200 + length(event_type) * 1000 AS INTEGER) END AS schema_id,
  CASE WHEN event_type <> 'click' THEN props END AS body,
  CASE WHEN event_type <> 'click' THEN CAST(strlen(props) AS BIGINT) END AS body_size FROM events""")
def split_wire_header(spark, sf):
    """Framed bytes of a written log, with schema numbers that need more than one byte."""
    split = D.split_wire_header(_framed(spark, sf))
    return split.select("topic", "offset", "magic_ok", "schema_id", F.col("body").cast("string").alias("body"), "body_size")


@query("""SELECT 'shop.' || event_type AS topic, event_type <> 'click' AS magic_ok,
  CASE WHEN event_type <> 'click' THEN CAST(200 + length(event_type) * 1000 AS INTEGER) END AS schema_id,
  count(*) AS messages FROM events GROUP BY ALL""")
def wire_format_audit_of_log(spark, sf):
    return U.wire_format_audit(_framed(spark, sf))


_LAST_SQL = f"""WITH {CHANGE_SQL}, last AS (
SELECT pk, seq, op, value FROM change QUALIFY row_number() OVER (PARTITION BY pk ORDER BY seq DESC) = 1)"""


def _flat_stream(spark, sf):
    return event_stream(spark, sf).select(
        F.col("user_id").alias("pk"),
        F.col("event_id").alias("seq"),
        "value",
        F.when(op_of() == "d", "true").otherwise("false").alias("__deleted"),
    )


@query(f"""{_LAST_SQL} SELECT pk, seq, value FROM last WHERE op <> 'd'""")
def sink_upsert(spark, sf):
    """Delivered as a stream, compacted, delivered on top of the base, and read back."""
    root = scratch_path(spark, "upsert")
    target, keys = f"{root}/table", (["pk"], ["seq"])
    TB.sink_upsert(_flat_stream(spark, sf), target, *keys, f"{root}/checkpoint").awaitTermination()
    last = TB.compact_target(spark, target, *keys)
    again = table(spark, sf, "events").select(
        F.col("user_id").alias("pk"), F.col("event_id").alias("seq"), "value",
        F.when(op_of() == "d", "true").otherwise("false").alias("__deleted"),
    )
    TB.upsert_batch(again, last + 1, target, *keys)
    return TB.read_upserted(spark, target, *keys)


@query(f"""{_LAST_SQL} SELECT * FROM last""")
def stream_latest_state(spark, sf):
    """Newest event per key as streaming state, written by each micro-batch as it stands."""
    root = scratch_path(spark, "latest-state")
    change = event_stream(spark, sf).select(
        F.col("user_id").alias("pk"), F.col("event_id").alias("seq"), op_of().alias("op"), "value"
    )
    state = K.latest_state(change, ["pk"], ["seq"])
    writer = state.writeStream.outputMode("complete").option("checkpointLocation", f"{root}/checkpoint")
    writer = writer.foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{root}/state"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/state")


@query("""SELECT 'shop.' || event_type AS topic, count(*) AS lines, count(*) AS equal_to_batch FROM events GROUP BY 1""")
def stream_console_summary(spark, sf):
    """Rendered lines of a decoded stream, compared with those of a batch, per topic."""
    row = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])
    image = F.struct("user_id", "value")
    envelope = F.struct(
        F.when(op_of().isin("u", "d"), image).alias("before"),
        F.when(op_of() != "d", image).alias("after"),
        op_of().alias("op"),
        (F.col("event_id") * 1_000).alias("ts_ms"),
    )
    path = _log(spark, sf, F.to_json(envelope))
    root = scratch_path(spark, "summary")

    def lines(stream):
        return D.decode_json(L.read_log(spark, path, stream=stream), row, wrapped=False, pk=["user_id"])

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{root}/lines/batch_id={number}")

    K.console_summary(lines(True), write, f"{root}/checkpoint").awaitTermination()
    batch = D.render_summary(lines(False)).select("topic", "partition", "offset", F.col("summary").alias("want"))
    met = spark.read.parquet(f"{root}/lines").join(batch, ["topic", "partition", "offset"], "full")
    return met.groupBy("topic").agg(
        F.count("summary").alias("lines"), F.count_if(F.col("summary").eqNullSafe(F.col("want"))).alias("equal_to_batch")
    )


@query("""WITH marked AS (
  SELECT event_type AS topic, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 90 MINUTE THEN 0 ELSE 1 END AS begins
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
numbered AS (SELECT *, sum(begins) OVER (PARTITION BY topic ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked),
sessions AS (SELECT topic, s, min(ts) AS a, max(ts) AS b, count(*) AS messages FROM numbered GROUP BY 1, 2)
SELECT topic, CAST(epoch_us(a) AS BIGINT) AS session_start, messages, CAST(epoch_us(b) AS BIGINT) AS last_message FROM sessions
WHERE b + INTERVAL 90 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def stream_idle_sessions(spark, sf):
    """Sessions that the watermark has ended."""
    root = scratch_path(spark, "sessions")
    stream = event_stream(spark, sf).select(F.col("event_type").alias("topic"), "ts")
    ended = K.idle_sessions(stream, "90 minutes", ["topic"], "ts", "1 hour")
    K.consume_once(ended, f"{root}/out", f"{root}/checkpoint")
    found = spark.read.schema(ended.schema).parquet(f"{root}/out")
    return found.select(
        "topic", F.unix_micros("session_start").alias("session_start"), "messages", F.unix_micros("last_message").alias("last_message")
    )


def _dealt(spark, events, root, parts):
    """The rows as a stream of one file per part, one file a batch; parts are not in order of time."""
    part = F.pmod(F.xxhash64("event_id"), F.lit(parts))
    events.repartition(parts, part).write.parquet(f"{root}/in")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/in")


@query("""WITH marked AS (
  SELECT event_type AS topic, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 90 MINUTE THEN 0 ELSE 1 END AS begins
  FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
numbered AS (SELECT *, sum(begins) OVER (PARTITION BY topic ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked),
sessions AS (SELECT topic, s, min(ts) AS a, max(ts) AS b, count(*) AS messages FROM numbered GROUP BY 1, 2)
SELECT topic, CAST(epoch_us(a) AS BIGINT) AS session_start, messages, CAST(epoch_us(b) AS BIGINT) AS last_message,
  b + INTERVAL 90 MINUTE < (SELECT max(ts) FROM events) AS ended FROM sessions""")
def stream_sessions(spark, sf):
    """All sessions, the last ones too, of events that come in several batches without any order."""
    root, idle = scratch_path(spark, "all-sessions"), 90 * 60
    events = table(spark, sf, "events").select("event_id", F.col("event_type").alias("topic"), F.col("ts").cast("timestamp").alias("ts"))
    stream = _dealt(spark, events, root, 3)
    K.session_stream(stream, f"{root}/slots", idle, ["topic"], f"{root}/checkpoint", "ts").awaitTermination()
    newest = events.select(F.max("ts")).scalar()
    found = K.stored_sessions(spark, f"{root}/slots", idle, ["topic"], newest)
    return found.select(
        "topic", F.unix_micros("session_start").alias("session_start"), "messages", F.unix_micros("last_message").alias("last_message"), "ended"
    )


@query("""WITH ranked AS (
  SELECT event_type AS topic, epoch_us(ts) // 21600000000 * 21600 AS bucket, strlen(props) AS size, value,
         count(*) OVER w AS n, row_number() OVER (w ORDER BY value) - 1 AS i
  FROM events WINDOW w AS (PARTITION BY event_type, epoch_us(ts) // 21600000000))
SELECT topic, bucket, count(*) AS messages, CAST(sum(size) AS BIGINT) AS bytes, round(count(*) / 21600::DOUBLE, 6) AS msg_s,
  round(sum(size) / count(*)::DOUBLE, 6) AS avg_bytes, round(median(value), 6) AS p50,
  round(max(CASE WHEN i = n * 99 // 100 THEN value END), 6) AS p99
FROM ranked GROUP BY 1, 2""")
def stream_settled_windows(spark, sf):
    """Exact windows of events that come in several batches, each batch computing only the windows it has rows of."""
    root = scratch_path(spark, "settled-windows")
    events = table(spark, sf, "events").select(
        "event_id",
        F.col("event_type").alias("topic"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.octet_length("props").cast("long").alias("message_bytes"),
        F.col("value").alias("latency_ms"),
    )
    rows = K.window_rows(_dealt(spark, events, root, 3), "6 hours", ["topic"])
    K.window_stream(rows, f"{root}/rows", f"{root}/table", 6 * 3600, f"{root}/checkpoint", ["topic"]).awaitTermination()
    return K.settled_windows(spark, f"{root}/table", ["topic"]).select(
        "topic",
        F.unix_timestamp("window_start").alias("bucket"),
        "messages",
        "bytes",
        *rounded("msg_s", "avg_bytes", "p50", "p99"),
    )


@query("""WITH split AS (SELECT *, event_id * 2 >= (SELECT max(event_id) FROM events) AS early FROM events)
SELECT count(*) AS late FROM split WHERE NOT early
  AND date_trunc('millisecond', ts) < date_trunc('millisecond', (SELECT max(ts) FROM split WHERE early)) - INTERVAL 1 HOUR""")
def stream_late_rows(spark, sf):
    """The later half of the events comes first; what the watermark then drops of the rest is counted."""
    root = scratch_path(spark, "late")
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    half = events.select(F.max("event_id")).scalar()
    deduped = K.dedupe_stream(
        spark.readStream.schema(events.schema).parquet(f"{root}/in/*"), ["event_id"], "ts", "1 hour"
    )
    dropped = 0
    for number, part in enumerate((F.col("event_id") * 2 >= half, F.col("event_id") * 2 < half)):
        events.where(part).write.parquet(f"{root}/in/part{number}")
        writer = deduped.writeStream.format("parquet").option("path", f"{root}/out")
        run = writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        run.awaitTermination()
        dropped += K.late_rows(run)
    return spark.range(1).select(F.lit(dropped).cast("long").alias("late"))


@query("""WITH ends AS (
  SELECT event_type AS topic, epoch_us(ts) // 86400000000 AS day, CAST(user_id % 4 AS INTEGER) AS partition,
    max(event_id) + 1 AS e, max(CASE WHEN user_id % 4 < 3 AND value < 50 THEN event_id END) AS c FROM events GROUP BY 1, 2, 3)
SELECT topic, day, CAST(sum(e) AS BIGINT) AS end_offset, CAST(sum(coalesce(c, 0)) AS BIGINT) AS committed,
  CAST(sum(greatest(0, e - coalesce(c, 0))) AS BIGINT) AS lag FROM ends GROUP BY 1, 2""")
def lag_series(spark, sf):
    day = F.call_function("div", F.unix_micros(F.col("ts").cast("timestamp")), F.lit(86_400_000_000)).alias("ts")
    partition = F.pmod("user_id", F.lit(4)).cast("int").alias("partition")
    events = table(spark, sf, "events").select(F.col("event_type").alias("topic"), day, partition, "event_id", "value")
    keys = ["topic", "ts", "partition"]
    end = events.groupBy(*keys).agg((F.max("event_id") + 1).alias("end_offset"))
    committed = events.where("partition < 3 AND value < 50").groupBy(*keys).agg(F.max("event_id").alias("committed"))
    return K.lag_series(end, committed).withColumnRenamed("ts", "day")


@query(f"""WITH {runs_sql()}
SELECT run, messages, {rounded_sql('total_sec', 'msg_s')} FROM runs""")
def saved_runs(spark, sf):
    """Results saved under two times; the newest are read back."""
    path = scratch_path(spark, "runs")
    runs = runs_of(spark, sf).select("run", "messages", *rounded("total_sec", "msg_s"))
    R.save_runs(runs.withColumn("messages", F.col("messages") + 1), path, "20260101_000000")
    for _ in range(2):
        R.save_runs(runs, path, "20260102_000000")
    schema = "run string, messages bigint, total_sec double, msg_s double"
    return R.latest_runs(R.saved_runs(spark, path, schema)).drop("run_ts")


@query("""WITH runs AS (
  SELECT event_type AS run, count(*) AS messages, CAST(max(event_id) AS DOUBLE) AS v FROM events WHERE event_type <> 'error' GROUP BY 1)
SELECT run, messages, CAST(2 AS BIGINT) AS samples, v AS last_sample, 'RUNNING' AS state, v / 2 AS cpu_pct FROM runs""")
def load_runs(spark, sf):
    """Result documents written as JSON; the failed run is left out, series and samples are taken apart."""
    path = scratch_path(spark, "documents")
    counted = table(spark, sf, "events").groupBy(F.col("event_type").alias("connector")).agg(
        F.count(F.lit(1)).alias("messages_consumed"), F.max("event_id").cast("double").alias("v")
    )
    series = F.struct(*[F.array(F.lit(0.0), F.col("v")).alias(n) for n in R.SERIES_FIELDS])
    status = F.struct(F.lit("RUNNING").alias("connector_state"), F.lit(1).alias("tasks_running"))
    usage = F.create_map(F.lit("broker"), F.array(F.struct((F.col("v") / 2).alias("cpu_pct"))))
    run = F.struct(
        "connector", "messages_consumed", F.when(F.col("connector") == "error", "timed out").alias("error"),
        series.alias("timeseries"), F.array(status).alias("connect_metrics"), usage.alias("system"),
    )
    # One document of one run per event type.
    document = counted.agg(F.collect_list(run).alias("results"))
    document.select(F.to_json(F.struct("results"))).write.text(path)
    runs, last = R.load_runs(spark, path), R.SERIES_FIELDS[-1]
    samples = R.run_samples(runs).groupBy("run").agg(F.count(F.lit(1)).alias("samples"), F.max(last).alias("last_sample"))
    states = R.connect_samples(runs).select("run", F.col("connector_state").alias("state"))
    return (
        runs.select(F.col("connector").alias("run"), F.col("messages_consumed").cast("long").alias("messages"))
        .join(samples, "run")
        .join(states, "run")
        .join(R.sys_samples(runs).where("container = 'broker'").select("run", "cpu_pct"), "run")
    )

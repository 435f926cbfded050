"""Decoding, row images and filters."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fn
from ..operators import decode as D
from ..operators import filters as X
from ..sources import log as L
from .registry import (
    AS_OF,
    CHANGE_SQL,
    IMAGES_SQL,
    change_log,
    query,
    table,
    with_images,
)

ROW = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def wire_log(spark, sf, wrapped=True):
    """Events as envelope text; every delete is followed by a tombstone."""
    change = with_images(change_log(spark, sf))

    def image(side):
        return F.when(
            F.col(side).isNotNull(),
            F.struct(
                F.col("pk").alias("id"),
                F.substring("props", 1, 4).alias("kind"),
                F.col(f"{side}.value").alias("value"),
            ),
        ).alias(side)

    source = F.struct(
        F.lit("shop").alias("db"),
        F.lit("public").alias("schema"),
        F.lit("events").alias("table"),
        F.when(F.col("seq") % 2 == 0, F.lpad(F.hex("seq"), 8, "0")).alias("commit_lsn"),
    ).alias("source")
    envelope = F.struct(
        image("before"),
        image("after"),
        source,
        F.col("op"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
    )
    body = F.to_json(envelope)
    key = F.to_json(F.struct(F.col("pk").alias("id")))
    if wrapped:
        body = F.concat(F.lit('{"schema":{"type":"struct"},"payload":'), body, F.lit("}"))
        key = F.concat(F.lit('{"schema":{"type":"struct"},"payload":'), key, F.lit("}"))
    tomb = F.explode(
        F.when(F.col("op") == "d", F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    )
    encoded = change.select(
        F.lit("aw.shop.public.events").alias("topic"),
        "partition",
        (F.col("seq") * 2).alias("offset"),
        F.col("ts").alias("timestamp"),
        key.alias("key"),
        body.alias("value"),
        "op",
    )
    return encoded.withColumn("t", tomb).select(
        "topic",
        "partition",
        (F.col("offset") + F.col("t").cast("long")).alias("offset"),
        "timestamp",
        "key",
        F.when(~F.col("t"), F.col("value")).alias("value"),
    )


_WIRE_SQL = f"""{IMAGES_SQL}, wire AS (
  SELECT partition, seq * 2 AS "offset", FALSE AS is_tombstone, pk, op, seq, before_value, after_value,
         epoch_us(ts) // 1000 AS ts_ms FROM images
  UNION ALL
  SELECT partition, seq * 2 + 1, TRUE, pk, NULL, seq, NULL, NULL, NULL FROM images WHERE op = 'd')"""

_NAMES_SQL = """CASE op WHEN 'r' THEN 'SNAPSHOT' WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE'
  WHEN 'd' THEN 'DELETE' END"""


def _decoded(change):
    return change.select(
        "partition",
        "offset",
        "table",
        "op",
        "op_name",
        "ts_ms",
        "lsn",
        F.col("pk.id").alias("id"),
        F.col("before.value").alias("before_value"),
        F.col("after.value").alias("after_value"),
        "is_tombstone",
    )


_DECODED_SQL = f"""WITH {_WIRE_SQL}
SELECT partition, "offset", 'events' AS "table", op, {_NAMES_SQL} AS op_name, ts_ms,
       CASE WHEN op IS NOT NULL AND seq % 2 = 0 THEN printf('%08X', seq) END AS lsn, pk AS id,
       before_value, after_value, is_tombstone FROM wire"""


@query(_DECODED_SQL)
def decode_json_wrapped(spark, sf):
    return _decoded(D.decode_json(wire_log(spark, sf), ROW, True, ["id"]))


@query(_DECODED_SQL)
def decode_json_lean(spark, sf):
    return _decoded(D.decode_json(wire_log(spark, sf, False), ROW, False, ["id"]))


@query(f"""WITH {_WIRE_SQL}
SELECT "offset", is_tombstone, NOT is_tombstone AS is_event, FALSE AS is_unknown_op FROM wire""")
def classify(spark, sf):
    log = wire_log(spark, sf)
    op = F.get_json_object("value", "$.payload.op")
    return D.classify(log.withColumn("op", op)).select(
        "offset", "is_tombstone", "is_event", "is_unknown_op"
    )


@query(f"""WITH {_WIRE_SQL}
SELECT "offset", 'shop' AS source_db, 'public' AS source_schema, 'events' AS source_table,
       CASE WHEN seq % 2 = 0 THEN printf('%08X', seq) ELSE '?' END AS commit_lsn,
       strftime(epoch_ms(ts_ms), '%Y-%m-%d %H:%M:%S') AS shown_ts
FROM wire WHERE NOT is_tombstone""")
def envelope_meta(spark, sf):
    change = D.decode_json(wire_log(spark, sf), ROW).where(~F.col("is_tombstone"))
    return D.envelope_meta(change).select(
        "offset", "source_db", "source_schema", "source_table", "commit_lsn", "shown_ts"
    )


_DIFF_SQL = """coalesce(CAST(before_value AS VARCHAR), 'None') || ' -> '
         || coalesce(CAST(after_value AS VARCHAR), 'None')"""


@query(f"""WITH {IMAGES_SQL}
SELECT seq, CASE WHEN op = 'u' THEN CASE WHEN before_value IS DISTINCT FROM after_value THEN 1 ELSE 0 END END AS fields,
       CASE WHEN op = 'u' AND before_value IS DISTINCT FROM after_value THEN {_DIFF_SQL} END AS change
FROM images""")
def changed_fields(spark, sf):
    change = D.changed_fields(with_images(change_log(spark, sf)))
    return change.select(
        "seq",
        F.when(F.col("op") == "u", F.size("changed")).alias("fields"),
        F.element_at("changed", F.lit("value")).alias("change"),
    )


@query(f"""WITH {_WIRE_SQL}, shown AS (
  SELECT *, '[events] ' || {_NAMES_SQL} || ' | ' || strftime(epoch_ms(ts_ms), '%Y-%m-%d %H:%M:%S')
         || ' | LSN: ' || CASE WHEN seq % 2 = 0 THEN printf('%08X', seq) ELSE '?' END || ' | ' AS head
  FROM wire)
SELECT "offset", CASE
  WHEN is_tombstone THEN '[events] Tombstone message (null value) — used for log compaction'
  WHEN op IN ('c', 'r') THEN head || 'NEW: {{"value":' || CAST(after_value AS VARCHAR) || '}}'
  WHEN op = 'd' THEN head || 'DELETED: ' || CASE WHEN before_value IS NULL THEN '{{}}' ELSE
       '{{"value":' || CAST(before_value AS VARCHAR) || '}}' END
  WHEN before_value IS DISTINCT FROM after_value THEN head || 'CHANGED: {{"value":"' || {_DIFF_SQL} || '"}}'
  ELSE head || 'AFTER: {{"value":' || CAST(after_value AS VARCHAR) || '}} (no visible changes in display fields)'
  END AS summary FROM shown""")
def render_summary(spark, sf):
    from ..schema import TableSpec

    change = D.decode_json(wire_log(spark, sf), ROW)
    specs = {"events": TableSpec("events", ("id",), ("value",))}
    return D.render_summary(change, "events", specs).select("offset", "summary")


@query(f"""WITH {IMAGES_SQL}
SELECT seq, CASE WHEN op = 'd' THEN before_value ELSE after_value END AS value,
       CASE WHEN op = 'd' THEN 'true' ELSE 'false' END AS __deleted FROM images""")
def unwrap(spark, sf):
    return D.unwrap(with_images(change_log(spark, sf)), keep=["seq"])


@query(f"""WITH {IMAGES_SQL} SELECT seq, after_value AS value FROM images WHERE op <> 'd'""")
def unwrap_drop_deletes(spark, sf):
    return D.unwrap(with_images(change_log(spark, sf)), deletes="drop", keep=["seq"])


@query("""SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type AS name, NULL::VARCHAR AS email,
  event_type AS action, strftime(ts, '%Y-%m-%d') AS "timestamp" FROM events""")
def flatten_user_event(spark, sf):
    log = table(spark, sf, "events").select(
        "event_id",
        F.to_json(
            F.struct(
                F.col("user_id").cast("string").alias("user_id"),
                F.col("event_type").alias("name"),
                F.col("event_type").alias("action"),
                F.date_format("ts", "yyyy-MM-dd").alias("timestamp"),
            )
        ).alias("value"),
    )
    return D.flatten_user_event(log, keep=["event_id"])


def _hex_bytes(column):
    """Two's complement bytes of a LONG, eight of them."""
    return F.unhex(F.lpad(F.hex(column), 16, "0"))


@query("""SELECT o_orderkey, CAST(CAST(round(o_totalprice * 100) AS BIGINT)
    * CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END / 10000.0 AS DECIMAL(38,4))::DOUBLE AS from_bytes,
  CAST(CAST(round(o_totalprice * 100) AS BIGINT) / 10000.0 AS DECIMAL(38,4))::VARCHAR AS from_text,
  o_orderpriority AS not_base64 FROM orders""")
def decode_decimal(spark, sf):
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    signed = cents * F.when(F.col("o_orderstatus") == "F", -1).otherwise(1)
    wire = table(spark, sf, "orders").select(
        "o_orderkey",
        _hex_bytes(signed).alias("raw"),
        F.base64(_hex_bytes(cents)).alias("text"),
        F.col("o_orderpriority").alias("plain"),
    )
    return wire.select(
        "o_orderkey",
        fn.decode_decimal(F.col("raw"), T.BinaryType()).cast("double").alias("from_bytes"),
        fn.decode_decimal(F.col("text"), T.StringType()).alias("from_text"),
        fn.decode_decimal(F.col("plain"), T.StringType()).alias("not_base64"),
    )


@query("""SELECT p_partkey, p_partkey AS "ProductID", p_name AS "Name", p_brand AS "Color",
  CAST(CAST(round(p_retailprice * 100) AS BIGINT) / 10000.0 AS DECIMAL(38,4))::DOUBLE AS "ListPrice" FROM part""")
def key_fields(spark, sf):
    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    change = table(spark, sf, "part").select(
        "p_partkey",
        F.struct(
            F.col("p_partkey").alias("ProductID"),
            F.col("p_name").alias("Name"),
            F.col("p_brand").alias("Color"),
            F.col("p_size").alias("Size"),
            _hex_bytes(cents).alias("ListPrice"),
        ).alias("after"),
    )
    shown = D.key_fields(change, "Product").select("p_partkey", "after_shown.*")
    return shown.withColumn("ListPrice", F.col("ListPrice").cast("double"))


@query("""SELECT event_id, CASE event_type WHEN 'view' THEN 'SNAPSHOT' WHEN 'signup' THEN 'INSERT'
  WHEN 'error' THEN 'DELETE' WHEN 'click' THEN 'UNKNOWN(x)' ELSE 'UNKNOWN(?)' END AS op_name,
  CASE WHEN user_id % 2 = 0 THEN 'events' ELSE 'aw.public.events' END AS short_name,
  CASE WHEN user_id % 2 = 0 THEN 'shop' END AS db, 'public' AS "schema"
FROM events""")
def names(spark, sf):
    op = (
        F.when(F.col("event_type") == "view", "r")
        .when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "error", "d")
        .when(F.col("event_type") == "click", "x")
    )
    topic = F.when(F.col("user_id") % 2 == 0, "aw.shop.public.events").otherwise("aw.public.events")
    parts = fn.topic_parts(topic)
    return table(spark, sf, "events").select(
        "event_id",
        fn.op_name(op).alias("op_name"),
        fn.table_short_name(topic).alias("short_name"),
        parts.getField("db").alias("db"),
        parts.getField("schema").alias("schema"),
    )


@query(f"""WITH {CHANGE_SQL} SELECT pk, seq, op FROM change WHERE op IN ('c', 'd')""")
def filter_ops(spark, sf):
    return X.filter_ops(change_log(spark, sf), ["c", "d"]).select("pk", "seq", "op")


@query("""SELECT event_id, event_type AS "table" FROM events WHERE event_type IN ('view', 'purchase')""")
def filter_tables(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.col("event_type").alias("table"))
    return X.filter_tables(events, ["view", "purchase"])


@query(f"""SELECT 'interval' AS variant, o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '{AS_OF}' - INTERVAL 1 YEAR
UNION ALL SELECT 'days_365', o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY
UNION ALL SELECT 'calendar_year', o_orderkey FROM orders WHERE year(o_orderdate) = year(TIMESTAMP '{AS_OF}') - 1""")
def recent_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    found = None
    for variant in ("interval", "days_365", "calendar_year"):
        part = X.recent_rows(orders, "o_orderdate", AS_OF, variant=variant).select(
            F.lit(variant).alias("variant"), "o_orderkey"
        )
        found = part if found is None else found.unionByName(part)
    return found


@query("""SELECT o_orderkey, o_orderstatus FROM orders
WHERE o_orderkey >= 0 AND o_totalprice > 100000 AND o_orderstatus = 'F'""")
def with_condition(spark, sf):
    orders = table(spark, sf, "orders")
    return X.with_condition(
        orders, "o_totalprice > 100000 AND o_orderstatus = 'F'", "o_orderkey", 0
    ).select("o_orderkey", "o_orderstatus")


@query("""SELECT event_id, epoch_ms(ts) + CAST(floor(value) AS BIGINT) - 20 - epoch_ms(ts) AS latency_ms FROM events
WHERE epoch_ms(ts) > 0 AND CAST(floor(value) AS BIGINT) - 20 >= 0""")
def valid_latency(spark, sf):
    sent = F.unix_millis(F.col("ts").cast("timestamp"))
    log = table(spark, sf, "events").select(
        "event_id",
        sent.alias("ts_ms"),
        (sent + F.floor("value") - 20).alias("arrival_ms"),
    )
    return X.valid_latency(log, "arrival_ms", "ts_ms").select("event_id", "latency_ms")


@query("""SELECT event_id, CAST(floor(value) AS BIGINT) - 10 AS lag FROM events
WHERE CAST(floor(value) AS BIGINT) - 10 >= 0""")
def valid_lag(spark, sf):
    samples = table(spark, sf, "events").select(
        "event_id", (F.floor("value") - 10).cast("long").alias("lag")
    )
    return X.valid_lag(samples)


@query("""SELECT event_id, event_type AS topic FROM events WHERE event_type IN ('view', 'error')""")
def select_topics(spark, sf):
    log = table(spark, sf, "events").select("event_id", F.col("event_type").alias("topic"))
    return L.select_topics(log, ["V", "E"], {"V": "view", "E": "error", "C": "click"})


@query("""SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset" FROM events
WHERE (event_type = 'view' AND user_id % 4 = 0 AND event_id >= 500)
   OR (event_type = 'view' AND user_id % 4 = 1 AND event_id >= 0)
   OR (event_type = 'error' AND user_id % 4 = 2 AND event_id >= 250)""")
def from_position(spark, sf):
    log = table(spark, sf, "events").select(
        F.col("event_type").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    return L.from_position(log, {"view": {0: 500, 1: 0}, "error": {2: 250}}, rest="drop")


@query("""SELECT event_id AS "offset", props AS value FROM events WHERE event_type <> 'error'
ORDER BY ts, event_id LIMIT 100""")
def take_messages(spark, sf):
    log = table(spark, sf, "events").select(
        F.col("ts").alias("timestamp"),
        F.lit("shop.events").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.when(F.col("event_type") != "error", F.col("props")).alias("value"),
    )
    return L.take_messages(log, 100).select("offset", "value")

"""Audits over the change logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import audit as U
from ..operators import state as S
from ..operators.blocks import hot_block, long_block
from .registry import CHANGE_SQL, change_log, op_of, query, rounded, table


def _framed(spark, sf):
    """Messages as bytes: framed with a schema id unless the event is a view."""
    header = F.concat(
        F.lit(bytearray([0])),
        F.unhex(F.lpad(F.hex(F.length("event_type") + F.lit(40)), 8, "0")),
    )
    body = F.col("props").cast("binary")
    return table(spark, sf, "events").select(
        F.concat(F.lit("shop."), F.pmod("user_id", F.lit(3)).cast("string")).alias("topic"),
        F.when(F.col("event_type") == "view", body).otherwise(F.concat(header, body)).alias("value"),
    )


@query("""SELECT 'shop.' || CAST(user_id % 3 AS VARCHAR) AS topic, event_type <> 'view' AS magic_ok,
  CASE WHEN event_type <> 'view' THEN length(event_type) + 40 END AS schema_id, count(*) AS messages
FROM events GROUP BY 1, 2, 3""")
def wire_format_audit(spark, sf):
    return U.wire_format_audit(_framed(spark, sf))


_COUNTS_SQL = f"""WITH {CHANGE_SQL}, src AS (
  SELECT op, pk FROM change QUALIFY row_number() OVER (PARTITION BY pk ORDER BY seq DESC) = 1),
sides AS (
  SELECT CAST(pk % 7 AS VARCHAR) AS "table", 1 AS s, 0 AS l, 0 AS t FROM src
  UNION ALL SELECT CAST(pk % 7 AS VARCHAR), 0, 1, 0 FROM change
  UNION ALL SELECT CAST(pk % 7 AS VARCHAR), 0, 0, 1 FROM src WHERE op <> 'd'),
counts AS (
  SELECT "table", CAST(sum(s) AS BIGINT) AS source_rows, CAST(sum(l) AS BIGINT) AS log_messages,
         CAST(sum(t) AS BIGINT) AS target_rows FROM sides GROUP BY 1)"""


def _counts(spark, sf):
    change = change_log(spark, sf).select(
        "pk", "seq", "op", F.pmod("pk", F.lit(7)).cast("string").alias("table")
    )
    latest = S.latest_per_key(change, ["pk"], ["seq"])
    return U.reconcile_counts(latest, change, latest.where(F.col("op") != "d"))


@query(f"""{_COUNTS_SQL}
SELECT *, log_messages - source_rows AS log_delta, target_rows - source_rows AS target_delta,
       target_rows = source_rows AS matches FROM counts""")
def reconcile_counts(spark, sf):
    return _counts(spark, sf)


@query(f"""{_COUNTS_SQL}
SELECT "table", source_rows, log_messages,
       round(log_messages / source_rows::DOUBLE, 6) AS inflation FROM counts""")
def log_inflation(spark, sf):
    return U.log_inflation(_counts(spark, sf)).select(
        "table", "source_rows", "log_messages", *rounded("inflation")
    )


@query(f"""WITH {CHANGE_SQL}, seen AS (
  SELECT topic, partition, seq, lag(seq) OVER (PARTITION BY topic, partition ORDER BY seq) AS prior
  FROM change WHERE op <> 'd')
SELECT topic, partition, prior + 1 AS gap_from, seq - 1 AS gap_to, seq - prior - 1 AS missing
FROM seen WHERE seq > prior + 1""")
def offset_gaps(spark, sf):
    log = change_log(spark, sf).where(F.col("op") != "d")
    return U.offset_gaps(log.withColumn("offset", F.col("seq"))).select(
        "topic", "partition", "gap_from", "gap_to", "missing"
    )


@query("""WITH seen AS (
  SELECT user_id AS pk, CAST(round(value * 100) AS BIGINT) AS lsn,
         CAST(CASE WHEN value > 60 THEN 1 ELSE 0 END AS INTEGER) AS partition,
         lag(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY event_id) AS prior
  FROM events),
found AS (
  SELECT pk, count(*) FILTER (lsn < prior) AS steps_back, min(partition) <> max(partition) AS moved_partition
  FROM seen GROUP BY pk)
SELECT pk, steps_back, moved_partition FROM found WHERE steps_back > 0 OR moved_partition""")
def order_audit(spark, sf):
    change = table(spark, sf, "events").select(
        F.col("user_id").alias("pk"),
        F.col("event_id").alias("arrived"),
        F.round(F.col("value") * 100).cast("long").alias("lsn"),
        F.when(F.col("value") > 60, 1).otherwise(0).cast("int").alias("partition"),
    )
    block = hot_block(change, ["pk"], long_block("arrived"))
    return U.order_audit(change, ["pk"], ["arrived"], [block])


@query("""SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    return A.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""WITH l AS (SELECT c_custkey, c_name, c_nationkey FROM customer),
r AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN upper(c_name) || '!' ELSE c_name END AS c_name, c_nationkey
      FROM customer WHERE c_nationkey <> 3)
SELECT c_custkey, c_name, c_nationkey, CAST(sum(side) AS BIGINT) AS surplus FROM (
  SELECT *, 1 AS side FROM l UNION ALL SELECT *, -1 FROM r)
GROUP BY 1, 2, 3 HAVING sum(side) <> 0""")
def row_difference(spark, sf):
    left = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    changed = F.when(F.col("c_acctbal") < 0, F.concat(F.upper("c_name"), F.lit("!"))).otherwise(
        F.col("c_name")
    )
    right = left.where(F.col("c_nationkey") != 3).withColumn("c_name", changed)
    return U.row_difference(left.drop("c_acctbal"), right.drop("c_acctbal"))


@query("""WITH r AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 997 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
  FROM orders WHERE o_orderkey % 1009 <> 7),
l AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders)
SELECT o_orderkey, o_custkey, o_totalprice, CAST(sum(side) AS BIGINT) AS surplus FROM (
  SELECT *, 1 AS side FROM l UNION ALL SELECT *, -1 FROM r) GROUP BY 1, 2, 3 HAVING sum(side) <> 0""")
def digest_difference(spark, sf):
    """Orders against a copy in which some prices are changed and some rows are missing."""
    left = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    price = F.when(F.pmod("o_orderkey", F.lit(997)) == 5, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    right = left.where(F.pmod("o_orderkey", F.lit(1009)) != 7).withColumn("o_totalprice", price)
    return U.digest_difference(left, right, ["o_orderkey"])


def _versioned(spark, sf):
    """Events as JSON documents whose shape depends on the schema version."""
    old = F.struct("event_id", "user_id", F.col("value").alias("amount"), "props")
    new = F.struct(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.col("value").alias("amount"),
        "event_type",
        F.when(F.col("event_type") == "error", F.col("props")).alias("note"),
    )
    is_new = F.col("ts") >= F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    return table(spark, sf, "events").select(
        F.concat(F.lit("shop."), F.pmod("user_id", F.lit(3)).cast("string")).alias("topic"),
        F.when(is_new, 2).otherwise(1).alias("version"),
        F.when(is_new, F.to_json(new)).otherwise(F.to_json(old)).alias("value"),
    )


@query("""WITH docs AS (
  SELECT CASE WHEN ts >= TIMESTAMP '2024-01-15 00:00:00' THEN 2 ELSE 1 END AS version, event_type,
    'shop.' || CAST(user_id % 3 AS VARCHAR) AS topic FROM events),
fields AS (
  SELECT 1 AS version, unnest(['event_id', 'user_id', 'amount', 'props']) AS field,
         unnest(['BIGINT', 'BIGINT', 'DECIMAL', 'STRING']) AS type
  UNION ALL
  SELECT 2, unnest(['event_id', 'user_id', 'amount', 'event_type', 'note']),
         unnest(['BIGINT', 'STRING', 'DECIMAL', 'STRING', 'STRING']))
SELECT d.topic, f.version, f.field, f.type, count(*) AS messages
FROM docs d JOIN fields f ON f.version = d.version AND (f.field <> 'note' OR d.event_type = 'error')
GROUP BY 1, 2, 3, 4""")
def schema_fields(spark, sf):
    fields = U.schema_fields(_versioned(spark, sf), "version")
    # A number such as 12.0 is read as a decimal without digits after the point.
    return fields.select("topic", "version", "field", "type", "messages")


@query("""SELECT DISTINCT 'shop.' || CAST(user_id % 3 AS VARCHAR) AS topic, field, change, old_type, new_type, breaks_backward FROM (
  SELECT unnest(['user_id', 'props', 'event_type', 'note']) AS field,
         unnest(['type_changed', 'removed', 'added', 'added']) AS change,
         unnest(['BIGINT', 'STRING', '', '']) AS old_type,
         unnest(['STRING', '', 'STRING', 'STRING']) AS new_type,
         unnest([TRUE, FALSE, TRUE, FALSE]) AS breaks_backward, user_id
  FROM events)""")
def schema_drift(spark, sf):
    return U.schema_drift(_versioned(spark, sf), "version", 1, 2)


@query("""SELECT coalesce(event_type, 'TOTAL') AS label,
  CASE WHEN count(*) FILTER (NOT value < 100) = 0 THEN 'PASS' ELSE 'FAIL' END AS result,
  count(*) FILTER (value < 100) AS passed, count(*) FILTER (NOT value < 100) AS failed
FROM events GROUP BY ROLLUP (event_type)""")
def health_rollup(spark, sf):
    checks = table(spark, sf, "events").select(
        F.col("event_type").alias("label"), (F.col("value") < 100).alias("ok")
    )
    return A.health_rollup(checks)


@query("""SELECT count(*) AS total_rows, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key FROM orders""")
def table_check(spark, sf):
    return A.table_check(table(spark, sf, "orders"), "o_orderkey")


@query(f"""WITH {CHANGE_SQL} SELECT topic AS "table", op, count(*) AS events FROM change GROUP BY 1, 2""")
def op_counts(spark, sf):
    return A.op_counts(change_log(spark, sf).withColumn("table", F.col("topic")))


@query("""SELECT CAST(user_id % 7 AS VARCHAR) AS "table",
  count(*) FILTER (event_type = 'view') AS r, count(*) FILTER (event_type = 'signup') AS c,
  count(*) FILTER (event_type NOT IN ('view', 'signup', 'error')) AS u,
  count(*) FILTER (event_type = 'error') AS d
FROM events GROUP BY 1""")
def op_counts_wide(spark, sf):
    change = table(spark, sf, "events").select(
        F.pmod("user_id", F.lit(7)).cast("string").alias("table"), op_of().alias("op")
    )
    return A.op_counts(change, wide=True)

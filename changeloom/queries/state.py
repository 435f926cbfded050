"""Table state and log maintenance over the change log of users."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import state as S
from ..operators.blocks import long_block
from ..sources.log import publish as publish_log
from .registry import CHANGE_SQL, IMAGES_SQL, PARTITIONS, change_log, query, table, with_images

LO, HI = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
BY_TIME = ["ts", "seq"]
COLUMNS = ["pk", "seq", "op", "value"]


def _at(text):
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


@query(f"""WITH {CHANGE_SQL}
SELECT pk, seq, op, value FROM change
QUALIFY row_number() OVER (PARTITION BY pk ORDER BY seq DESC) = 1""")
def latest_per_key(spark, sf):
    return S.latest_per_key(change_log(spark, sf).select(*COLUMNS), ["pk"], ["seq"])


@query(f"""WITH {CHANGE_SQL}, last AS (
SELECT pk, seq, op, value FROM change
QUALIFY row_number() OVER (PARTITION BY pk ORDER BY seq DESC) = 1)
SELECT * FROM last WHERE op <> 'd'""")
def materialize(spark, sf):
    return S.materialize(change_log(spark, sf).select(*COLUMNS), ["pk"], ["seq"])


@query(f"""WITH {CHANGE_SQL}, last AS (
SELECT pk, seq, op, value FROM change WHERE ts <= TIMESTAMP '{LO}'
QUALIFY row_number() OVER (PARTITION BY pk ORDER BY seq DESC) = 1)
SELECT * FROM last WHERE op <> 'd'""")
def state_as_of(spark, sf):
    change = change_log(spark, sf).select(*COLUMNS, "ts")
    return S.state_as_of(change, ["pk"], _at(LO), BY_TIME).select(*COLUMNS)


@query(f"""WITH {CHANGE_SQL}
SELECT pk, seq, op, value, ts FROM change
WHERE ts BETWEEN TIMESTAMP '{LO}' AND TIMESTAMP '{HI}' ORDER BY ts, seq""")
def all_changes(spark, sf):
    return S.all_changes(change_log(spark, sf).select(*COLUMNS, "ts"), _at(LO), _at(HI), BY_TIME)


@query(f"""WITH {IMAGES_SQL}, ranged AS (
  SELECT * FROM images WHERE ts BETWEEN TIMESTAMP '{LO}' AND TIMESTAMP '{HI}'),
ends AS (
  SELECT pk, arg_min(op, seq) AS first_op, arg_max(op, seq) AS last_op, max(seq) AS seq
  FROM ranged GROUP BY pk)
SELECT e.pk, e.seq,
       CASE WHEN first_op IN ('c', 'r') THEN 'c' WHEN last_op = 'd' THEN 'd' ELSE 'u' END AS op,
       CASE WHEN last_op = 'd' THEN r.before_value END AS before_value,
       CASE WHEN last_op <> 'd' THEN r.after_value END AS after_value
FROM ends e JOIN ranged r ON r.seq = e.seq
WHERE NOT (first_op IN ('c', 'r') AND last_op = 'd')""")
def net_changes(spark, sf):
    change = with_images(change_log(spark, sf))
    return S.net_changes(change, ["pk"], _at(LO), _at(HI), BY_TIME).select(
        "pk",
        "seq",
        "op",
        F.col("before.value").alias("before_value"),
        F.col("after.value").alias("after_value"),
    )


def _keyed(spark, sf):
    return change_log(spark, sf).select(
        "topic",
        "partition",
        F.col("seq").alias("offset"),
        "ts",
        F.col("pk").cast("string").alias("key"),
        F.when(F.col("op") != "d", F.col("props")).alias("value"),
    )


_KEYED_SQL = f"""{CHANGE_SQL}, keyed AS (
  SELECT topic, partition, seq AS "offset", ts, CAST(pk AS VARCHAR) AS key,
         CASE WHEN op <> 'd' THEN props END AS value FROM change)"""


@query(f"""WITH {_KEYED_SQL}
SELECT topic, partition, "offset", key, value FROM keyed
QUALIFY row_number() OVER (PARTITION BY topic, partition, key ORDER BY "offset" DESC) = 1""")
def compact_log(spark, sf):
    return S.compact_log(_keyed(spark, sf).drop("ts"))


@query(f"""WITH {_KEYED_SQL}, newest AS (
SELECT topic, partition, "offset", key, value FROM keyed
QUALIFY row_number() OVER (PARTITION BY topic, partition, key ORDER BY "offset" DESC) = 1)
SELECT * FROM newest WHERE value IS NOT NULL""")
def compact_log_drop_tombstones(spark, sf):
    return S.compact_log(_keyed(spark, sf).drop("ts"), drop_tombstoned=True)


@query(f"""WITH {_KEYED_SQL}, summed AS (
  SELECT *, sum(strlen(key) + coalesce(strlen(value), 0))
              OVER (PARTITION BY topic, partition ORDER BY "offset" DESC) AS total
  FROM keyed WHERE ts >= TIMESTAMP '{LO}')
SELECT topic, partition, "offset", key, value FROM summed WHERE total <= 10000""")
def retain(spark, sf):
    size = F.octet_length("key") + F.coalesce(F.octet_length("value"), F.lit(0))
    return S.retain(_keyed(spark, sf), _at(LO), 10_000, size, timestamp="ts").drop("ts")


@query(f"""WITH {CHANGE_SQL} SELECT topic, partition, seq, pk, op, value FROM change""")
def dedupe(spark, sf):
    change = change_log(spark, sf).select("topic", "partition", "seq", "pk", "op", "value")
    redelivered = change.unionByName(change.where(F.col("op") == "u"))
    return S.dedupe(redelivered, ["topic", "partition", "seq"])


@query(f"""WITH {IMAGES_SQL}, doubled AS (
  SELECT *, FALSE AS is_tombstone FROM images
  UNION ALL SELECT *, TRUE FROM images WHERE op = 'd')
SELECT pk, seq, CASE WHEN NOT is_tombstone THEN op END AS op,
       CASE WHEN NOT is_tombstone THEN before_value END AS before_value,
       CASE WHEN NOT is_tombstone THEN after_value END AS after_value, is_tombstone
FROM doubled""")
def with_tombstones(spark, sf):
    change = with_images(change_log(spark, sf))
    return S.with_tombstones(change, True, ["op", "before", "after"]).select(
        "pk",
        "seq",
        "op",
        F.col("before.value").alias("before_value"),
        F.col("after.value").alias("after_value"),
        "is_tombstone",
    )


@query(f"""WITH {CHANGE_SQL}, firsts AS (
  SELECT pk, op, seq FROM change QUALIFY row_number() OVER (PARTITION BY pk ORDER BY seq) = 1)
SELECT pk, seq FROM firsts WHERE op = 'u'""")
def missing_before(spark, sf):
    return S.missing_before(change_log(spark, sf), ["pk"], ["seq"])


@query(f"""WITH {CHANGE_SQL} SELECT pk, seq, partition FROM change""")
def assign_partition(spark, sf):
    change = change_log(spark, sf).select("pk", "seq")
    return S.assign_partition(change, ["pk"], PARTITIONS, by_value=True)


@query(f"""WITH {CHANGE_SQL}
SELECT topic, partition,
       row_number() OVER (PARTITION BY topic, partition ORDER BY seq) - 1 AS "offset",
       ts AS "timestamp", CAST(pk AS VARCHAR) AS key, props AS value FROM change""")
def publish(spark, sf):
    change = change_log(spark, sf).select(
        "topic", "ts", "pk", "seq", F.col("pk").cast("string").alias("key"), F.col("props").alias("value")
    )
    return publish_log(
        change, ["pk"], PARTITIONS, ["seq"], [long_block("seq")], timestamp="ts", by_value=True
    )


@query("""SELECT o_orderkey, o_orderdate,
  row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_key FROM orders""")
def surrogate_key(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return S.surrogate_key(
        orders, ["o_orderdate", "o_orderkey"], ["o_orderdate", long_block("o_orderkey")]
    )

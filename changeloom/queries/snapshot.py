"""Snapshots, chunks and signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters as X
from ..operators import joins as J
from ..operators import state as S
from ..plans import incremental as I
from ..plans import signals as G
from ..plans import snapshot as P
from .registry import (
    AS_OF,
    CHUNK,
    LIVE_SQL,
    WINDOW,
    live_changes,
    query,
    table,
)

RECENT_SQL = f"o_orderdate >= TIMESTAMP '{AS_OF}' - INTERVAL 1 YEAR"


def _recent():
    return X.is_recent("o_orderdate", AS_OF)


@query("""SELECT 'orders' AS "table", 'r' AS op, CAST(0 AS BIGINT) AS lsn, TRUE AS no_before,
  o_orderkey, o_totalprice FROM orders""")
def table_snapshot(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    snap = P.table_snapshot(orders, "orders", 0).withColumn("lsn", F.col("lsn").cast("long"))
    return snap.select("table", "op", "lsn", F.col("before").isNull().alias("no_before"), "after.*")


@query("""SELECT CASE WHEN c_nationkey >= 15 THEN 2 WHEN c_nationkey >= 5 THEN 1 ELSE 0 END AS part,
  c_custkey, c_nationkey FROM customer""")
def partitioned_snapshot(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    bounds = [(None, 5), (5, 15), (15, None)]
    return P.partitioned_snapshot(customers, "c_nationkey", bounds, "customer", 0).select(
        "part", "after.*"
    )


@query(f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE {RECENT_SQL})""")
def detail_for_recent_headers(spark, sf):
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )
    return J.detail_for_recent_headers(
        items, table(spark, sf, "orders"), "l_orderkey", "o_orderkey", _recent()
    )


@query(f"""SELECT DISTINCT c.c_custkey, c.c_name, c.c_nationkey FROM customer c
JOIN orders o ON c.c_custkey = o.o_custkey WHERE {RECENT_SQL}""")
def parents_with_recent_children(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return J.parents_with_recent_children(
        customers, table(spark, sf, "orders"), "c_custkey", "o_custkey", _recent()
    )


@query("""SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def rows_in_subquery(spark, sf):
    keys = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return J.rows_in_subquery(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", keys
    )


@query(f"""SELECT c_custkey, c_name FROM customer c WHERE c_custkey > 20
AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND {RECENT_SQL})
ORDER BY c_custkey DESC""")
def deletable_keys(spark, sf):
    recent = table(spark, sf, "orders").where(_recent())
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return J.deletable_keys(customers, recent, "c_custkey", "o_custkey", 20)


@query(f"""WITH kept AS (
  SELECT 'orders' AS "table", o_orderkey AS id FROM orders WHERE {RECENT_SQL}
  UNION ALL SELECT 'lineitem', l_orderkey FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE {RECENT_SQL})
  UNION ALL SELECT 'customer', c_custkey FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE {RECENT_SQL})
  UNION ALL SELECT 'part', p_partkey FROM part)
SELECT "table", 'r' AS op, id FROM kept""")
def filtered_snapshot(spark, sf):
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey", "customer": "c_custkey", "part": "p_partkey"}
    tables = {name: table(spark, sf, name) for name in keys}
    overrides = {
        "orders": lambda df: df.where(_recent()),
        "lineitem": lambda df: J.detail_for_recent_headers(
            df, tables["orders"], "l_orderkey", "o_orderkey", _recent()
        ),
        "customer": lambda df: J.parents_with_recent_children(
            df, tables["orders"], "c_custkey", "o_custkey", _recent()
        ),
    }
    found = None
    for name, snap in P.filtered_snapshot(tables, overrides, 0).items():
        part = snap.select("table", "op", F.col(f"after.{keys[name]}").alias("id"))
        found = part if found is None else found.unionByName(part)
    return found


def _order_events(spark, sf):
    """Orders as changes in date order, the whole table as the snapshot source."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    snap = orders.select("o_orderkey", F.lit(0).cast("long").alias("lsn"), F.lit("r").alias("op"), "o_totalprice")
    return snap, live_changes(spark, sf)


@query(f"""WITH {LIVE_SQL}, snap AS (
  SELECT o_orderkey, CAST(0 AS BIGINT) AS lsn, 'r' AS op, o_totalprice FROM orders)
SELECT 'initial' AS mode, op, count(*) AS events, CAST(sum(o_orderkey) AS BIGINT) AS keys, max(lsn) AS last
FROM (SELECT * FROM snap UNION ALL SELECT * FROM live WHERE lsn > 1000) GROUP BY op
UNION ALL SELECT 'initial_only', op, count(*), CAST(sum(o_orderkey) AS BIGINT), max(lsn) FROM snap GROUP BY op
UNION ALL SELECT m.mode, op, count(*), CAST(sum(o_orderkey) AS BIGINT), max(lsn)
  FROM live, (SELECT unnest(['schema_only', 'no_data']) AS mode) m WHERE lsn > 1000 GROUP BY 1, 2
UNION ALL SELECT 'never', op, count(*), CAST(sum(o_orderkey) AS BIGINT), max(lsn) FROM live WHERE lsn > 2000 GROUP BY op""")
def snapshot_modes(spark, sf):
    snap, live = _order_events(spark, sf)
    found = None
    for mode in P.MODES:
        log = P.snapshot_then_stream(snap, live, mode, 1_000, current=2_000)
        part = log.groupBy("op").agg(
            F.count(F.lit(1)).alias("events"),
            F.sum("o_orderkey").alias("keys"),
            F.max("lsn").alias("last"),
        ).select(F.lit(mode).alias("mode"), "*")
        found = part if found is None else found.unionByName(part)
    return found


@query(f"""SELECT k // {CHUNK} AS chunk_id, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,
  count(*) AS rows, (SELECT max(o_orderkey) FROM orders) AS end_key
FROM (SELECT o_orderkey - (SELECT min(o_orderkey) FROM orders) AS k, o_orderkey FROM orders) GROUP BY 1""")
def plan_chunks(spark, sf):
    return I.plan_chunks(table(spark, sf, "orders"), "o_orderkey", CHUNK)


@query("""WITH ranked AS (
  SELECT l_orderkey, (row_number() OVER (ORDER BY l_orderkey) - 1) // 1000 AS chunk_id
  FROM (SELECT DISTINCT l_orderkey FROM lineitem))
SELECT chunk_id, min(l_orderkey) AS first_key, max(l_orderkey) AS last_key, count(*) AS rows,
  (SELECT max(l_orderkey) FROM lineitem) AS end_key
FROM ranked GROUP BY 1""")
def plan_chunks_by_rows(spark, sf):
    keys = table(spark, sf, "lineitem").select("l_orderkey").distinct()
    return I.plan_chunks(keys, "l_orderkey", 1_000, "rows")


@query("""SELECT o_orderkey, o_totalprice, 'r' AS op FROM orders
WHERE o_orderkey BETWEEN 0 AND (SELECT max(o_orderkey) // 2 FROM orders) AND o_totalprice > 100000 ORDER BY o_orderkey""")
def read_chunk(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    middle = orders.select(F.call_function("div", F.max("o_orderkey"), F.lit(2))).scalar()
    return I.read_chunk(orders, "o_orderkey", 0, middle, "o_totalprice > 100000")


_WINDOWS_SQL = f"""{LIVE_SQL},
base AS (SELECT o_orderkey, o_totalprice,
    (o_orderkey - (SELECT min(o_orderkey) FROM orders)) // {CHUNK} AS chunk_id FROM orders),
kept AS (
  SELECT o_orderkey, o_totalprice, chunk_id, 'r' AS op, chunk_id * {WINDOW} + {WINDOW - 1} AS lsn
  FROM base b WHERE NOT EXISTS (
    SELECT 1 FROM live l WHERE l.o_orderkey = b.o_orderkey
      AND l.lsn BETWEEN b.chunk_id * {WINDOW} AND b.chunk_id * {WINDOW} + {WINDOW - 1}))"""


def _backfill(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    live = live_changes(spark, sf)
    windows = I.sequential_windows(I.plan_chunks(orders, "o_orderkey", CHUNK), WINDOW)
    return I.incremental_snapshot(orders, live, "o_orderkey", CHUNK, windows), live


@query(f"""WITH {_WINDOWS_SQL} SELECT * FROM kept""")
def incremental_snapshot(spark, sf):
    return _backfill(spark, sf)[0]


@query(f"""WITH {_WINDOWS_SQL}, merged AS (
  SELECT o_orderkey, lsn, op, o_totalprice, 0 AS side FROM kept
  UNION ALL SELECT o_orderkey, lsn, op, o_totalprice, 1 FROM live),
last AS (SELECT * FROM merged QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY lsn DESC, side DESC) = 1)
SELECT o_orderkey, lsn, op, o_totalprice FROM last WHERE op <> 'd'""")
def incremental_state(spark, sf):
    reads, live = _backfill(spark, sf)
    log = I.interleave(
        reads.drop("chunk_id").withColumn("side", F.lit(0)), live.withColumn("side", F.lit(1))
    )
    return S.materialize(log, ["o_orderkey"], ["lsn", "side"]).drop("side")


_ITEM_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(f"""WITH items AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(count(*) AS BIGINT) AS copies FROM lineitem GROUP BY ALL),
base AS (
  SELECT *, (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) // {CHUNK} AS chunk_id FROM items),
live AS (
  SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) * 1000 + l_orderkey % 997 AS lsn FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, copies, chunk_id, 'r' AS op, chunk_id * 200 + 199 AS lsn FROM base b
WHERE NOT EXISTS (SELECT 1 FROM live l WHERE l.l_orderkey = b.l_orderkey AND l.l_linenumber = b.l_linenumber
  AND l.l_partkey = b.l_partkey AND l.l_suppkey = b.l_suppkey AND l.lsn BETWEEN b.chunk_id * 200 AND b.chunk_id * 200 + 199)""")
def incremental_snapshot_composite(spark, sf):
    """Line items backfilled by their four-column key while their quantities change."""
    lines = table(spark, sf, "lineitem")
    items = lines.groupBy(*_ITEM_KEYS).agg(F.count(F.lit(1)).alias("copies"))
    position = F.col("l_quantity").cast("long") * 1000 + F.col("l_orderkey") % 997
    live = lines.select(*_ITEM_KEYS, position.alias("lsn")).distinct()
    numbered = I.with_chunks(items, _ITEM_KEYS, CHUNK, "rows")
    windows = I.sequential_windows(I.plan_chunks(numbered, _ITEM_KEYS, CHUNK, "numbered"), 200)
    return I.incremental_snapshot(numbered, live, _ITEM_KEYS, CHUNK, windows, mode="numbered")


@query(f"""WITH {LIVE_SQL},
base AS (SELECT o_orderkey, o_totalprice, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS chunk_id FROM orders)
SELECT o_orderkey, o_totalprice, chunk_id FROM base b WHERE NOT EXISTS (
  SELECT 1 FROM live l WHERE l.o_orderkey = b.o_orderkey
    AND l.lsn BETWEEN b.chunk_id * {WINDOW} AND b.chunk_id * {WINDOW} + {WINDOW - 1})""")
def discard_stale_reads(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    reads = I.with_chunks(orders, "o_orderkey", 1_000, "rows")
    chunks = I.plan_chunks(reads, "o_orderkey", 1_000, "numbered")
    windows = I.sequential_windows(chunks, WINDOW)
    return I.discard_stale_reads(reads, live_changes(spark, sf), windows, ["o_orderkey"])


_CHUNKS_SQL = f"""chunks AS (
  SELECT k // {CHUNK} AS chunk_id, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
  FROM (SELECT o_orderkey - (SELECT min(o_orderkey) FROM orders) AS k, o_orderkey FROM orders) GROUP BY 1)"""


@query(f"""WITH {_CHUNKS_SQL}
SELECT chunk_id, first_key, last_key FROM chunks
WHERE NOT (last_key * 2 <= (SELECT max(o_orderkey) FROM orders))""")
def resume_chunks(spark, sf):
    chunks = I.plan_chunks(table(spark, sf, "orders"), "o_orderkey", CHUNK)
    done = chunks.where(F.col("last_key") * 2 <= F.col("end_key"))
    return I.resume_chunks(chunks.select("chunk_id", "first_key", "last_key"), done)


@query(f"""WITH chunks AS (
  SELECT o_orderpriority AS "table", o_orderkey // {CHUNK} AS chunk_id, count(*) AS rows FROM orders GROUP BY 1, 2),
opened AS (SELECT *, chunk_id * {WINDOW} AS open_pos, CAST(0 AS BIGINT) AS snapshot_pos FROM chunks),
stops AS (SELECT o_orderpriority AS "table", min(o_orderkey) * 100 + count(*) AS stop_pos
          FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1)
SELECT o."table", o.chunk_id, o.rows FROM opened o LEFT JOIN stops s ON s."table" = o."table"
WHERE s.stop_pos IS NULL OR o.open_pos <= s.stop_pos""")
def apply_stop(spark, sf):
    orders = table(spark, sf, "orders")
    chunks = (
        orders.groupBy(
            F.col("o_orderpriority").alias("table"),
            F.floor(F.col("o_orderkey") / CHUNK).alias("chunk_id"),
        )
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            "*",
            (F.col("chunk_id") * WINDOW).alias("open_pos"),
            F.lit(0).cast("long").alias("snapshot_pos"),
        )
    )
    stops = (
        orders.where("o_orderpriority <> '5-LOW'")
        .groupBy(F.col("o_orderpriority").alias("table"))
        .agg((F.min("o_orderkey") * 100 + F.count(F.lit(1))).alias("stop_pos"))
    )
    return I.apply_stop(chunks, stops).select("table", "chunk_id", "rows")


def _signal_log(spark, sf):
    kind = (
        F.when(F.col("event_type") == "error", "resume")
        .when(F.col("event_type") == "signup", "stop-snapshot")
        .otherwise("execute-snapshot")
    )
    data = F.struct(
        F.array(F.concat(F.lit(" shop."), F.col("event_type")), F.lit("shop.all ")).alias("data-collections"),
        F.lit("incremental").alias("type"),
        F.when(F.col("value") > 50, F.lit("id > 500")).alias("additional-condition"),
    )
    return table(spark, sf, "events").select(
        F.col("event_id").alias("offset"),
        F.when(F.col("event_type") == "view", "other").otherwise("aw").alias("key"),
        F.to_json(
            F.struct(F.col("event_id").cast("string").alias("id"), kind.alias("type"), data.alias("data"))
        ).alias("value"),
    )


_SIGNALS_SQL = """signals AS (
  SELECT event_id AS "offset", CASE WHEN event_type = 'view' THEN 'other' ELSE 'aw' END AS key,
         CAST(event_id AS VARCHAR) AS id,
         CASE event_type WHEN 'error' THEN 'resume' WHEN 'signup' THEN 'stop-snapshot' ELSE 'execute-snapshot' END AS type,
         CASE WHEN value > 50 THEN 'id > 500' END AS condition,
         p.pos, CASE p.pos WHEN 0 THEN 'shop.' || event_type ELSE 'shop.all' END AS collection,
         CASE WHEN event_type = 'view' THEN 'key does not match the prefix'
              WHEN event_type = 'error' THEN 'unknown type' END AS reason
  FROM events, (SELECT CAST(unnest([0, 1]) AS INTEGER) AS pos) p)"""


@query(f"""WITH {_SIGNALS_SQL}
SELECT "offset", key, id, type, condition, pos, collection, reason IS NULL AS accepted, reason FROM signals""")
def parse_signals(spark, sf):
    return I.parse_signals(_signal_log(spark, sf), "aw")


@query(f"""WITH {_SIGNALS_SQL}
SELECT "offset", pos, collection, condition, row_number() OVER (ORDER BY "offset", pos) AS run_no FROM signals
WHERE reason IS NULL AND type = 'execute-snapshot'""")
def snapshot_schedule(spark, sf):
    signals = I.parse_signals(_signal_log(spark, sf), "aw")
    return I.snapshot_schedule(signals).select("offset", "pos", "collection", "condition", "run_no")


_SIGNAL_GAP, _SIGNAL_LENGTH = 3_000, 200


def _nation_signals(spark, sf):
    """Nations read as signals for two tables: most start a snapshot, every fifth stops one, some have another key."""
    number = F.col("n_nationkey") % 3
    collections = F.when(number == 0, F.array(F.lit("shop.orders"))).when(number == 1, F.array(F.lit("shop.customer "))).otherwise(
        F.array(F.lit("shop.orders"), F.lit(" shop.customer"), F.lit("shop.other"))
    )
    data = F.struct(
        collections.alias("data-collections"), F.lit("incremental").alias("type"),
        F.when(number == 0, "o_totalprice > 100000").when(number == 1, "c_acctbal > 0").alias("additional-condition"),
    )
    kind = F.when(F.col("n_nationkey") % 5 == 4, "stop-snapshot").otherwise("execute-snapshot")
    return table(spark, sf, "nation").select(
        (F.col("n_nationkey") * _SIGNAL_GAP).cast("long").alias("offset"),
        F.when(F.col("n_nationkey") % 7 == 6, "other").otherwise("shop").alias("key"),
        F.to_json(F.struct(F.col("n_name").alias("id"), kind.alias("type"), data.alias("data"))).alias("value"),
    )


@query(f"""WITH RECURSIVE {LIVE_SQL},
named AS (SELECT * FROM (VALUES (0, 'shop.orders', 0), (1, 'shop.customer', 0), (2, 'shop.orders', 0), (2, 'shop.customer', 1)) t(part, tab, place)),
sig AS (
  SELECT n_nationkey * {_SIGNAL_GAP} AS pos, n_nationkey % 5 = 4 AS stops, tab, place, n_nationkey % 3 AS part
  FROM nation JOIN named ON part = n_nationkey % 3 WHERE n_nationkey % 7 <> 6),
planned AS (
  SELECT 'shop.orders' AS tab, (max(o_orderkey) - min(o_orderkey)) // {CHUNK} + 1 AS n FROM orders
  UNION ALL SELECT 'shop.customer', (max(c_custkey) - min(c_custkey)) // {CHUNK} + 1 FROM customer),
asked AS (
  SELECT row_number() OVER (ORDER BY s.pos, place) AS run_no, s.pos, s.tab, part, n,
    (SELECT min(x.pos) FROM sig x WHERE x.stops AND x.tab = s.tab AND x.pos > s.pos) AS stop
  FROM sig s JOIN planned p ON p.tab = s.tab WHERE NOT s.stops),
runs AS (
  SELECT CAST(0 AS BIGINT) AS run_no, CAST('' AS VARCHAR) AS tab, CAST(0 AS BIGINT) AS part, CAST(0 AS BIGINT) AS start, CAST(0 AS BIGINT) AS k
  UNION ALL
  SELECT a.run_no, a.tab, CAST(a.part AS BIGINT), CAST(greatest(r.start + r.k * {_SIGNAL_LENGTH}, a.pos) AS BIGINT),
    CAST(CASE WHEN a.stop IS NULL THEN a.n WHEN a.stop < greatest(r.start + r.k * {_SIGNAL_LENGTH}, a.pos) THEN 0
      ELSE least(a.n, (a.stop - greatest(r.start + r.k * {_SIGNAL_LENGTH}, a.pos)) // {_SIGNAL_LENGTH} + 1) END AS BIGINT)
  FROM runs r JOIN asked a ON a.run_no = r.run_no + 1),
source AS (
  SELECT 'shop.orders' AS tab, o_orderkey AS k, (o_orderkey - (SELECT min(o_orderkey) FROM orders)) // {CHUNK} AS chunk_id, o_totalprice > 100000 AS held FROM orders
  UNION ALL
  SELECT 'shop.customer', c_custkey, (c_custkey - (SELECT min(c_custkey) FROM customer)) // {CHUNK}, c_acctbal > 0 FROM customer),
events AS (
  SELECT 'shop.orders' AS tab, o_orderkey AS k, lsn AS pos FROM live
  UNION ALL SELECT 'shop.customer', o_custkey, o_orderkey FROM orders),
reads AS (
  SELECT s.tab, s.k AS id, r.run_no, s.chunk_id, r.start + s.chunk_id * {_SIGNAL_LENGTH} AS opened
  FROM source s JOIN runs r ON r.tab = s.tab AND s.chunk_id < r.k AND (r.part = 2 OR s.held)
  WHERE (r.run_no + s.chunk_id) % 7 <> 0)
SELECT tab AS "table", CAST(id AS BIGINT) AS id, run_no, CAST(chunk_id AS BIGINT) AS chunk_id, CAST(opened + {_SIGNAL_LENGTH - 1} AS BIGINT) AS lsn
FROM reads d ANTI JOIN events e ON e.tab = d.tab AND e.k = d.id AND e.pos BETWEEN d.opened AND d.opened + {_SIGNAL_LENGTH - 1}""")
def signal_backfill(spark, sf):
    """Orders and customers backfilled as signals ask for, with conditions, stops and chunks finished before a restart."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    changed = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("lsn"))
    sources = {
        "shop.orders": G.Source(orders, ["o_orderkey"], live_changes(spark, sf)),
        "shop.customer": G.Source(customers, ["c_custkey"], changed),
    }
    signals = I.parse_signals(_nation_signals(spark, sf), "shop")
    done = None
    for name, source in sources.items():
        chunks = I.plan_chunks(source.rows, source.pk[0], CHUNK).select(F.lit(name).alias("collection"), "chunk_id")
        every = chunks.withColumn("run_no", F.explode(F.sequence(F.lit(1), F.lit(50)).cast("array<bigint>")))
        part = every.where((F.col("run_no") + F.col("chunk_id")) % 7 == 0)
        done = part if done is None else done.unionByName(part)
    found = None
    for name, reads in G.signal_backfill(sources, signals, CHUNK, _SIGNAL_LENGTH, done=done).items():
        part = reads.select(F.lit(name).alias("table"), F.col(sources[name].pk[0]).cast("long").alias("id"), "run_no", "chunk_id", "lsn")
        found = part if found is None else found.unionByName(part)
    return found

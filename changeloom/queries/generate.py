"""Generated rows and row multiplication, sized by the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import generate as G
from ..operators import joins as J
from ..operators import state as S
from ..operators.blocks import long_block
from .registry import query, rounded, table


def seeded_sql(key: str, seed: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS BIGINT)"


@query("""SELECT s_suppkey, copy_no FROM supplier, (SELECT CAST(unnest(range(1, 41)) AS INTEGER) AS copy_no) m""")
def multiply_rows(spark, sf):
    return J.multiply_rows(table(spark, sf, "supplier").select("s_suppkey"), 40)


@query("""WITH numbered AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS idx FROM supplier),
many AS (SELECT s_suppkey, copy_no, idx * 40 + copy_no AS row_key
  FROM numbered, (SELECT CAST(unnest(range(1, 41)) AS INTEGER) AS copy_no) m)
SELECT s_suppkey, copy_no, row_key FROM many WHERE row_key <= (SELECT count(*) * 20 FROM supplier)""")
def multiply_rows_keyed(spark, sf):
    numbered = S.surrogate_key(
        table(spark, sf, "supplier").select("s_suppkey"), ["s_suppkey"], [long_block("s_suppkey")], "idx", 0
    )
    # The first half of all copies: the row limit is the feature, and it grows with the table.
    half = numbered.select(F.count(F.lit(1)) * 20).scalar()
    return J.multiply_rows(numbered, 40, limit=half, index="idx").drop("idx")


@query(f"""WITH raw AS (
  SELECT o_orderkey AS i, {seeded_sql('o_orderkey', 'price0')} % 35000000 + 10000 AS p,
    CASE WHEN o_orderkey % 10 = 0 THEN {seeded_sql('o_orderkey', 'discount0')} % 4000 ELSE 0 END AS d,
    {seeded_sql('o_orderkey', 'modified0')} % 94608000 AS back, md5('guid0:' || o_orderkey) AS h FROM orders)
SELECT i AS detail_id, i % 100000 + 1 AS order_id,
  lpad(CAST(i % 99999 AS VARCHAR), 8, '0') || '-' || lpad(CAST(i % 999 AS VARCHAR), 4, '0') AS tracking,
  CAST(i % 44 + 1 AS SMALLINT) AS qty, CAST(i % 516 + 1 AS INTEGER) AS product_id, CAST(i % 16 + 1 AS INTEGER) AS offer_id,
  p / 10000.0::DOUBLE AS unit_price, d / 10000.0::DOUBLE AS discount,
  substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS rowguid,
  TIMESTAMP '2026-01-01 00:00:00' - to_seconds(back) AS modified,
  ((i % 44 + 1) * p * (10000 - d) + 50) // 100 AS line_total_micros
FROM raw""")
def gen_order_details(spark, sf):
    rows = G.gen_order_details(table(spark, sf, "orders"), key="o_orderkey")
    return rows.select(
        "detail_id", "order_id", "tracking", "qty", "product_id", "offer_id", "rowguid", "modified",
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("discount").cast("double").alias("discount"),
        (F.col("line_total") * 1_000_000).cast("long").alias("line_total_micros"),
    )


@query(f"""SELECT p_partkey, p_name FROM part ORDER BY {seeded_sql('p_partkey', '7')}, p_partkey LIMIT 1""")
def random_row(spark, sf):
    return G.random_row(table(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey", "7")


@query("""SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey DESC LIMIT 1""")
def newest_row(spark, sf):
    return G.newest_row(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")

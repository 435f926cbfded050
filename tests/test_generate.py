from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from changeloom import generate as G
from changeloom.operators import joins as J
from changeloom.operators import state as S
from changeloom.operators.blocks import long_block

from .conftest import rows


def test_order_details(spark):
    got = G.gen_order_details(spark, 2_000).collect()
    assert sorted(r.detail_id for r in got) == list(range(1, 2_001))
    for r in got:
        i = r.detail_id
        assert (r.order_id, r.qty, r.product_id, r.offer_id) == (i % 100_000 + 1, i % 44 + 1, i % 516 + 1, i % 16 + 1)
        assert r.tracking == f"{i % 99_999:08d}-{i % 999:04d}"
        assert Decimal(1) <= r.unit_price < Decimal(3501)
        assert Decimal(0) <= r.discount < Decimal("0.4") and (i % 10 == 0 or r.discount == 0)
        exact = r.qty * r.unit_price * (1 - r.discount)
        assert r.line_total == exact.quantize(Decimal("0.000001"), ROUND_HALF_UP)
        assert r.modified.year in (2022, 2023, 2024, 2025)
    assert rows(G.gen_order_details(spark, 50)) == rows(G.gen_order_details(spark, 50))
    assert rows(G.gen_order_details(spark, 50, seed="1")) != rows(G.gen_order_details(spark, 50))


def test_multiply_rows(spark):
    df = spark.createDataFrame([(i,) for i in (5, 3, 9)], "id long")
    assert J.multiply_rows(df, 4).count() == 12
    numbered = S.surrogate_key(df, ["id"], [long_block("id", 1)], "idx", 0)
    many = J.multiply_rows(numbered, 4, limit=10, index="idx").orderBy("row_key").collect()
    assert [r.row_key for r in many] == list(range(1, 11))
    assert [r.id for r in many] == [3] * 4 + [5] * 4 + [9] * 2


def test_picks(spark):
    df = spark.range(0, 500).withColumn("v", F.col("id") % 3)
    assert rows(G.random_row(df, "id", "s")) == rows(G.random_row(df.orderBy(F.rand()), "id", "s"))
    assert len({G.random_row(df, "id", str(s)).first().id for s in range(6)}) > 1
    assert G.newest_row(df, "id").first().id == 499

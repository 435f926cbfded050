"""Blocked windows give what plain windows give, also across block edges."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeloom.operators import blocks as B

from .conftest import rows


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(1)
    seqs = rng.sample(range(-500, 5000), 900)
    # One group holds more than a third of the rows.
    values = [
        (rng.choice(["hot", "hot", "a", "b", "c"]), s, rng.randint(-9, 9), rng.choice([None, 1.5, 2.5]))
        for s in seqs
    ]
    return spark.createDataFrame(values, "g string, seq long, v int, x double").cache()


def by_seq():
    return W.partitionBy("g").orderBy("seq")


@pytest.mark.parametrize("bits", [2, 6, 12])
def test_running_sum_and_total(data, bits):
    got = B.running_sum(data, ["g"], ["seq"], [B.long_block("seq", bits)], F.col("v"), "s", "t")
    want = data.withColumn("s", F.sum("v").over(by_seq())).withColumn(
        "t", F.sum("v").over(W.partitionBy("g"))
    )
    assert rows(got) == rows(want)


def test_descending_running_sum(data):
    got = B.running_sum(data, ["g"], [-F.col("seq")], [-B.long_block("seq", 4)], F.col("v"), "s")
    want = data.withColumn("s", F.sum("v").over(W.partitionBy("g").orderBy(F.desc("seq"))))
    assert rows(got) == rows(want)


def test_row_index_without_groups(data):
    got = B.row_index(data, [], ["seq"], [B.long_block("seq", 5)], "i", start=1)
    want = data.withColumn("i", F.row_number().over(W.orderBy("seq")).cast("long"))
    assert rows(got) == rows(want)


def test_range_block_is_monotone_and_splits(data):
    placed = data.withColumn("b", B.range_block(data, "seq", rows=100))
    found = placed.orderBy("seq").select("b").collect()
    numbers = [r.b for r in found]
    assert numbers == sorted(numbers)
    assert len(set(numbers)) >= 9
    got = B.row_index(data, ["g"], ["seq"], [B.range_block(data, "seq", 50)], "i")
    want = data.withColumn("i", (F.row_number().over(by_seq()) - 1).cast("long"))
    assert rows(got) == rows(want)


def test_two_part_blocks(data):
    got = B.row_index(data, [], ["g", "seq"], ["g", B.long_block("seq", 6)], "i")
    want = data.withColumn("i", (F.row_number().over(W.orderBy("g", "seq")) - 1).cast("long"))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("order", [["seq"], ["seq", "v"]])
def test_previous_and_following(data, order):
    block = [B.long_block("seq", 4)]
    got = B.previous(data, ["g"], order, block, {"p": "v", "q": "x"})
    want = data.withColumn("p", F.lag("v").over(by_seq())).withColumn("q", F.lag("x").over(by_seq()))
    assert rows(got) == rows(want)
    got = B.following(data, ["g"], order, block, {"p": "v", "q": "x"})
    want = data.withColumn("p", F.lead("v").over(by_seq())).withColumn("q", F.lead("x").over(by_seq()))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("width,per_block", [(3, 4), (5, 7), (9, 3), (4, 1000)])
def test_moving_mean(data, width, per_block):
    got = B.moving_mean(
        data, ["g"], ["seq"], [B.long_block("seq", 5)], "v", width, "m", rows_per_block=per_block
    )
    half = width // 2
    want = data.withColumn("m", F.avg("v").over(by_seq().rowsBetween(-half, half)))
    assert rows(got.withColumn("m", F.round("m", 9))) == rows(want.withColumn("m", F.round("m", 9)))


def test_moving_mean_leaves_short_series(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20)], "g string, seq long, v int")
    got = B.moving_mean(df, ["g"], ["seq"], [B.long_block("seq")], "v", 5, "m")
    assert rows(got) == [("a", 1, 10, 10.0), ("a", 2, 20, 20.0)]


@pytest.mark.parametrize("share", [2, 3, 100])
def test_hot_groups_only_are_cut(data, share):
    block = B.hot_block(data, ["g"], B.long_block("seq", 4), share)
    cut = data.withColumn("b", block).groupBy("g").agg(F.countDistinct("b").alias("n")).collect()
    blocks = {r.g: r.n for r in cut}
    assert (blocks["hot"] > 10) == (share > 2)
    assert (blocks["a"] == 1) == (share < 100)
    got = B.previous(data, ["g"], ["seq"], [block], {"p": "v"})
    assert rows(got) == rows(data.withColumn("p", F.lag("v").over(by_seq())))
    got = B.row_index(data, ["g"], ["seq"], [block], "i")
    assert rows(got) == rows(data.withColumn("i", (F.row_number().over(by_seq()) - 1).cast("long")))


def largest_block(df, blocks):
    return df.groupBy(*blocks).count().agg(F.max("count")).first()[0]


def test_range_blocks_of_uneven_keys(spark):
    """An outlier, a constant first key, and a value with a third of all rows."""
    outlier = spark.range(0, 20_000).union(spark.createDataFrame([(10**15,)], "id long"))
    assert largest_block(outlier, [B.range_block(outlier, "id", 500)]) <= 500
    constant = spark.range(0, 20_000).select(F.lit(7).alias("a"), "id")
    assert largest_block(constant, B.range_blocks(constant, ["a", "id"], 500)) <= 500
    third = spark.range(0, 30_000).select(F.when(F.col("id") % 3 == 0, 5_000).otherwise(F.col("id")).alias("a"), "id")
    blocks = B.range_blocks(third, ["a", "id"], 500)
    assert largest_block(third, blocks) <= 500
    text = spark.range(0, 5_000).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("s"))
    for df, keys in ((outlier, ["id"]), (constant, ["a", "id"]), (third, ["a", "id"]), (text, ["s"])):
        numbered = B.row_index(df, [], keys, B.range_blocks(df, keys, 500), "n")
        want = {tuple(r): i for i, r in enumerate(sorted(map(tuple, df.collect())))}
        assert {tuple(r)[:-1]: r.n for r in numbered.collect()} == want


@pytest.mark.parametrize("bits", [0, 2, 12])
def test_super_blocks_carry_everything(spark, monkeypatch, bits):
    monkeypatch.setattr(B, "SUPER_BITS", bits)
    df = spark.range(0, 3_000).select((F.col("id") * 7 % 3_001).alias("k"), F.lit("g").alias("g"), (F.col("id") % 5).alias("v"))
    data = sorted(map(tuple, df.collect()))
    total, want = 0, {}
    for n, (k, _, v) in enumerate(data):
        total += v
        want[k] = (n, total, data[n - 1][0] if n else None, data[n + 1][0] if n + 1 < len(data) else None)
    for by in ([], ["g"]):
        block = [B.long_block("k", 4)]
        found = B.row_index(df, by, ["k"], block, "n")
        found = B.running_sum(found, by, ["k"], block, F.col("v"), "s")
        found = B.previous(found, by, ["k"], block, {"p": "k"})
        found = B.following(found, by, ["k"], block, {"f": "k"})
        assert {r.k: (r.n, r.s, r.p, r.f) for r in found.collect()} == want


def test_range_index_numbers_composite_keys_once(spark):
    keys = [(None, 1), (1, None), (1, 2), (1, 2), (2, 1), (2, 3), (1 << 40, 0)]
    data = spark.createDataFrame(keys * 40, "a long, b long").repartition(7)
    numbered = B.range_index(data, ["a", "b"], "n", start=5)
    got = sorted((tuple(r) for r in numbered.collect()), key=lambda r: r[2])
    assert [r[2] for r in got] == list(range(5, 5 + len(keys) * 40))
    order = [tuple(-1 if x is None else x for x in r[:2]) for r in got]
    assert order == sorted(order)
    # The numbers are written, so plans that read them hold neither windows nor sketches.
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "percentile_approx" not in plan
    assert B.range_index(data.where("a < 0"), ["a"], "n").count() == 0

"""Order statistics equal sorting, for any shape of data."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from changeloom.operators import order_stats as O


def _values(kind):
    rng = random.Random(7)
    if kind == "doubles":
        return [rng.uniform(-1e3, 1e3) for _ in range(997)]
    if kind == "tiny":
        return [rng.uniform(0, 1e-9) for _ in range(400)]
    if kind == "wide":
        return [10.0 ** rng.uniform(-300, 300) * rng.choice([-1, 1]) for _ in range(600)]
    if kind == "extreme":
        return [-1.7e308, 1.7e308] + [float(i) for i in range(300)]
    if kind == "equal":
        return [4.25] * 500
    return [float(rng.choice([1, 1, 1, 2, 3, 1000])) for _ in range(700)]


@pytest.mark.parametrize("levels", [1, 2, 3])
@pytest.mark.parametrize("kind", ["doubles", "tiny", "wide", "extreme", "equal", "copies"])
def test_matches_sorting(spark, kind, levels):
    values = _values(kind)
    df = spark.createDataFrame([("g", v) for v in values] + [("one", 3.5), ("one", None)], "g string, v double")
    got = {r.g: r for r in O.exact_percentile(df, ["g"], "v", {"p50": 50, "p95": 95, "p99": 99, "p100": 100}, levels).collect()}
    ordered, n = sorted(values), len(values)
    assert got["g"].n == n
    assert got["g"].p50 == ordered[n * 50 // 100]
    assert got["g"].p95 == ordered[n * 95 // 100]
    assert got["g"].p99 == ordered[n * 99 // 100]
    assert got["g"].p100 == ordered[-1]
    assert (got["one"].n, got["one"].p99) == (1, 3.5)


@pytest.mark.parametrize("n", [1, 2, 99, 100, 101, 200])
def test_index_rule(spark, n):
    df = spark.range(1, n + 1).select(F.lit("g").alias("g"), F.col("id").alias("v"))
    row = O.exact_percentile(df, ["g"], "v", {"p99": 99}).first()
    assert row.p99 == list(range(1, n + 1))[min(n * 99 // 100, n - 1)]
    median = O.median_of(df, ["g"], "v").first().median
    assert median == statistics.median(range(1, n + 1))


def test_decimal_and_integer_types(spark):
    df = spark.range(1, 1001).select(
        F.lit("g").alias("g"), (F.col("id").cast("decimal(18,4)") / 8).cast("decimal(18,4)").alias("v"), F.col("id").cast("int").alias("i")
    )
    row = O.exact_percentile(df, ["g"], "v", {"p": 95}).first()
    assert float(row.p) == 951 / 8
    assert O.exact_percentile(df, ["g"], "i", {"p": 95}).first().p == 951


def test_approx_is_close(spark):
    df = spark.range(1, 10_001).select(F.lit("g").alias("g"), F.col("id").alias("v"))
    row = O.approx_percentile(df, ["g"], "v", {"p50": 50}).first()
    assert abs(row.p50 - 5_000) <= 2


def test_more_groups_than_slots(spark, monkeypatch):
    """Groups that share a slot keep each its own answer."""
    monkeypatch.setattr(O, "RANGE_SLOTS", 8)
    df = spark.range(6_000).select((F.col("id") % 60).alias("g"), (F.col("id") * F.pmod("id", F.lit(7)) + F.col("id") % 60 * 1e4).alias("v"))
    got = {r.g: (r.p50, r.p99) for r in O.exact_percentile(df, ["g"], "v", {"p50": 50, "p99": 99}).collect()}
    for g in range(60):
        ordered = sorted(i * (i % 7) + g * 1e4 for i in range(6_000) if i % 60 == g)
        assert got[g] == (ordered[50], ordered[99])


def test_rows_outside_the_slices_are_not_shuffled(spark):
    """Of 200,000 rows in a few groups, the joins that look for the slices see a small part."""
    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), F.rand(5).alias("v"))
    rows = df.select("g", F.col("v").alias("__v"))
    ranks = {"p50": O.percentile_rank(50), "p99": O.percentile_rank(99)}
    targets = O._first_level(rows, ["g"], ranks)
    assert 0 < O._near(rows, targets, ["g"], ranks).count() < 2_000

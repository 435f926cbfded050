import pytest
from pyspark.sql import functions as F

from changeloom.operators import scoring as R

from .conftest import rows

# Published results of five tuning cases on two sources: seconds and messages per second.
FIRST = [("C1", 53.8, 37166.0), ("C2", 68.0, 29410.0), ("C3", 71.4, 28022.0), ("C4", 66.3, 30177.0), ("C5", 68.3, 29296.0)]
SECOND = [("C1", 98.6, 20294.0), ("C2", 120.8, 16561.0), ("C3", 85.9, 23277.0), ("C4", 112.5, 17782.0), ("C5", 125.1, 15983.0)]
SCHEMA = "case string, total_sec double, msg_s double"


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(FIRST, SCHEMA), spark.createDataFrame(SECOND, SCHEMA)


def test_head_to_head(runs):
    got = {r.case: round(r.msg_s_diff_pct) for r in R.head_to_head(*runs, "case", ["msg_s"]).collect()}
    assert got == {"C1": 83, "C2": 78, "C3": 20, "C4": 70, "C5": 83}


def test_best_case(runs):
    first, second = runs
    ranks = {r.case: r["rank"] for r in R.best_case(first, "msg_s").collect()}
    assert ranks == {"C1": 1, "C4": 2, "C2": 3, "C5": 4, "C3": 5}
    slow = {r.case: round(r.pct_slower, 1) for r in R.best_case(first, "total_sec", True).collect()}
    assert slow["C1"] == 0.0 and slow["C4"] == 23.2 and slow["C3"] == 32.7
    assert [r.case for r in R.best_case(second, "msg_s").where("is_best").collect()] == ["C3"]


def test_ranks_with_ties_and_groups(spark):
    df = spark.createDataFrame(
        [("a", 5.0), ("a", 5.0), ("a", 9.0), ("a", 1.0), ("b", 2.0), ("b", 2.0)], "g string, m double"
    )
    got = R.best_case(df, "m", by=["g"]).select("g", "m", "rank", "is_best")
    assert rows(got) == [
        ("a", 1.0, 4, False), ("a", 5.0, 2, False), ("a", 5.0, 2, False), ("a", 9.0, 1, True), ("b", 2.0, 1, True), ("b", 2.0, 1, True)
    ]


def test_scores(spark, runs):
    got = {r.case: r for r in R.min_max_score(runs[0], {"msg_s": False, "total_sec": True}, ["case"]).collect()}
    assert (got["C1"].msg_s_score, got["C1"].total_sec_score) == (1.0, 1.0)
    assert (got["C3"].msg_s_score, got["C3"].total_sec_score) == (0.0, 0.0)
    equal = spark.createDataFrame([("a", 3.0), ("b", 3.0)], "case string, m double")
    assert {r.m_score for r in R.min_max_score(equal, {"m": True}).collect()} == {0.5}


def test_radar(spark):
    runs = spark.createDataFrame([("a", 10.0, 1.0, 5.0, 2.0), ("b", 20.0, 3.0, 9.0, 4.0)], "run string, msg_s double, mb_s double, total_sec double, total_mb double")
    series = spark.createDataFrame([("a", 10.0), ("a", 30.0)], "run string, p50 double")
    got = {r.run: tuple(r)[1:] for r in R.radar_scores(runs, series).collect()}
    assert got == {"a": (0.0, 0.0, 1.0, 1.0, 1.0), "b": (1.0, 1.0, 0.0, 0.0, 0.0)}


def test_baseline_and_scale(spark):
    runs = spark.createDataFrame(
        [("json_schema", 8820.05, 3876.4), ("json", 1295.56, 23509.7), ("avro", 409.63, 29674.4)], "run string, total_mb double, msg_s double"
    )
    got = {r.run: round(r.size, 2) for r in R.vs_baseline(runs, "run", "avro", {"size": "total_mb"}).collect()}
    assert got == {"json_schema": 21.53, "json": 3.16, "avro": 1.0}
    missing = R.vs_baseline(runs, "run", "none", {"size": "total_mb"}).collect()
    assert {r.size for r in missing} == {None}
    best = spark.createDataFrame([("s", 37166.0)], "run string, msg_s double")
    times = {r.row_count: r.seconds for r in R.time_at_scale(best, [10**8, 10**9]).collect()}
    assert round(times[10**8] / 60) == 45 and round(times[10**9] / 3600, 1) == 7.5


def test_matrices(spark, runs):
    wide = {r.metric: r for r in R.case_matrix(runs[0], "case", ["total_sec", "msg_s"], ["C1", "C2", "C3", "C4", "C5"]).collect()}
    assert wide["msg_s"].C3 == 28022.0 and wide["total_sec"].C5 == 68.3
    samples = spark.createDataFrame(
        [("r1", "k", 0.0), ("r1", "k", 10.0), ("r2", "k", 30.0), ("r3", "k", 20.0), ("r3", "s", 1.0)], "run string, container string, cpu double"
    )
    got = rows(R.system_matrix(samples, ["cpu"], ["k", "s"]))
    assert got == [("r1", 0.0, 0.0), ("r2", 1.0, 0.0), ("r3", 0.5, 1.0)]


def test_speedup(spark):
    slow = spark.createDataFrame([("Person", 4.8), ("Customer", 1.7), ("Detail", None)], "table string, sec double")
    fast = spark.createDataFrame([("Person", 1.1), ("Customer", 1.2), ("Detail", 6.3), ("Product", 0.05)], "table string, sec double")
    got = {r.table: r.speedup and round(r.speedup, 1) for r in R.speedup_per_table(slow, fast, "table", "sec").collect()}
    assert got == {"Person": 4.4, "Customer": 1.4, "Detail": None, "Product": None}


def test_ranks_with_an_outlier(spark):
    """One far value does not put all others into one part."""
    from changeloom.operators.blocks import bounds_of, place_among

    values = [float(i) for i in range(20_000)] + [1e15]
    df = spark.createDataFrame([(v,) for v in values], "m double")
    got = {r.m: r["rank"] for r in R.best_case(df, "m", lower_is_better=True).collect()}
    assert got == {v: i + 1 for i, v in enumerate(values)}
    bounds = F.array(*[F.lit(x) for x in df.select(bounds_of(F.col("m"))).first()[0]])
    parts = df.groupBy(place_among(bounds, F.col("m"))).count().agg(F.max("count")).first()[0]
    assert parts <= 60

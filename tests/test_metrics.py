import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from changeloom.operators import aggregates as A
from changeloom.operators import audit as U
from changeloom.operators import filters as X
from changeloom.operators import series as S
from changeloom.operators.blocks import long_block

from .conftest import rows

T0 = dt.datetime(2026, 2, 25, 12, 0, 0)


def _at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_eta(spark):
    samples = [
        (0, 1000, 0), (10, 1000, 500), (20, 1000, 500), (30, 2000, 500), (40, 2000, 505), (45, 100_000, 100),
        (50, 100_000, 110), (60, 100_000, 130), (70, 10, 20), (70, 0, 0),
    ]
    df = spark.createDataFrame(
        [("t" if i < 9 else "empty", _at(s), e, c) for i, (s, e, c) in enumerate(samples)],
        "topic string, ts timestamp, end_offset long, committed long",
    )
    got = S.drain_rate_eta(df, block_seconds=15).where("topic = 't'").orderBy("ts").collect()
    assert [(r.lag, r.consumed_pct, r.rate, r.eta) for r in got] == [
        (1000, 0, 0, "--"),
        (500, 50, 50, "10s"),
        (500, 50, 0, "--"),
        (1500, 25, 0, "--"),
        (1495, 25, 0, "--"),
        (99_900, 0, 0, "--"),
        (99_890, 0, 2, "13h 52m"),
        (99_870, 0, 2, "13h 52m"),
        (0, 100, 9987, "0s"),
    ]
    assert S.drain_rate_eta(df).where("topic = 'empty'").first().consumed_pct == 0


def test_counter_rates_and_cpu(spark):
    mb = 1_048_576
    data = [
        ("a", _at(0), 0, 100, 1000, 4), ("a", _at(2), 4 * mb, 300, 2000, 4), ("a", _at(2.0001), 5 * mb, 400, 2000, 4),
        ("a", _at(10), 0, 500, 1500, None), ("b", _at(1), 7 * mb, 0, 0, 1),
    ]
    df = spark.createDataFrame(data, "container string, ts timestamp, rx long, cpu_total long, system_cpu long, online_cpus int")
    for width in (1, 3, 3600):
        rates = S.counter_rates(df, ["rx"], block_seconds=width).orderBy("container", "ts").collect()
        assert [round(r.rx_mb_s, 3) for r in rates] == [0.0, 2.0, 1000.0, round(-5 / 7.9999, 3), 0.0]
        cpu = S.cpu_percent(df, block_seconds=width).orderBy("container", "ts").collect()
        assert [r.cpu_pct for r in cpu] == [0.0, 80.0, 0.0, 0.0, 0.0]


def test_memory(spark):
    mb = 1_048_576
    df = spark.createDataFrame([(3 * mb, mb, 4 * mb), (mb, None, 0)], "mem_usage long, cache long, mem_limit long")
    got = S.memory_rss(df).collect()
    assert (got[0].mem_mb, got[0].mem_limit_mb, got[0].mem_pct) == (2.0, 4.0, 50.0)
    assert (got[1].mem_mb, got[1].mem_pct) == (1.0, 0.0)


def test_flatten_stats(spark):
    df = spark.createDataFrame(
        [
            (1, {"e0": (1, 2), "e1": (10, 20)}, [("Read", 5), ("read", 6), ("WRITE", 7), ("sync", 9)]),
            (2, None, None),
            (3, {}, []),
        ],
        "id int, networks map<string,struct<rx_bytes:long,tx_bytes:long>>, blkio array<struct<op:string,value:long>>",
    )
    assert rows(S.flatten_stats(df)) == [(1, 11, 22, 11, 7), (2, 0, 0, 0, 0), (3, 0, 0, 0, 0)]


def test_sample_series_fills_empty_windows(spark, monkeypatch):
    monkeypatch.setattr(S, "FILL_STEP", 3)
    data = [("r", _at(0.5), 10, 5.0), ("r", _at(1.9), 30, 7.0), ("r", _at(20.1), 100, 1.0)]
    df = spark.createDataFrame(data, "run string, timestamp timestamp, message_bytes long, latency_ms double")
    got = S.sample_series(df, 2, ["run"]).orderBy("bucket").collect()
    assert len(got) == 11
    assert [g.bucket - got[0].bucket for g in got] == [2 * i for i in range(11)]
    assert (got[0].messages, got[0].bytes, got[0].msg_s, got[0].avg_bytes, got[0].p50, got[0].p99) == (2, 40, 1.0, 20.0, 6.0, 7.0)
    assert (got[5].messages, got[5].msg_s, got[5].p50, got[5].p99, got[5].avg_bytes) == (0, 0.0, 0.0, 0.0, 0.0)
    total = S.cumulative(got and S.sample_series(df, 2, ["run"]), ["run"], "bucket", "messages", 6, bits=2)
    assert [r.cumulative for r in total.orderBy("bucket").collect()] == [2] * 10 + [3]
    assert total.orderBy(F.desc("bucket")).first().pct_of_expected == 50.0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_stop_at_idle_against_a_loop(spark, seed):
    rng = random.Random(seed)
    data, want = [], []
    for run in ("a", "b"):
        t, stopped, n = 0, False, 0
        for i in range(120):
            step = rng.choice([0, 1, 5, 30, 60, 60] + ([61, 200] if i > 40 else []))
            t += step
            stopped = stopped or (i > 0 and step > 60)
            data.append((run, i, _at(t)))
            if not stopped and n < 70:
                want.append((run, i))
                n += 1
    df = spark.createDataFrame(data, "run string, i int, timestamp timestamp")
    got = S.stop_at_idle(df, 60, ["run"], limit=70, order=["i"], block_seconds=45)
    assert rows(got.select("run", "i")) == sorted(want, key=lambda r: (r[0], str(r[1])))


def test_phase_durations(spark):
    starts = [("r", "Person", 0.0, 19_982), ("r", "Customer", 1.116, 19_820), ("r", "Header", 2.268, 31_465), ("r", "end", 3.856, 0)]
    df = spark.createDataFrame([(r, t, _at(s), n) for r, t, s, n in starts], "run string, table string, ts timestamp, rows long")
    got = {r.table: r for r in S.phase_durations(df, block_seconds=1).collect()}
    assert round(got["Person"].duration_sec, 3) == 1.116
    assert round(got["Person"].rows_s) == round(19_982 / 1.116)
    assert got["end"].duration_sec is None


def test_message_summary(spark):
    df = spark.createDataFrame([("t", 100, 10.0), ("t", 300, 14.0), ("one", 50, 3.0)], "topic string, message_bytes long, arrival double")
    got = {r.topic: r for r in A.message_summary(df, ["topic"]).collect()}
    assert (got["t"].messages, got["t"].msg_s, got["t"].avg_bytes, got["t"].elapsed_sec) == (2, 0.5, 200.0, 4.0)
    assert (got["one"].msg_s, got["one"].mb_s) == (0.0, 0.0)
    ended = {r.topic: r for r in A.message_summary(df, ["topic"], start=F.lit(0.0), end="run_end", run_end=F.lit(20.0)).collect()}
    assert ended["t"].msg_s == 0.1


def test_sizes_count_missing_parts_as_zero(spark):
    df = spark.createDataFrame([("k", "väl"), (None, "v"), ("k", None), (None, None)], "key string, value string")
    got = A.key_value_sizes(df).collect()
    assert [(r.key_bytes, r.value_bytes, r.message_bytes) for r in got] == [(1, 4, 5), (0, 1, 1), (1, 0, 1), (0, 0, 0)]


def test_lag(spark):
    end = spark.createDataFrame([("t", 0, 100), ("t", 1, 50), ("t", 2, 10)], "topic string, partition int, end_offset long")
    committed = spark.createDataFrame([("t", 0, 40), ("t", 2, 15)], "topic string, partition int, committed long")
    assert A.consumer_lag(end, committed).first().lag == 110
    samples = spark.createDataFrame([("a", -1), ("a", 5), ("a", 3), ("b", -1)], "run string, lag long")
    assert rows(A.lag_extremes(samples, ["run"])) == [("a", 5, 3), ("b", 0, 0)]
    assert X.valid_lag(samples).count() == 2
    means = spark.createDataFrame([("a", 0.0), ("a", 4.0), ("a", 6.0), ("b", 0.0)], "run string, cpu double")
    assert rows(A.nonzero_mean(means, ["run"], ["cpu"])) == [("a", 5.0), ("b", 0.0)]
    assert rows(A.peak(means, ["run"], ["cpu"])) == [("a", 6.0), ("b", 0.0)]


def test_tasks(spark):
    df = spark.createDataFrame(
        [
            ("c1", "RUNNING", [("RUNNING",), ("RUNNING",)]), ("c2", "RUNNING", [("RUNNING",), ("FAILED",)]),
            ("c3", "RUNNING", []), ("c4", "FAILED", [("RUNNING",)]), ("c5", None, None),
        ],
        "connector string, state string, tasks array<struct<state:string>>",
    )
    got = {r.connector: (r.tasks_total, r.tasks_running, r.tasks_failed, r.healthy) for r in A.task_rollup(df).collect()}
    assert got == {
        "c1": (2, 2, 0, True), "c2": (2, 1, 1, False), "c3": (0, 0, 0, False), "c4": (1, 1, 0, False), "c5": (0, 0, 0, False)
    }


def test_health_and_topics(spark):
    checks = spark.createDataFrame([("a", True), ("b", False), ("b", True), ("c", None)], "label string, ok boolean")
    assert rows(A.health_rollup(checks)) == [("TOTAL", "FAIL", 2, 2), ("a", "PASS", 1, 0), ("b", "FAIL", 1, 1), ("c", "FAIL", 0, 1)]
    log = spark.createDataFrame([("x", 0, 0, 10), ("x", 0, 1, 20), ("x", 1, 7, 30), (None, 0, 0, 5)], "topic string, partition int, offset long, message_bytes long")
    sizes = {r.topic: (r.messages, r.total_bytes) for r in A.topic_sizes(log).collect()}
    assert sizes == {"x": (3, 60), None: (1, 5), "TOTAL": (4, 65)}
    assert {r.topic: r.end_offset for r in A.end_offsets(log).collect()}["x"] == 10


@pytest.mark.parametrize("bits", [1, 3, 20])
def test_offset_gaps(spark, bits):
    offsets = [0, 1, 2, 5, 6, 6, 20, 40]
    log = spark.createDataFrame([("t", 0, o) for o in offsets] + [("t", 1, 3)], "topic string, partition int, offset long")
    assert rows(U.offset_gaps(log, bits=bits).select("gap_from", "gap_to", "missing")) == [(21, 39, 19), (3, 4, 2), (7, 19, 13)]


@pytest.mark.parametrize("bits", [1, 2, 20])
def test_order_audit(spark, bits):
    events = [("ok", 0, 1, 0), ("ok", 1, 2, 0), ("back", 2, 9, 1), ("back", 7, 3, 1), ("back", 8, 4, 1), ("moved", 4, 1, 0), ("moved", 5, 2, 3)]
    df = spark.createDataFrame(events, "pk string, arrived long, lsn long, partition int")
    got = U.order_audit(df, ["pk"], ["arrived"], [long_block("arrived", bits)])
    assert rows(got) == [("back", 1, False), ("moved", 0, True)]


def test_format_sizes(spark):
    df = spark.createDataFrame([(1, "ab"), (22, None)], "a int, b string")
    got = {r.format: r for r in A.useful_share(A.format_sizes(df, 100)).collect()}
    lean = len('{"a":1,"b":"ab"}') + len('{"a":22}')
    assert got["json_lean"].total_bytes == lean
    assert got["json_schema"].total_bytes == lean + 200
    assert got["json_lean"].payload_bytes == 5
    assert got["json_schema"].useful_share == 5 / (lean + 200)


def test_wire_audit_and_drift(spark):
    log = spark.createDataFrame(
        [("t", bytearray(b"\x00\x00\x00\x00\x07x")), ("t", bytearray(b"\x00\x00\x00\x00\x07y")), ("t", bytearray(b"{}"))],
        "topic string, value binary",
    )
    assert rows(U.wire_format_audit(log)) == [("t", False, None, 1), ("t", True, 7, 2)]
    docs = [
        ("t", 1, '{"a":1,"b":"x","c":1,"gone":true}'), ("t", 1, '{"a":2,"b":"x","c":2,"gone":null}'),
        ("t", 2, '{"a":"1","b":"x","c":1.5,"new":1,"maybe":1}'), ("t", 2, '{"a":"1","b":"x","c":2.25,"new":2}'), ("t", 2, "broken"),
    ]
    df = spark.createDataFrame(docs[:4], "topic string, version int, value string")
    got = {r.field: (r.change, r.old_type, r.new_type, r.breaks_backward) for r in U.schema_drift(df, "version", 1, 2).collect()}
    assert got == {
        "a": ("type_changed", "BIGINT", "STRING", True),
        "c": ("type_changed", "BIGINT", "DECIMAL", False),
        "gone": ("removed", "BOOLEAN", "", False),
        "new": ("added", "", "BIGINT", True),
        "maybe": ("added", "", "BIGINT", False),
    }
    with_broken = spark.createDataFrame(docs, "topic string, version int, value string")
    assert U.schema_fields(with_broken, "version").where("field = 'b'").count() == 2


def test_filters(spark):
    df = spark.sql("SELECT id, TIMESTAMP_NTZ '2024-12-31 00:00:00' - make_dt_interval(CAST(id AS INT)) AS d FROM range(0, 800)")
    as_of = "2024-12-31 00:00:00"
    assert X.recent_rows(df, "d", as_of).count() == 367
    assert X.recent_rows(df, "d", as_of, variant="days_365").count() == 366
    assert X.recent_rows(df, "d", as_of, variant="calendar_year").count() == 365
    with pytest.raises(ValueError):
        X.recent_rows(df, "d", as_of, variant="other")
    assert X.with_condition(df, "id % 2 = 0", "id", 10, 20).count() == 6
    lat = spark.createDataFrame([(5, 0), (5, -1), (5, 3), (5, 9), (5, None)], "arrival long, ts long")
    assert rows(X.valid_latency(lat, "arrival", "ts")) == [(5, 3, 2)]
    named = spark.createDataFrame([("a", "r"), ("b", "d")], "table string, op string")
    assert X.filter_tables(named, ["a"]).count() == X.filter_ops(named, ["d"]).count() == 1

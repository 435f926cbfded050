"""Signal-driven backfills: order, positions, stops, conditions and restarts."""

import json

import pytest

from changeloom.plans import incremental as I
from changeloom.plans import signals as G

from .conftest import rows


def log(spark, *signals, prefix="aw"):
    made = []
    for offset, kind, collections, condition in signals:
        data = {"data-collections": collections, "type": "incremental"} | ({"additional-condition": condition} if condition else {})
        made.append((offset, prefix, json.dumps({"id": str(offset), "type": kind, "data": data})))
    return I.parse_signals(spark.createDataFrame(made, "offset bigint, key string, value string"), "aw")


START, STOP = "execute-snapshot", "stop-snapshot"


def test_runs_follow_each_other(spark):
    """Tables of one signal in list order, a later signal waits, a gap is kept, unknown tables and foreign keys start nothing."""
    signals = log(spark, (5, START, ["a", "b"], None), (7, START, ["a", "x"], "k > 3"), (500, START, ["b"], None))
    found = G.plan_runs(signals, {"a": 4, "b": 2}, 10)
    assert [(r.collection, r.start, r.chunks, r.condition) for r in found] == [("a", 5, 4, None), ("b", 45, 2, None), ("a", 65, 4, "k > 3"), ("b", 500, 2, None)]
    assert G.plan_runs(log(spark, (1, START, ["a"], None), prefix="other"), {"a": 4}, 10) == []


def test_stops(spark):
    """The open chunk is finished, waiting runs are cancelled, and the next run moves up; stops of other tables or from before do nothing."""
    signals = log(
        spark, (1, STOP, ["a"], None), (2, START, ["a"], None), (3, START, ["b"], None), (4, START, ["a"], None), (6, STOP, ["x"], None), (25, STOP, ["a"], None), (26, START, ["a"], None)
    )
    found = G.plan_runs(signals, {"a": 9, "b": 2}, 10)
    # Chunks of the first run open at 2, 12 and 22; the third run was waiting when the stop came.
    assert [(r.offset, r.collection, r.start, r.chunks) for r in found] == [(2, "a", 2, 3), (3, "b", 32, 2), (4, "a", 52, 0), (26, "a", 52, 9)]
    assert G.plan_runs(log(spark, (2, START, ["a"], None), (12, STOP, ["a"], None)), {"a": 9}, 10)[0].chunks == 2


def backfill(spark, signals, live=(), done=None, mode="key_range"):
    table = spark.createDataFrame([(k, k * 10) for k in range(1, 9)] + [(20, None)], "k bigint, v bigint")
    source = G.Source(table, ["k"], spark.createDataFrame(list(live), "k bigint, lsn bigint"), mode)
    return G.signal_backfill({"a": source}, signals, 4, 10, done=done)["a"]


def test_reads_by_condition_window_and_ledger(spark):
    signals = log(spark, (0, START, ["a"], "v >= 50 OR k = 2"), (1, START, ["a"], None))
    # Chunks hold keys 1-4, 5-8 and 17-20; run 1 opens them at 0, 10 and 40, run 2 from 50 on.
    live = [(2, 9), (5, 9), (6, 10), (6, 15), (7, 20), (20, 95), (1, 55), (1, 49)]
    found = rows(backfill(spark, signals, live).select("k", "run_no", "chunk_id", "lsn"))
    first = [(5, 1, 1, 19), (7, 1, 1, 19), (8, 1, 1, 19)]
    second = [(2, 2, 0, 59), (3, 2, 0, 59), (4, 2, 0, 59), (5, 2, 1, 69), (6, 2, 1, 69), (7, 2, 1, 69), (8, 2, 1, 69)]
    assert sorted(found) == sorted(first + second)
    done = spark.createDataFrame([("a", 2, 1), ("b", 1, 1), ("a", 1, 0)], "collection string, run_no bigint, chunk_id bigint")
    again = rows(backfill(spark, signals, live, done).select("k", "run_no", "chunk_id", "lsn"))
    assert sorted(again) == sorted(first + second[:3])


def test_chunks_of_rows_and_nothing_to_do(spark):
    """Chunks of four rows; no signals, no rows, and a stop before the first chunk."""
    found = rows(backfill(spark, log(spark, (3, START, ["a"], None), (15, STOP, ["a"], None)), mode="rows").select("k", "chunk_id", "lsn"))
    assert sorted(found) == [(k, (k - 1) // 4, 12 + (k - 1) // 4 * 10) for k in range(1, 9)]
    assert backfill(spark, log(spark, (3, STOP, ["a"], None))).collect() == []
    empty = spark.createDataFrame([], "k bigint, v bigint")
    made = G.signal_backfill({"a": G.Source(empty, ["k"])}, log(spark, (3, START, ["a"], None)), 4, 10)["a"]
    assert made.collect() == [] and made.columns == ["k", "v", "run_no", "chunk_id", "op", "lsn"]


def test_a_wrong_condition_is_reported(spark):
    with pytest.raises(Exception, match="nowhere"):
        backfill(spark, log(spark, (3, START, ["a"], "nowhere = 1")))

"""Keyed state with removal: deletes leave the state, and nothing older brings a row back."""

import datetime as dt

from changeloom import streaming as K
from changeloom.streaming.latest import newest_in_task

SCHEMA = "pk bigint, seq bigint, op string, value double, ts timestamp"
START = dt.datetime(2024, 1, 1)


def _row(pk, seq, op, value, minute):
    return (pk, seq, op, value, START + dt.timedelta(minutes=minute))


def _run(spark, root, number, rows):
    """One more batch for the same query."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/log")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(f"{root}/log")
    K.latest_stream(stream, f"{root}/table", ["pk"], ["seq"], "ts", f"{root}/checkpoint", "5 minutes").awaitTermination()


def _live(spark, root):
    return sorted((r.pk, r.seq, r.value) for r in K.live_rows(spark, f"{root}/table", ["pk"], ["seq"]).collect())


def _held(spark, root):
    return sorted((r[0], r[1], r[2] > 0) for r in K.held_keys(spark, f"{root}/checkpoint").collect())


def test_deleted_keys_leave_the_state(spark, tmp_path):
    root = str(tmp_path)
    _run(spark, root, 0, [_row(1, 10, "c", 1.0, 0), _row(2, 11, "c", 2.0, 0), _row(2, 13, "d", None, 2), _row(3, 12, "c", 3.0, 1)])
    assert _live(spark, root) == [(1, 10, 1.0), (3, 12, 3.0)]
    assert _held(spark, root) == [(1, 10, False), (2, 13, True), (3, 12, False)]
    # An older event of the deleted key, and an older one of a live key, change nothing.
    _run(spark, root, 1, [_row(2, 12, "u", 9.0, 1), _row(3, 9, "c", 8.0, 1), _row(4, 14, "c", 4.0, 3)])
    assert _live(spark, root) == [(1, 10, 1.0), (3, 12, 3.0), (4, 14, 4.0)]
    # The watermark passes the delete: the tombstone goes, and only live keys are held.
    _run(spark, root, 2, [_row(5, 20, "c", 5.0, 60)])
    _run(spark, root, 3, [_row(5, 21, "u", 6.0, 61)])
    assert _live(spark, root) == [(1, 10, 1.0), (3, 12, 3.0), (4, 14, 4.0), (5, 21, 6.0)]
    assert _held(spark, root) == [(1, 10, False), (3, 12, False), (4, 14, False), (5, 21, False)]
    # What is older than the watermark is dropped before it reaches the state.
    _run(spark, root, 4, [_row(2, 12, "u", 9.0, 1), _row(6, 30, "c", 7.0, 62)])
    assert [r[0] for r in _live(spark, root)] == [1, 3, 4, 5, 6]


def test_a_key_that_comes_back_is_not_removed(spark, tmp_path):
    root = str(tmp_path)
    _run(spark, root, 0, [_row(1, 1, "c", 1.0, 0), _row(1, 2, "d", None, 1)])
    _run(spark, root, 1, [_row(1, 3, "c", 2.0, 2)])
    _run(spark, root, 2, [_row(9, 9, "c", 9.0, 60)])
    _run(spark, root, 3, [_row(9, 10, "u", 9.5, 61)])
    assert _live(spark, root) == [(1, 3, 2.0), (9, 10, 9.5)]
    assert _held(spark, root) == [(1, 3, False), (9, 10, False)]


def test_newest_in_task(spark):
    rows = [_row(1, None, "c", 0.0, 0), _row(1, 2**60 + 1, "u", 1.0, 0), _row(1, 2**60, "u", 2.0, 0), _row(None, 1, "c", 3.0, 0), _row(None, 4, "u", 4.0, 0)]
    got = newest_in_task(spark.createDataFrame(rows, SCHEMA).coalesce(1), ["pk"], ["seq"]).collect()
    assert sorted(((r.pk is None, r.pk), r.seq, r.value) for r in got) == [((False, 1), 2**60 + 1, 1.0), ((True, None), 4, 4.0)]
    assert newest_in_task(spark.createDataFrame([], SCHEMA), ["pk"], ["seq"]).count() == 0

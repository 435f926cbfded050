"""Sessions, windows and totals that are kept up over many batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from changeloom import streaming as K
from changeloom.operators import audit as U
from changeloom.sources import tables as TB

from .conftest import rows

T0 = dt.datetime(2026, 2, 25, 12, 0, 0)
SCHEMA = "topic string, timestamp timestamp, v double"


def _files(spark, path, parts):
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(path)


def _plain_sessions(events, idle):
    """Sort and cut, as a person would."""
    found = []
    for topic in sorted({e[0] for e in events}):
        times = sorted(e[1] for e in events if e[0] == topic and e[1] is not None)
        run = times[:1]
        for t in times[1:]:
            if (t - run[-1]).total_seconds() > idle:
                found.append((topic, run[0], run[-1], len(run)))
                run = []
            run.append(t)
        if run:
            found.append((topic, run[0], run[-1], len(run)))
    return sorted(found)


def _events(rng, n=300):
    """A hot topic, equal times, silences of exactly the idle time and one second more, a null time."""
    out, at = [("hot", None, 0.0)], 0
    for i in range(n):
        at += rng.choice([0, 1, 30, 60, 61, 200])
        out.append(("hot" if i % 3 else f"t{i % 4}", T0 + dt.timedelta(seconds=at), float(i % 17)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions_of_any_order_are_whole(spark, tmp_path, seed):
    rng = random.Random(seed)
    events = _events(rng)
    rng.shuffle(events)
    target = str(tmp_path / "slots")
    stream = _files(spark, str(tmp_path / "in"), [events[:100], events[100:110], events[110:]])
    K.session_stream(stream, target, 60, ["topic"], str(tmp_path / "cp")).awaitTermination()
    want = _plain_sessions(events, 60)
    found = K.stored_sessions(spark, target, 60, ["topic"]).select("topic", "session_start", "last_message", "messages")
    assert rows(found) == [(*r[:3], r[3]) for r in want]
    assert K.compact_sessions(spark, target, ["topic"]) == 2
    assert rows(K.stored_sessions(spark, target, 60, ["topic"]).select("topic", "session_start", "last_message", "messages")) == want
    # A batch that is delivered again changes nothing, a late one joins two sessions.
    again = spark.createDataFrame([("hot", T0 - dt.timedelta(seconds=60), 0.0)], SCHEMA)
    for _ in range(2):
        TB.deliver(K.session_slots(again, 60, ["topic"]), 3, target)
    want = _plain_sessions([*events, ("hot", T0 - dt.timedelta(seconds=60), 0.0)], 60)
    assert rows(K.stored_sessions(spark, target, 60, ["topic"]).select("topic", "session_start", "last_message", "messages")) == want


def test_sessions_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert K.sessions_of(K.session_slots(empty, 60, ["topic"]), 60, ["topic"]).count() == 0
    before = [("t", dt.datetime(1969, 12, 31, 23, 59, 30), 0.0), ("t", dt.datetime(1970, 1, 1, 0, 0, 10), 0.0)]
    slots = K.session_slots(spark.createDataFrame(before, SCHEMA), 60, ["topic"])
    assert sorted(r.slot for r in slots.collect()) == [-1, 0]
    now = F.lit(dt.datetime(1970, 1, 1, 0, 1, 10)).cast("timestamp")
    only = K.sessions_of(slots, 60, ["topic"], now).first()
    assert (only.messages, only.ended) == (2, False)
    with pytest.raises(ValueError):
        K.session_slots(empty, 0, ["topic"])


def test_windows_are_settled_by_the_batches_that_touch_them(spark, tmp_path):
    rng = random.Random(3)
    days = [(T0 + dt.timedelta(days=d, seconds=rng.randrange(40)), float(rng.randrange(50))) for d in range(5) for _ in range(40)]
    events = [(rng.choice(["hot", "hot", "cold"]), t, v) for t, v in days]
    # The second batch is one window of day 0 again; the third is empty of times.
    parts = [events, [("hot", T0, 1000.0)], [("hot", None, 5.0)]]
    staging, target = str(tmp_path / "rows"), str(tmp_path / "table")
    log = _files(spark, str(tmp_path / "in"), parts).select("topic", "timestamp", F.lit(10).cast("long").alias("message_bytes"), F.col("v").alias("latency_ms"))
    K.window_stream(K.window_rows(log, "10 seconds", ["topic"]), staging, target, 10, str(tmp_path / "cp"), ["topic"]).awaitTermination()
    whole = spark.createDataFrame([e for p in parts for e in p], SCHEMA).where("timestamp IS NOT NULL")
    plain = K.window_rows(whole.select("topic", "timestamp", F.lit(10).cast("long").alias("message_bytes"), F.col("v").alias("latency_ms")), "10 seconds", ["topic"])
    want = K.window_metrics(plain, 10, ["topic"])
    found = K.settled_windows(spark, target, ["topic"])
    assert rows(found.select(*want.columns)) == rows(want)
    changed = found.where("settled_in > 0").collect()
    assert [(r.topic, r.window_start) for r in changed] == [("hot", T0)]
    # What the second batch had to read: that window's rows, from one day of five.
    second = spark.createDataFrame(parts[1], SCHEMA).select(
        F.window("timestamp", "10 seconds").start.alias("window_start"), "topic", F.unix_date(F.to_date("timestamp")).alias("day")
    )
    read = K.touched_rows(second, TB.delivered(spark, staging, partitioned=True), ["topic"])
    assert read.count() == changed[0].messages < 40
    assert "PartitionFilters: [isnotnull(day" in read._jdf.queryExecution().toString()
    assert K.compact_windows(spark, target, ["topic"]) is not None
    assert rows(K.settled_windows(spark, target, ["topic"]).select(*want.columns)) == rows(want)


def test_totals_outlast_the_retained_reports(spark, tmp_path):
    """Twelve batches, two retained reports; rows of every second batch lie before the watermark once it has moved."""
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        parts = []
        for i in range(6):
            parts += [[("t", T0 + dt.timedelta(hours=i + 1), float(i))], [("t", T0 - dt.timedelta(hours=i + 1), 100.0 + i)]]
        stream = _files(spark, str(tmp_path / "in"), parts)
        deduped = stream.withWatermark("timestamp", "1 minute").dropDuplicatesWithinWatermark(["v"])
        with K.StreamTotals.of(spark) as totals:
            query = (
                deduped.writeStream.format("parquet").option("path", str(tmp_path / "out"))
                .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
            )
            query.awaitTermination()
            sums = totals.wait(query)
            assert totals.now(query) == sums
        assert sums["input_rows"] == 12 and sums["batches"] >= 12
        # No row repeats, so what is not in the output was late.
        assert sums["late_rows"] == 12 - spark.read.parquet(str(tmp_path / "out")).count() >= 5
        assert K.late_rows(query) < sums["late_rows"]
        with pytest.raises(TimeoutError):
            K.StreamTotals().wait(query, 0.01)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


@pytest.mark.parametrize("changes", [0, 1, 40])
def test_digest_difference_equals_row_difference(spark, changes):
    rng = random.Random(changes)
    left = [(i % 900 if i % 50 else None, f"v{rng.randrange(5)}", rng.choice([None, 0.5, float("nan")])) for i in range(1000)]
    right = list(left)
    for _ in range(changes):
        at = rng.randrange(len(right))
        right[at] = (right[at][0], "changed", right[at][2])
        right.pop(rng.randrange(len(right)))
        right.append(left[rng.randrange(len(left))])
    a, b = (spark.createDataFrame(x, "id int, name string, x double") for x in (left, right))
    found = U.digest_difference(a, b, ["id"], 8, 16)
    assert [str(r) for r in rows(found)] == [str(r) for r in rows(U.row_difference(a, b))]
    assert U.digest_difference(a.limit(0), b.limit(0), ["id"]).count() == 0


def test_digest_difference_shuffles_only_what_differs(spark):
    left = spark.range(20_000).select("id", (F.col("id") * 3).alias("v"))
    right = left.withColumn("v", F.when(F.col("id") == 77, 0).otherwise(F.col("v")))
    found = U.digest_difference(left, right, ["id"], 64, 64)
    assert rows(found) == [(77, 0, -1), (77, 231, 1)]
    # The rows that reach the last exchange are those of one twig.
    assert U._MOST_OPENED >= 64
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan

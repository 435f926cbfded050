import datetime as dt

import pytest
from pyspark.sql import functions as F

from changeloom import streaming as K
from changeloom.operators import decode as D
from changeloom.operators import filters as X
from changeloom.operators import state as S
from changeloom.plans import incremental as I
from changeloom.sources import log as L
from changeloom.sources import tables as TB

from .conftest import rows
from .test_decode import PERSON, _log

T0 = dt.datetime(2026, 2, 25, 12, 0, 0)
SCHEMA = "pk int, lsn long, op string, v int, timestamp timestamp, topic string, partition int, offset long"


def _events(n=120):
    ops = {}
    out = []
    for i in range(n):
        k = i * 7 % 11 if i % 3 else 0
        op = "c" if ops.get(k, "d") == "d" else ("d" if i % 5 == 0 else "u")
        ops[k] = op
        out.append((k, i, op, i, T0 + dt.timedelta(seconds=i), "t", k % 2, i))
    return out


def _feed(spark, path, events):
    spark.createDataFrame(events, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path, **options):
    return spark.readStream.schema(SCHEMA).options(**options).parquet(path)


def test_materialize_equals_batch_and_goes_on(spark, tmp_path):
    src, target, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    events = _events()
    # Backfill and live events arrive out of order; position decides.
    for part in (events[80:], events[:40], events[40:80]):
        _feed(spark, src, part)
    K.materialize_stream(
        _stream(spark, src, maxFilesPerTrigger="1"), target, ["pk"], ["lsn"], cp
    ).awaitTermination()
    batch = S.materialize(spark.createDataFrame(events, SCHEMA), ["pk"], ["lsn"])
    assert rows(K.live_rows(spark, target, ["pk"], ["lsn"])) == rows(batch)
    more = [(99, 500, "c", 1, T0, "t", 0, 500)]
    _feed(spark, src, more)
    K.materialize_stream(_stream(spark, src), target, ["pk"], ["lsn"], cp).awaitTermination()
    again = S.materialize(spark.createDataFrame(events + more, SCHEMA), ["pk"], ["lsn"])
    assert rows(K.live_rows(spark, target, ["pk"], ["lsn"])) == rows(again)


def test_latest_state_in_complete_mode(spark, tmp_path):
    src = str(tmp_path / "in")
    _feed(spark, src, _events())
    state = K.latest_state(_stream(spark, src), ["pk"], ["lsn"])
    query = (
        state.writeStream.outputMode("complete").format("memory").queryName("latest_state")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    want = S.latest_per_key(spark.createDataFrame(_events(), SCHEMA), ["pk"], ["lsn"])
    assert rows(spark.table("latest_state")) == rows(want)


def test_dedupe_and_consume_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    events = _events(60)
    _feed(spark, src, events + events[::4])
    deduped = K.dedupe_stream(_stream(spark, src))
    K.consume_once(deduped, out, cp)
    assert rows(spark.read.parquet(out)) == rows(spark.createDataFrame(events, SCHEMA))
    K.consume_once(K.dedupe_stream(_stream(spark, src)), out, cp)
    assert spark.read.parquet(out).count() == 60
    _feed(spark, src, events[50:] + [(1, 61, "u", 0, T0 + dt.timedelta(seconds=61), "t", 1, 61)])
    K.consume_once(K.dedupe_stream(_stream(spark, src)), out, cp)
    assert spark.read.parquet(out).count() == 61


def test_tumbling_metrics_equal_batch_but_for_the_open_tail(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    _feed(spark, src, _events())
    log = _stream(spark, src).select(
        "timestamp", F.lit(100).alias("message_bytes"), F.col("v").cast("double").alias("latency_ms")
    )
    K.consume_once(K.tumbling_metrics(log, "10 seconds", "0 seconds"), out, cp)
    got = spark.read.parquet(out).orderBy("window_start").collect()
    assert [r.messages for r in got] == [10] * 11
    assert {(r.bytes, r.msg_s, r.avg_bytes) for r in got} == {(1000, 1.0, 100.0)}
    assert [r.approx_p99 for r in got] == [float(10 * i + 9) for i in range(11)]


def test_window_metrics_are_exact_and_cover_all_windows(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    _feed(spark, src, _events(115))
    log = _stream(spark, src).select("timestamp", F.lit(100).alias("message_bytes"), F.col("v").cast("double").alias("latency_ms"))
    K.consume_once(K.window_rows(log, "10 seconds"), out, cp)
    stored = spark.read.parquet(out)
    got = K.window_metrics(stored, 10).orderBy("window_start").collect()
    assert [r.messages for r in got] == [10] * 11 + [5]
    assert [r.p50 for r in got] == [10 * i + 4.5 for i in range(11)] + [112.0]
    assert [r.p99 for r in got] == [10 * i + 9.0 for i in range(11)] + [114.0]
    until = F.lit(T0 + dt.timedelta(seconds=30)).cast("timestamp")
    assert K.window_metrics(stored, 10, closed_before=until).count() == 3


def test_idle_sessions_and_late_rows(spark, tmp_path):
    src, cp = str(tmp_path / "in"), str(tmp_path / "cp")

    def at(second, i):
        return (1, i, "u", 0, T0 + dt.timedelta(seconds=second), "t", 0, i)

    _feed(spark, src, [at(s, i) for i, s in enumerate((0, 60, 120, 181, 600))])
    sessions = K.idle_sessions(_stream(spark, src, maxFilesPerTrigger="1"), "60 seconds", ["topic"], delay="0 seconds")

    def run():
        query = (
            sessions.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", cp).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return query

    run()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("session_start").collect()
    # A gap equal to the limit goes on; one second more ends the session.
    assert [r.messages for r in got] == [3, 1]
    _feed(spark, src, [at(5, 90), at(700, 91)])
    assert K.late_rows(run()) == 1


def test_decode_signals_and_filters_on_a_stream(spark, tmp_path):
    path = str(tmp_path / "log")
    log = _log(spark, True).withColumn("timestamp", F.timestamp_seconds(F.col("offset")))
    log.select("topic", "partition", "offset", "timestamp", "key", "value").write.parquet(path)
    stream = L.read_log(spark, path, stream=True)
    assert stream.isStreaming
    lines = []
    change = D.decode_json(stream, PERSON, True, ["BusinessEntityID"])
    K.console_summary(
        change, lambda df, _: lines.extend(r.summary for r in df.orderBy("offset").collect()), str(tmp_path / "cp"), table="Person"
    ).awaitTermination()
    batch = D.render_summary(D.decode_json(_log(spark, True), PERSON), "Person")
    assert lines == [r.summary for r in batch.orderBy("offset").collect()]
    out = str(tmp_path / "out")
    flat = X.filter_ops(D.unwrap(change, keep=["op", "offset"]), ["r", "u"])
    K.consume_once(flat, out, str(tmp_path / "cp2"))
    assert spark.read.parquet(out).count() == 4
    assert I.parse_signals(stream, "aw").isStreaming
    with pytest.raises(ValueError):
        L.from_position(stream, "latest")


def test_sink_upsert(spark, tmp_path):
    src, target, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    _feed(spark, src, _events())
    flat = _stream(spark, src).select("pk", "lsn", "v", F.when(F.col("op") == "d", "true").otherwise("false").alias("__deleted"))
    TB.sink_upsert(flat, target, ["pk"], ["lsn"], cp).awaitTermination()
    want = S.materialize(spark.createDataFrame(_events(), SCHEMA), ["pk"], ["lsn"]).select("pk", "lsn", "v")
    assert rows(TB.read_upserted(spark, target, ["pk"], ["lsn"])) == rows(want)


def test_lag_series(spark):
    end = spark.createDataFrame([("t", T0, 0, 10), ("t", T0, 1, 5)], "topic string, ts timestamp, partition int, end_offset long")
    committed = spark.createDataFrame([("t", T0, 0, 4)], "topic string, ts timestamp, partition int, committed long")
    assert K.lag_series(end, committed).first().lag == 11


@pytest.mark.parametrize("per_file,order", [(40, "log"), (40, "shuffled"), (90, "backwards"), (1000, "log")])
def test_backfill_stream_equals_batch(spark, tmp_path, per_file, order):
    """Any order of arrival, over several batches, gives what one batch gives."""
    import random

    rng = random.Random(4)
    size, length = 10, 40
    source = spark.range(0, 60).select(F.col("id").alias("pk"), (F.col("id") * 10).alias("v"))
    changes = [(lsn, 33 if rng.random() < 0.34 else rng.randrange(60), rng.randrange(1000)) for lsn in range(0, 240)]
    log = [("live", pk // size, pk, lsn, "u", v, lsn * 4 + 1) for lsn, pk, v in changes]
    for chunk in range(6):
        opened, closed = chunk * length, chunk * length + length - 1
        log.append(("open", chunk, None, opened, None, None, opened * 4))
        log.append(("close", chunk, None, closed, None, None, closed * 4 + 2))
        log += [("read", chunk, k, opened + 5, "r", k * 10, (opened + 5) * 4) for k in range(chunk * size, chunk * size + size)]
    log.sort(key=lambda r: r[-1], reverse=order == "backwards")
    if order == "shuffled":
        rng.shuffle(log)
    schema = "kind string, chunk_id long, pk long, lsn long, op string, v long"
    src, staging, target, cp = (str(tmp_path / n) for n in ("in", "staging", "out", "cp"))
    for i in range(0, len(log), per_file):
        part = spark.createDataFrame([r[:-1] for r in log[i : i + per_file]], schema)
        part.coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "2").parquet(src)
    K.backfill_stream(stream, staging, target, ["pk"], cp).awaitTermination()
    got = K.backfilled(spark, target).select("pk", "lsn", "op", "v")
    live = spark.createDataFrame([(pk, lsn, "u", v) for lsn, pk, v in changes], "pk long, lsn long, op string, v long")
    windows = I.sequential_windows(I.plan_chunks(source, "pk", size), length)
    reads = I.incremental_snapshot(source, live, "pk", size, windows).drop("chunk_id")
    want = I.interleave(reads, live).select("pk", "lsn", "op", "v")
    assert rows(got) == rows(want)


def test_late_rows_of_a_closed_chunk(spark, tmp_path):
    """Open, read and close come first; another read and an older change of the first key follow."""
    schema = "kind string, chunk_id long, pk long, lsn long, op string, v long"
    staging, target = str(tmp_path / "staging"), str(tmp_path / "out")

    def settle(number, *events):
        K.backfill.settle_batch(spark.createDataFrame(events, schema), number, staging, target, ["pk"])

    settle(0, ("open", 0, None, 0, None, None), ("read", 0, 1, 5, "r", 10), ("close", 0, None, 39, None, None))
    assert rows(K.backfilled(spark, target).select("pk", "lsn", "op")) == [(1, 39, "r")]
    late = [("read", 0, 2, 5, "r", 20), ("live", 0, 1, 20, "u", 11)]
    settle(1, *late)
    settle(1, *late)
    want = [(1, 20, "u"), (2, 39, "r")]
    assert rows(K.backfilled(spark, target).select("pk", "lsn", "op")) == want
    settle(2, ("open", 1, None, 40, None, None), ("read", 1, 7, 44, "r", 70))
    assert K.trim_staging(spark, staging) == 2
    assert K.trim_staging(spark, staging) == 2
    kept = spark.read.parquet(f"{staging}/batch_id=-4")
    assert {r.chunk_id for r in kept.collect()} == {1}
    settle(3, ("close", 1, None, 79, None, None))
    assert rows(K.backfilled(spark, target).select("pk", "lsn", "op")) == [*want, (7, 79, "r")]


def test_unknown_and_broken_events_do_not_hide_rows(spark, tmp_path):
    """A stream and a batch agree: such events say nothing about a row; a tombstone does."""
    events = [(1, 1, "c", 10, False), (1, 2, "x", 99, False), (1, 3, None, None, False), (2, 1, "c", 20, False), (2, 2, None, None, True)]
    schema = "pk int, lsn long, op string, v int, is_tombstone boolean"
    frame = spark.createDataFrame(events, schema)
    assert rows(S.materialize(frame, ["pk"], ["lsn"]).select("pk", "v")) == [(1, 10)]
    assert rows(S.materialize(frame.drop("is_tombstone"), ["pk"], ["lsn"]).select("pk", "v")) == [(1, 10), (2, 20)]
    for number in (0, 1):
        TB.upsert_batch(frame.where(F.col("lsn") % 2 == number), number, str(tmp_path / "t"), ["pk"], ["lsn"])
    assert rows(K.live_rows(spark, str(tmp_path / "t"), ["pk"], ["lsn"]).select("pk", "v")) == [(1, 10)]


def test_progress_lag():
    class Source:
        latestOffset = '{"t":{"0":10,"1":4}}'
        endOffset = '{"t":{"0":7}}'

    class Query:
        lastProgress = type("P", (), {"sources": [Source()]})()

    assert K.progress_lag(Query()) == [("t", 0, 3), ("t", 1, 4)]


def test_staging_folders_do_not_grow_with_the_chunks(spark, tmp_path):
    schema = "kind string, chunk_id long, pk long, lsn long, op string, v long"
    staging, target = str(tmp_path / "staging"), str(tmp_path / "out")
    chunks = [n * 64 for n in range(100)]
    events = [e for c in chunks for e in (("open", c, None, c * 10, None, None), ("read", c, c, c * 10, "r", 1), ("read", c, c + 1, c * 10, "r", 1))]
    events += [("live", c, c, c * 10 + c % 128 // 64 * 50, "u", 2) for c in chunks]
    events += [("close", c, None, c * 10 + 9, None, None) for c in chunks]
    K.backfill.settle_batch(spark.createDataFrame(events, schema).coalesce(1), 0, staging, target, ["pk"])
    assert len([f for f in (tmp_path / "staging" / "batch_id=0").iterdir() if f.name.startswith("bucket=")]) <= K.backfill.BUCKETS
    # Every second change lies behind its window and leaves the read as it is.
    want = [(c, c * 10 + 9, "r") for c in chunks if c % 128] + [(c + 1, c * 10 + 9, "r") for c in chunks]
    want += [(c, c * 10 + c % 128 // 64 * 50, "u") for c in chunks]
    assert sorted(map(tuple, K.backfilled(spark, target).select("pk", "lsn", "op").collect())) == sorted(want)

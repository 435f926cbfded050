import json
import random

import pytest
from pyspark.sql import functions as F

from changeloom.operators import audit as U
from changeloom.operators import joins as J
from changeloom.operators import state as S
from changeloom.operators.blocks import long_block
from changeloom.plans import incremental as I
from changeloom.plans import snapshot as P

from .conftest import rows


@pytest.fixture(scope="module")
def source(spark):
    return spark.range(0, 500).select((F.col("id") * 3).alias("id"), (F.col("id") % 17).alias("v")).cache()


def test_table_snapshot(source):
    snap = P.table_snapshot(source, "t", "00:01", ["id"])
    row = snap.orderBy("pk.id").first()
    assert (row.op, row.table, row.lsn, row.before, row.after.id, row.pk.id) == ("r", "t", "00:01", None, 0, 0)


def test_partitioned_snapshot_covers_each_key_once(source):
    got = P.partitioned_snapshot(source, "id", [(None, 300), (300, 900), (900, None)], "t", 0)
    assert rows(got.select("after.id")) == rows(source.select("id"))
    assert {(r.part, r.after.id < 300, r.after.id >= 900) for r in got.collect()} == {
        (0, True, False), (1, False, False), (2, False, True)
    }


@pytest.mark.parametrize(
    "bounds", [[], [(0, 5), (5, None)], [(None, 5), (6, None)], [(None, 5), (4, None)], [(None, 5), (5, 9)]]
)
def test_bad_bounds(bounds):
    with pytest.raises(ValueError):
        P.check_bounds(bounds)


def test_modes(spark):
    snap = spark.createDataFrame([(1, 0, "r"), (2, 0, "r")], "pk int, lsn long, op string")
    live = spark.createDataFrame([(1, 1, "u"), (1, 5, "u"), (3, 9, "c")], "pk int, lsn long, op string")

    def run(mode):
        return [r.lsn for r in P.snapshot_then_stream(snap, live, mode, 1, current=5).orderBy("lsn").collect()]

    assert run("initial") == [0, 0, 5, 9]
    assert run("initial_only") == [0, 0]
    assert run("schema_only") == run("no_data") == [5, 9]
    assert run("never") == [9]
    with pytest.raises(ValueError):
        run("other")


def test_snapshot_and_changes_give_the_table(spark):
    snap = spark.createDataFrame([(k, 0, "r", k) for k in range(5)], "pk int, lsn long, op string, v int")
    live = spark.createDataFrame(
        [(0, 1, "u", 50), (1, 2, "d", None), (9, 3, "c", 90)], "pk int, lsn long, op string, v int"
    )
    log = P.snapshot_then_stream(snap, live, "initial", 0)
    got = {r.pk: r.v for r in S.materialize(log, ["pk"], ["lsn"]).collect()}
    assert got == {0: 50, 2: 2, 3: 3, 4: 4, 9: 90}


def test_filtered_snapshot(spark):
    tables = {
        "header": spark.createDataFrame([(1, 2000), (2, 2020)], "h int, year int"),
        "detail": spark.createDataFrame([(1, 1), (2, 2), (2, 3)], "h int, d int"),
        "free": spark.createDataFrame([(1,), (2,)], "x int"),
    }
    overrides = {
        "header": lambda df: df.where("year > 2010"),
        "detail": lambda df: J.detail_for_recent_headers(df, tables["header"], "h", "h", F.col("year") > 2010),
    }
    got = P.filtered_snapshot(tables, overrides, 0)
    assert {n: s.count() for n, s in got.items()} == {"header": 1, "detail": 2, "free": 2}
    with pytest.raises(ValueError):
        P.filtered_snapshot(tables, {"missing": lambda df: df}, 0)


def test_joins(spark):
    parent = spark.createDataFrame([(i, f"n{i}") for i in range(1, 8)], "id int, name string")
    child = spark.createDataFrame([(2, True), (2, True), (2, False), (3, False), (6, True)], "pid int, recent boolean")
    got = J.parents_with_recent_children(parent, child, "id", "pid", F.col("recent"))
    assert rows(got) == [(2, "n2"), (6, "n6")]
    free = J.deletable_keys(parent, child, "id", "pid", 3).collect()
    assert [r.id for r in free] == [7, 5, 4]
    assert rows(J.rows_in_subquery(parent, "id", child.select("pid")).select("id")) == [(2,), (3,), (6,)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(0, 3000, 1, 12).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"), "id")
    right = spark.createDataFrame([(i, i * 10) for i in range(0, 40, 2)] + [(1, 5), (2, 6)], "k long, w int")
    assert rows(J.salted_join(left, right, ["k"], how, 5)) == rows(left.join(right, "k", how))
    assert rows(J.hot_key_join(left, right, ["k"], how, 5)) == rows(left.join(right, "k", how))
    narrow = left.withColumn("k", F.col("k").cast("int"))
    far = right.unionByName(spark.createDataFrame([(2**40, 1)], "k long, w int"))
    assert rows(J.hot_key_join(narrow, far, ["k"], how, 5)) == rows(narrow.join(far, "k", how))
    for join in (J.salted_join, J.hot_key_join):
        with pytest.raises(ValueError):
            join(left, right, ["k"], "full")


def test_hot_keys_are_found(spark):
    df = spark.range(0, 9000, 1, 6).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    found = spark.range(1).select(J.hot_keys(df, ["k"]).alias("h")).first().h
    assert found == [spark.range(1).select(F.xxhash64(F.lit(-1).cast("long"))).first()[0]]
    none = spark.range(1).select(J.hot_keys(df.where("k >= 0"), ["k"]).alias("h")).first().h
    assert none == []


def copied_rows(monkeypatch, left, right, **more):
    """Rows of both sides as they meet in a hot-key join."""
    sides, plain = [], type(left).join

    def counted(a, b, *args, **kwargs):
        sides.extend([a, b])
        return plain(a, b, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(type(left), "join", counted)
        got = rows(J.hot_key_join(left, right, ["k"], "inner", **more))
    assert got == rows(left.join(right, "k"))
    return sides


def test_copies_for_hot_keys_follow_their_rows(spark, monkeypatch):
    """In a small table every key has a large share of the rows; a hot key of a large one is cut by its share."""
    few = spark.range(0, 50, 1, 4).select(F.col("id").alias("k"))
    _, right = copied_rows(monkeypatch, few, few.withColumn("w", F.col("k") + 1))
    assert right.count() == 50
    many = spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") % 300).alias("k"))
    left, right = copied_rows(monkeypatch, many, many.distinct().withColumn("w", F.col("k") + 1))
    assert left.where("k = -1").select("__salt").distinct().count() == 8
    assert right.count() <= 151 + 20_000 // J.PIECE_ROWS + 300
    _, right = copied_rows(monkeypatch, many, many.distinct().withColumn("w", F.col("k") + 1), piece_rows=5_000)
    assert right.count() <= 151 + 4


@pytest.mark.parametrize("mode,block", [("key_range", []), ("rows", [long_block]), ("rows", [])])
def test_chunks_cover_the_table(source, mode, block):
    blocks = [b("id", 5) for b in block]
    chunks = I.plan_chunks(source, "id", 64, mode, blocks).orderBy("chunk_id").collect()
    assert sum(c.rows for c in chunks) == 500
    assert {c.end_key for c in chunks} == {1497}
    for a, b in zip(chunks, chunks[1:]):
        assert a.last_key < b.first_key
    if mode == "rows":
        assert [c.rows for c in chunks[:-1]] == [64] * (len(chunks) - 1)
    reads = None
    for c in chunks[:3]:
        part = I.read_chunk(source, "id", c.first_key, c.last_key)
        assert part.count() == c.rows
        reads = part if reads is None else reads.unionByName(part)
    assert reads.select("id").distinct().count() == sum(c.rows for c in chunks[:3])
    assert [r.id for r in I.read_chunk(source, "id", 0, 30, "v > 2").collect()] == [9, 12, 15, 18, 21, 24, 27, 30]


def test_composite_key_chunks(spark):
    keys = sorted((i * 7 % 40, i) for i in range(230))
    df = spark.createDataFrame(keys, "a long, b long")
    for block in ([], ["a"]):
        chunks = I.plan_chunks(df, ["a", "b"], 50, "rows", block).orderBy("chunk_id").collect()
        assert [c.rows for c in chunks] == [50, 50, 50, 50, 30]
        assert [tuple(c.first_key) for c in chunks] == [keys[i] for i in range(0, 230, 50)]
        assert tuple(chunks[0].end_key) == keys[-1]
    reads = I.with_chunks(df, ["a", "b"], 50, "rows", ["a"])
    windows = I.sequential_windows(spark.range(5).toDF("chunk_id"), 10)
    live = spark.createDataFrame([(*keys[0], 3), (*keys[60], 3), (*keys[60], 19)], "a long, b long, lsn long")
    kept = rows(I.discard_stale_reads(reads, live, windows, ["a", "b"]).select("a", "b"))
    assert len(kept) == 228 and keys[0] not in kept and keys[60] not in kept
    with pytest.raises(ValueError):
        I.with_chunks(df, ["a", "b"], 50)


def test_chunk_numbers_of_very_large_keys(spark):
    df = spark.createDataFrame([(k,) for k in (2**60, 2**60 + 1023, 2**60 + 1024, 2**60 + 10**16 + 1)], "id long")
    got = {r.first_key: r.rows for r in I.plan_chunks(df, "id", 1024).collect()}
    assert got == {2**60: 2, 2**60 + 1024: 1, 2**60 + 10**16 + 1: 1}


def _live(spark, seed=2):
    rng = random.Random(seed)
    data = []
    for lsn in range(0, 2000):
        key = 300 if rng.random() < 0.34 else rng.randrange(520) * 3
        data.append((key, lsn, rng.choice(["u", "u", "u", "d"]), rng.randrange(1000)))
    return spark.createDataFrame(data, "id long, lsn long, op string, v long"), data


def test_incremental_snapshot(spark, source):
    live, events = _live(spark)
    size, length = 100, 120
    windows = I.sequential_windows(I.plan_chunks(source, "id", size), length)
    reads = I.incremental_snapshot(source, live, "id", size, windows)
    by_key = {}
    for key, lsn, _, _ in events:
        by_key.setdefault(key, []).append(lsn)
    want = []
    for key in range(0, 1500, 3):
        chunk = key // size
        opened, closed = chunk * length, chunk * length + length - 1
        if not any(opened <= p <= closed for p in by_key.get(key, [])):
            want.append((key, chunk, closed))
    assert rows(reads.select("id", "chunk_id", "lsn")) == rows(spark.createDataFrame(want, "a long, b long, c long"))
    generic = I.discard_stale_reads(I.with_chunks(source, "id", size), live, windows, ["id"])
    assert rows(generic.select("id")) == rows(reads.select("id"))
    log = I.interleave(reads.drop("chunk_id"), live)
    state = rows(S.materialize(log, ["id"], ["lsn"]))
    assert rows(S.materialize(I.interleave(live, reads.drop("chunk_id")), ["id"], ["lsn"]).select("id", "v", "op", "lsn")) == rows(
        spark.createDataFrame(state, log.schema).select("id", "v", "op", "lsn")
    )


@pytest.mark.parametrize("size", [10, 10_000])
def test_chunks_without_a_window(spark, size):
    """Their reads stay, before every change, or the run fails if that is asked for; the chunk size changes nothing."""
    source = spark.createDataFrame([(k, k) for k in range(20)], "id long, v long")
    windows = spark.createDataFrame([(0, 10, 20)], "chunk_id long, open_pos long, close_pos long")
    live = spark.createDataFrame([(3, 15), (17, 15)], "id long, lsn long")
    got = {r.id: r.lsn for r in I.incremental_snapshot(source, live, "id", size, windows).collect()}
    inside = range(10) if size == 10 else range(20)
    want = {k: 20 if k in inside else I.BEFORE_ALL for k in range(20) if k != 3 and not (k == 17 and size > 10)}
    assert got == want
    none = windows.where("chunk_id > 0")
    assert I.incremental_snapshot(source, live, "id", size, none).count() == 20
    with pytest.raises(Exception, match="no window for chunk"):
        I.incremental_snapshot(source, live, "id", size, none, missing="raise").collect()
    with pytest.raises(ValueError):
        I.incremental_snapshot(source, live, "id", size, windows, missing="drop")


def test_composite_and_text_keys_in_a_backfill(spark):
    rng = random.Random(6)
    keys = sorted((f"k{i * 7 % 40:02d}", i) for i in range(230))
    df = spark.createDataFrame([(*k, n) for n, k in enumerate(keys)], "a string, b long, v long")
    live = [(*(keys[100] if rng.random() < 0.4 else rng.choice(keys)), lsn) for lsn in range(300)]
    windows = I.sequential_windows(spark.range(5).toDF("chunk_id"), 60)
    frame = spark.createDataFrame(live, "a string, b long, lsn long")
    got = I.incremental_snapshot(df, frame, ["a", "b"], 50, windows, mode="rows", block=["a"])
    want = []
    for n, k in enumerate(keys):
        opened = n // 50 * 60
        if not any((a, b) == k and opened <= lsn < opened + 60 for a, b, lsn in live):
            want.append((*k, n, n // 50, opened + 59))
    assert rows(got.select("a", "b", "v", "chunk_id", "lsn")) == rows(spark.createDataFrame(want, "a string, b long, v long, c long, l long"))


def test_window_edges_are_inside(spark):
    source = spark.createDataFrame([(k, k) for k in range(4)], "id long, v long")
    windows = spark.createDataFrame([(0, 10, 20)], "chunk_id long, open_pos long, close_pos long")
    live = spark.createDataFrame([(0, 10), (1, 20), (2, 9), (3, 21)], "id long, lsn long")
    got = I.incremental_snapshot(source, live, "id", 100, windows)
    assert rows(got.select("id", "lsn")) == [(2, 20), (3, 20)]


def test_resumed_run_equals_uninterrupted_run(spark, source):
    live, _ = _live(spark)
    chunks = I.plan_chunks(source, "id", 100)
    windows = I.sequential_windows(chunks, 120)
    whole = I.incremental_snapshot(source, live, "id", 100, windows)
    done = chunks.where("chunk_id < 6")
    first = I.incremental_snapshot(source, live, "id", 100, windows, chunks=done)
    rest = I.incremental_snapshot(source, live, "id", 100, windows, chunks=I.resume_chunks(chunks, done))
    assert first.count() > 0 and rest.count() > 0
    assert rows(first.unionByName(rest)) == rows(whole)
    some = I.incremental_snapshot(source, live, "id", 100, windows, condition="v > 5")
    assert rows(some) == rows(whole.where("v > 5"))


def test_stop_is_eventual(spark):
    chunks = spark.createDataFrame(
        [("t", 0, i, i * 10) for i in range(5)] + [("t", 100, i, 100 + i * 10) for i in range(3)] + [("o", 0, 0, 0)],
        "table string, snapshot_pos long, chunk_id long, open_pos long",
    )
    stops = spark.createDataFrame([("t", 25), ("t", 33), ("x", 1)], "table string, stop_pos long")
    got = rows(I.apply_stop(chunks, stops).select("table", "snapshot_pos", "chunk_id"))
    assert got == [("o", 0, 0), ("t", 0, 0), ("t", 0, 1), ("t", 0, 2), ("t", 100, 0), ("t", 100, 1), ("t", 100, 2)]


def _signal(kind, collections, condition=None):
    data = {"data-collections": collections, "type": "incremental"}
    if condition:
        data["additional-condition"] = condition
    return json.dumps({"id": "s", "type": kind, "data": data})


def test_signals(spark):
    log = spark.createDataFrame(
        [
            (0, "aw", _signal("execute-snapshot", ["DB.Production.Product"])),
            (1, "signal-17718", _signal("execute-snapshot", ["DB.Production.Product"])),
            (2, "aw", _signal("execute-snapshot", [" Product", "Person "], "ProductID > 500")),
            (3, "aw", _signal("stop-snapshot", ["Person"])),
            (4, "aw", _signal("log", ["Person"])),
            (5, "aw", "no json"),
            (6, None, _signal("execute-snapshot", ["A"])),
        ],
        "offset long, key string, value string",
    )
    got = I.parse_signals(log, "aw").orderBy("offset", "pos").collect()
    assert [(r.offset, r.collection, r.accepted) for r in got] == [
        (0, "DB.Production.Product", True),
        (1, "DB.Production.Product", False),
        (2, "Product", True),
        (2, "Person", True),
        (3, "Person", True),
        (4, "Person", False),
        (5, None, False),
        (6, "A", False),
    ]
    assert got[2].condition == "ProductID > 500"
    assert got[1].reason == "key does not match the prefix"
    schedule = I.snapshot_schedule(I.parse_signals(log, "aw")).orderBy("run_no").collect()
    assert [(r.run_no, r.collection) for r in schedule] == [(1, "DB.Production.Product"), (2, "Product"), (3, "Person")]


def test_counts_and_differences(spark):
    src = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "table string, id int")
    log = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("c", 1)], "table string, id int")
    dst = spark.createDataFrame([("a", 1), ("a", 2)], "table string, id int")
    counts = U.reconcile_counts(src, log, dst)
    assert rows(counts) == [
        ("a", 2, 3, 2, 1, 0, True), ("b", 1, 0, 0, -1, -1, False), ("c", 0, 1, 0, 1, 0, True)
    ]
    assert {r.table: r.inflation for r in U.log_inflation(counts).collect()} == {"a": 1.5, "b": 0.0, "c": None}
    assert rows(U.row_difference(src, log)) == [("a", 2, -1), ("b", 1, 1), ("c", 1, -1)]


def test_plan_and_reads_share_one_numbering(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), (F.col("id") * 3).alias("b"), F.lit("x").alias("c"))
    live = spark.createDataFrame([(0, 0, 5), (1, 3, 5), (6, 18, 900_000)], "a long, b long, lsn long")
    numbered = I.with_chunks(df, ["a", "b"], 50, "rows")
    windows = I.sequential_windows(I.plan_chunks(numbered, ["a", "b"], 50, "numbered"), 10)
    got = I.incremental_snapshot(numbered, live, ["a", "b"], 50, windows, mode="numbered")
    twice = I.sequential_windows(I.plan_chunks(df, ["a", "b"], 50, "rows"), 10)
    other = I.incremental_snapshot(df, live, ["a", "b"], 50, twice, mode="rows")
    assert got.columns == other.columns == ["a", "b", "c", "chunk_id", "op", "lsn"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, other.collect()))
    # Only the first key's chunk is open at position 5; the last event lies beyond all windows.
    assert got.count() == 999
    # Planning does not read the frame a second time.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "percentile_approx" not in plan

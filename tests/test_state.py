import random

import pytest
from pyspark.sql import functions as F

from changeloom.operators import state as S
from changeloom.operators.blocks import long_block

from .conftest import rows

SCHEMA = "pk int, lsn long, partition int, offset long, op string, before struct<v:int>, after struct<v:int>"


def _history(seed, keys=25, events=400):
    """A valid change history and the table after each position."""
    rng = random.Random(seed)
    live, events_out, states = {}, [], [{}]
    for lsn in range(1, events + 1):
        # One key takes a third of the changes.
        k = 0 if rng.random() < 0.34 else rng.randrange(keys)
        if k not in live:
            op, before, after = "c", None, rng.randrange(100)
        elif rng.random() < 0.3:
            op, before, after = "d", live[k], None
        else:
            op, before, after = "u", live[k], rng.randrange(100)
        if after is None:
            live.pop(k)
        else:
            live[k] = after
        wrap = lambda v: None if v is None else (v,)
        events_out.append((k, lsn, k % 4, lsn, op, wrap(before), wrap(after)))
        states.append(dict(live))
    return events_out, states


@pytest.fixture(scope="module")
def history(spark):
    events, states = _history(3)
    return spark.createDataFrame(events, SCHEMA).cache(), states


def _table(df):
    return {r.pk: r.after.v for r in df.collect()}


def test_materialize_and_state_as_of(history):
    change, states = history
    assert _table(S.materialize(change, ["pk"])) == states[-1]
    for at in (0, 1, 57, 200, 399):
        assert _table(S.state_as_of(change, ["pk"], at)) == states[at]


def test_order_of_arrival_does_not_matter(history):
    change, states = history
    assert _table(S.materialize(change.orderBy(F.rand(5)), ["pk"])) == states[-1]


@pytest.mark.parametrize("lo,hi", [(1, 400), (50, 60), (100, 333), (400, 400)])
def test_net_changes_lead_from_one_state_to_the_other(history, lo, hi):
    change, states = history
    state = dict(states[lo - 1])
    for r in S.net_changes(change, ["pk"], lo, hi).collect():
        if r.op == "d":
            assert r.before is not None and r.after is None
            state.pop(r.pk)
        else:
            assert (r.op == "c") == (r.pk not in state) or r.op == "u"
            state[r.pk] = r.after.v
    assert state == states[hi]


RULES = [
    ("cd", None), ("rd", None), ("c", "c"), ("cu", "c"), ("ru", "c"), ("r", "c"),
    ("u", "u"), ("uu", "u"), ("udc", "u"), ("udr", "u"), ("ud", "d"), ("d", "d"),
    ("dd", "d"), ("dc", "u"), ("dr", "u"), ("du", "u"),
]


@pytest.mark.parametrize("ops,net", RULES)
def test_net_change_rules(spark, ops, net):
    events = [
        (1, i, 0, i, op, None if op in "cr" else (i,), None if op == "d" else (i + 10,))
        for i, op in enumerate(ops)
    ]
    got = S.net_changes(spark.createDataFrame(events, SCHEMA), ["pk"], 0, 99).collect()
    assert [r.op for r in got] == ([net] if net else [])


def test_all_changes_in_order(history):
    change, _ = history
    got = S.all_changes(change, 10, 20).select("lsn").collect()
    assert [r.lsn for r in got] == list(range(10, 21))


def test_compaction_keeps_state(history):
    change, states = history
    compacted = S.compact_log(change, ["pk"], ["offset"], value="after")
    assert _table(S.materialize(compacted, ["pk"])) == states[-1]
    dropped = S.compact_log(change, ["pk"], ["offset"], drop_tombstoned=True, value="after")
    assert {r.pk for r in dropped.collect()} == set(states[-1])


def test_tombstones(history):
    change, states = history
    doubled = S.with_tombstones(change, emptied=["op", "before", "after"])
    deletes = change.where("op = 'd'").count()
    assert doubled.where("is_tombstone").count() == deletes
    assert doubled.where("is_tombstone AND op IS NULL AND after IS NULL").count() == deletes
    assert S.with_tombstones(change, False).where("is_tombstone").count() == 0
    later = doubled.withColumn("offset", F.col("offset") * 2 + F.col("is_tombstone").cast("int"))
    assert _table(S.materialize(later, ["pk"])) == states[-1]


def test_unknown_operations_are_skipped(spark):
    df = spark.createDataFrame([(1, 1, 0, 1, "c", None, (5,)), (1, 2, 0, 2, "x", None, None)], SCHEMA)
    assert _table(S.materialize(df, ["pk"])) == {1: 5}


def test_dedupe_and_missing_before(history, spark):
    change, states = history
    twice = change.unionByName(change.where("lsn % 3 = 0"))
    assert rows(S.dedupe(twice, ["partition", "offset"]).select("lsn")) == rows(change.select("lsn"))
    assert S.missing_before(change, ["pk"]).count() == 0
    late = change.where("lsn > 200")
    want = {
        r.pk for r in late.groupBy("pk").agg(F.min_by("op", "lsn").alias("o")).collect() if r.o == "u"
    }
    assert {r.pk for r in S.missing_before(late, ["pk"]).collect()} == want


@pytest.mark.parametrize("bits", [2, 4, 20])
def test_retain_keeps_newest_bytes(spark, bits):
    log = spark.range(0, 300).select(
        F.lit("t").alias("topic"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(1).alias("partition"),
        F.col("id").alias("offset"),
        F.col("id").cast("timestamp").alias("timestamp"),
        F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("value"),
    )
    got = S.retain(log, F.lit(40).cast("timestamp"), 200, F.octet_length("value"), bits=bits)
    want = []
    for p in (0, 1):
        total = 0
        for i in reversed([i for i in range(40, 300) if (0 if i % 3 == 0 else 1) == p]):
            total += i % 7
            if total > 200:
                break
            want.append(i)
    assert sorted(r.offset for r in got.collect()) == sorted(want)


def test_assign_partition_is_stable_per_key(spark):
    df = spark.createDataFrame([(i % 10, str(i % 10)) for i in range(100)], "a int, b string")
    placed = S.assign_partition(df, ["a", "b"], 4)
    per_key = placed.groupBy("a", "b").agg(F.countDistinct("partition").alias("n")).collect()
    assert all(r.n == 1 for r in per_key)
    assert {r.partition for r in placed.collect()} <= {0, 1, 2, 3}


def test_surrogate_key_is_gapless(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("v"))
    got = S.surrogate_key(df, ["v"], [long_block("v", 4)]).orderBy("row_key").collect()
    assert [(r.v, r.row_key) for r in got] == [(i, i + 1) for i in range(1000)]

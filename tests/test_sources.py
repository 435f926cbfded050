import json

import pytest
from pyspark.sql import functions as F

from changeloom.operators import decode as D
from changeloom.operators.blocks import long_block
from changeloom.session import scratch_path, scratch_root
from changeloom.sources import log as L
from changeloom.sources import runs as R
from changeloom.sources import tables as TB

from .conftest import rows


@pytest.fixture(scope="module")
def published(spark):
    change = spark.range(0, 400).select(
        F.concat(F.lit("aw.DB.S.T"), (F.col("id") % 2).cast("string")).alias("topic"),
        F.timestamp_seconds("id").alias("timestamp"),
        (F.col("id") % 7).alias("pk"),
        "id",
        F.when(F.col("id") % 10 == 0, "d").otherwise("u").alias("op"),
        (F.col("id") % 10 == 0).alias("is_tombstone"),
    )
    record = L.to_record(change, ["pk"], ["id", "op"])
    return L.publish(record, ["pk"], 3, ["id"], [long_block("id", 4)]).cache()


def test_publish_gives_gapless_offsets_in_order(published):
    seen = {}
    for r in published.orderBy("timestamp").collect():
        n = seen.setdefault((r.topic, r.partition), 0)
        assert r.offset == n
        seen[(r.topic, r.partition)] += 1
    per_key = published.groupBy("topic", "key").agg(F.countDistinct("partition").alias("n")).collect()
    assert {r.n for r in per_key} == {1}
    assert published.where("value IS NULL").count() == 40


def test_write_read_select_position(spark, published, tmp_path):
    path = str(tmp_path / "log")
    L.write_log(published, path)
    log = L.read_log(spark, path)
    assert [f.dataType.simpleString() for f in log.schema][-2:] == ["binary", "binary"]
    text = {"key": F.col("key").cast("string"), "value": F.col("value").cast("string")}
    assert rows(log.withColumns(text)) == rows(published)
    one = L.read_log(spark, path, topics=["aw.DB.S.T1"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan or "PartitionFilters: [topic" in plan
    assert rows(one) == rows(L.select_topics(log, ["T1"], {"T1": "aw.DB.S.T1", "T0": "aw.DB.S.T0"}))
    with pytest.raises(ValueError):
        L.select_topics(log, ["X"], {})
    start = {"aw.DB.S.T0": {"0": 10, "1": 0}}
    got = L.read_log(spark, path, position=start)
    assert got.where("partition = 0").agg(F.min("offset")).first()[0] in (10, None)
    # A partition that is not named is read from its start, a topic that is not named not at all.
    assert got.where("partition = 2").count() == log.where("partition = 2 AND topic = 'aw.DB.S.T0'").count() > 0
    assert got.where("topic = 'aw.DB.S.T1'").count() == 0
    assert L.from_position(log, "latest").count() == 0
    taken = L.take_messages(log, 25)
    assert taken.count() == 25 and taken.where("value IS NULL").count() == 0
    assert taken.agg(F.max("timestamp")).first()[0].second == 27


def test_log_batches_replace_themselves_and_keep_bytes(spark, tmp_path):
    path = str(tmp_path / "log")
    framed = spark.range(0, 6).select(
        F.concat(F.lit("t"), (F.col("id") % 2).cast("string")).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.timestamp_seconds("id").alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        F.unhex(F.concat(F.lit("00000000C8"), F.lpad(F.hex("id"), 4, "F"))).alias("value"),
    )
    for _ in range(2):
        L.write_log(framed, path, batch="b0")
    L.write_log(framed.withColumn("offset", F.col("offset") + 6), path, batch="b1")
    log = L.read_log(spark, path)
    assert log.count() == 12
    split = D.split_wire_header(log)
    assert {(r.magic_ok, r.schema_id, r.body_size) for r in split.collect()} == {(True, 200, 2)}


def test_upsert_is_idempotent(spark, tmp_path):
    target = str(tmp_path / "table")
    schema = "pk int, lsn long, v string, __deleted string"
    first = spark.createDataFrame([(1, 1, "a", "false"), (2, 2, "b", "false"), (1, 3, "c", "false")], schema)
    second = spark.createDataFrame([(2, 4, "b", "true"), (3, 5, "d", "false")], schema)
    for batch, n in ((first, 0), (second, 1), (second, 1), (first, 0)):
        TB.upsert_batch(batch, n, target, ["pk"], ["lsn"])
    want = [(1, 3, "c"), (3, 5, "d")]
    assert rows(TB.read_upserted(spark, target, ["pk"], ["lsn"])) == want
    assert TB.compact_target(spark, target, ["pk"], ["lsn"]) == 1
    assert rows(TB.read_upserted(spark, target, ["pk"], ["lsn"])) == want
    # Later batches come on top of the base; compacting again merges both.
    TB.upsert_batch(spark.createDataFrame([(1, 9, "z", "true"), (4, 8, "e", "false")], schema), 2, target, ["pk"], ["lsn"])
    want = [(3, 5, "d"), (4, 8, "e")]
    assert rows(TB.read_upserted(spark, target, ["pk"], ["lsn"])) == want
    assert TB.compact_target(spark, target, ["pk"], ["lsn"]) == 2
    assert TB.compact_target(spark, target, ["pk"], ["lsn"]) == 2
    assert rows(TB.read_upserted(spark, target, ["pk"], ["lsn"])) == want
    assert spark.read.parquet(f"{TB.base_folder(target)}/upto=2").count() == 4


def test_targets_lose_nothing_around_a_compaction(spark, tmp_path):
    """Merged folders may go, half a batch is neither read nor merged, its retry counts, and a reader keeps the parts it began with."""
    import shutil

    from changeloom.streaming import live_rows

    target, schema = str(tmp_path / "t"), "pk int, lsn int, op string"

    def batch(*keys, lsn=1):
        return spark.createDataFrame([(k, lsn, "c") for k in keys], schema)

    def keys(df):
        return sorted(r["pk"] for r in df.collect())

    with pytest.raises(ValueError):
        live_rows(spark, target, ["pk"], ["lsn"])
    TB.upsert_batch(batch(1, 2, 3), 0, target, ["pk"], ["lsn"])
    reader = TB.delivered(spark, target)
    # A batch of which one file is there when its writer is lost.
    batch(5).write.parquet(f"{target}/batch_id=1/attempt=lost")
    assert keys(live_rows(spark, target, ["pk"], ["lsn"])) == [1, 2, 3]
    assert TB.compact_target(spark, target, ["pk"], ["lsn"]) == 0
    assert TB.compact_target(spark, target, ["pk"], ["lsn"]) == 0
    TB.upsert_batch(batch(5, 6), 1, target, ["pk"], ["lsn"])
    TB.upsert_batch(batch(5, 6), 1, target, ["pk"], ["lsn"])
    assert keys(reader) == [1, 2, 3]
    shutil.rmtree(f"{target}/batch_id=0")
    batch(9).write.parquet(f"{TB.base_folder(target)}/upto=7")
    assert keys(live_rows(spark, target, ["pk"], ["lsn"])) == keys(TB.read_upserted(spark, target, ["pk"], ["lsn"])) == [1, 2, 3, 5, 6]
    TB.upsert_batch(batch(2, lsn=4).withColumn("op", F.lit("d")), 2, target, ["pk"], ["lsn"])
    assert TB.compact_target(spark, target, ["pk"], ["lsn"]) == 2
    assert keys(live_rows(spark, target, ["pk"], ["lsn"])) == [1, 3, 5, 6]


def test_range_predicates_are_sql_and_cover_nulls():
    import datetime as dt
    from decimal import Decimal

    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE t (d DATE, s VARCHAR, n DECIMAL(9,2), ts TIMESTAMP)")
    for day in range(1, 21):
        con.execute("INSERT INTO t VALUES (?, ?, ?, ?)", [dt.date(2024, 1, day), f"o'k{day:02d}", Decimal(day) / 2, dt.datetime(2024, 1, day, 5)])
    con.execute("INSERT INTO t VALUES (NULL, NULL, NULL, NULL)")
    middles = {"d": dt.date(2024, 1, 9), "s": "o'k09", "n": Decimal("4.5"), "ts": dt.datetime(2024, 1, 9, 5)}
    for key, middle in middles.items():
        found = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in TB.range_predicates(key, [(None, middle), (middle, None)])]
        assert found == [9, 12], (key, found)
    assert TB.range_predicates("k", [(None, None)]) == ["1 = 1"]
    with pytest.raises(TypeError):
        TB.sql_literal(object())


def _document(label, error=None):
    run = {"connector": label, "short_label": label, "messages_consumed": 10, "total_time_sec": 2.0}
    if error:
        return {"connector": label, "error": error}
    run["timeseries"] = {n: [1.0, 2.0] for n in R.SERIES_FIELDS}
    run["connect_metrics"] = [{"elapsed": 1.0, "connector_state": "RUNNING", "tasks_running": 1, "consumer_lag": -1}]
    run["system"] = {"kafka": [{"elapsed": 1.0, "cpu_pct": 5.0}, {"elapsed": 2.0, "cpu_pct": 6.0}], "db": []}
    return run


def test_load_runs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, document in {
        "one.json": {"results": [_document("c1"), _document("c2", "timed out")]},
        "two.json": {"results": [_document("c3")]},
    }.items():
        (tmp_path / "in" / name).write_text(json.dumps(document, indent=2))
    assert R.read_results(spark, str(tmp_path / "in")).count() == 3
    runs = R.load_runs(spark, str(tmp_path / "in"))
    assert {r.connector for r in runs.collect()} == {"c1", "c3"}
    assert R.run_samples(runs).count() == 4
    assert R.run_samples(runs).columns == ["run", *R.SERIES_FIELDS]
    assert R.connect_samples(runs).where("consumer_lag = -1").count() == 2
    got = R.sys_samples(runs).where("run = 'c1'").select("container", "cpu_pct")
    assert rows(got) == [("kafka", 5.0), ("kafka", 6.0)]


def test_save_runs_and_latest(spark, tmp_path):
    path = str(tmp_path / "out")
    schema = "run string, msg_s double"
    R.save_runs(spark.createDataFrame([("a", 1.0)], schema), path, "20260101_000000")
    R.save_runs(spark.createDataFrame([("a", 2.0), ("b", 3.0)], schema), path, "20260102_000000")
    R.save_runs(spark.createDataFrame([("a", 2.5), ("b", 3.0)], schema), path, "20260102_000000")
    saved = R.saved_runs(spark, path, schema)
    assert saved.count() == 3
    assert rows(R.latest_runs(saved).select("run", "msg_s")) == [("a", 2.5), ("b", 3.0)]


class _Session:
    """Just enough of a session to ask where its scratch folder is."""

    def __init__(self, master, conf=None):
        self.master, self.known = master, conf
        self.conf = self.sparkContext = self

    def get(self, key, default):
        return self.known if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return getattr(self, "made", None)

    def setCheckpointDir(self, path):
        self.made = path


def test_scratch_comes_from_the_session(spark):
    assert scratch_root(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert scratch_path(_Session("yarn", "hdfs:///x"), "q").startswith("hdfs:///x/q-")
    local = _Session("local[2]")
    assert scratch_root(local) == local.made
    with pytest.raises(ValueError):
        scratch_root(_Session("spark://host:7077"))
    assert scratch_root(spark)

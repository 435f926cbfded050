"""Binary records: order, starts and round trip against the library, damage, and reading in any order."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changeloom.llm import records
from changeloom.session import scratch_path

from .test_tokens import texts

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(FILE)


def library_ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.fixture(scope="module")
def written(spark):
    rows = [(i * 7 % 305 - 100, t) for i, t in enumerate(texts())] + [(400, None), (401, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    path = scratch_path(spark, "records-test")
    return rows, path, records.write_sequences(docs, FILE, path, file_bytes=1 << 14)


def test_records_round_trip(spark, written):
    """Starts and ids of every document are those of the library, over several files per part."""
    rows, path, index = written
    held = index.collect()
    assert len({r["file"] for r in held}) > len({r["part"] for r in held})
    found = records.read_sequences(index, path).join(records.part_starts(index), "part").collect()
    start, expected = 0, {}
    for name, text in sorted(rows):
        ids = library_ids(text)
        expected[str(name)] = (start, ids)
        start += len(ids)
    assert {r["id"]: (r["first"] + r["before"], np.frombuffer(r["ids"], "<u4").tolist()) for r in found} == expected


def test_records_shuffled_and_partial(spark, written):
    """A seed changes the order, not the records; any part of the index can be read."""
    rows, path, index = written
    plain, drawn = records.read_sequences(index, path), records.read_sequences(index, path, seed=5)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, drawn.collect()))
    assert [r["id"] for r in drawn.collect()] != [r["id"] for r in plain.collect()]
    assert [r["id"] for r in records.read_sequences(index, path, seed=6).collect()] != [r["id"] for r in drawn.collect()]
    some = index.where(F.col("nth") % 3 == 1)
    assert records.read_sequences(some, path).count() == some.count() > 10


def test_records_file_can_be_walked(written):
    """Without the index, lengths lead from record to record to the end of the file."""
    _, path, index = written
    store, folder = records._place(f"{path}/records")
    row = index.where("nth = 2").first()
    data = store.open_input_file(f"{folder}/{row['file']}").read()
    at, sizes = records.HEADER_SIZE, []
    assert data[:at] == records.header(2)
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little") + 16
        records.unframe(data[at : at + size], 2)
        sizes.append((at, size))
        at += size
    assert at == len(data) and (row["at"], row["size"]) == sizes[2]


def test_records_damage_is_found():
    """A changed bit anywhere in a record raises an error."""
    good = records.frame("12", np.array([5, 70, 9], "<u2"))
    assert records.unframe(good, 2)[0] == "12" and records.unframe(good, 2)[1].tolist() == [5, 70, 9]
    assert records.unframe(records.frame(None, np.array([70_000], "<u4")), 4)[1].tolist() == [70_000]
    for at in range(len(good)):
        bad = bytearray(good)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            records.unframe(bytes(bad), 2)
    with pytest.raises(ValueError):
        records.unframe(good[:-1], 2)
    # The mask: a turn by 15 bits and a fixed addend.
    crc = zlib.crc32(b"abc")
    assert records.masked(b"abc") == (((crc >> 15) + ((crc << 17) & 0xFFFFFFFF)) + 0xA282EAD8) % (1 << 32)


def test_records_edges(spark, messy, messy_rows, no_rows):
    """Nulls first, ties and repeated rows kept, text identifiers allowed, nothing for no rows."""
    found = records.written_and_read(messy, FILE, scratch_path(spark, "records-test")).orderBy("start").collect()
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4"))) for r in found) == Counter((r[0], tuple(library_ids(r[1]))) for r in messy_rows)
    names = [r["doc_id"] for r in found]
    assert names == sorted(names, key=lambda n: (n is not None, n))
    ends = [r["start"] + len(r["ids"]) // 4 for r in found]
    assert [r["start"] for r in found] == [0, *ends[:-1]]
    assert records.written_and_read(no_rows, FILE, scratch_path(spark, "records-test")).collect() == []
    named = spark.createDataFrame([("b é", "two"), ("a", "one"), (None, "none")], "name string, body string")
    found = records.written_and_read(named, FILE, scratch_path(spark, "records-test"), 7, "name", "body").orderBy("start").collect()
    assert [r["name"] for r in found] == [None, "a", "b é"]


def test_records_of_a_hot_identifier_spread(spark):
    """A third of all rows have one identifier and one text: they are in several parts, in order."""
    docs = spark.range(0, 900, 1, 6).select(F.when(F.col("id") % 3 == 0, 51).otherwise(F.col("id")).alias("doc_id"), F.lit("a word").alias("text"))
    path = scratch_path(spark, "records-test")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = records.write_sequences(docs, FILE, path)
        parts = records.read_sequences(index, path).where("id = '51'").groupBy("part").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 1 and sum(r["count"] for r in parts) == 300

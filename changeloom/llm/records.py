"""Token sequences as length-delimited binary records with masked checksums, and a separate index of their offsets.

A file begins with a header: a magic text, the bytes per token id (unsigned 32-bit) and a masked checksum of both.  Records follow:
the payload's length (unsigned 64-bit), the masked checksum of these eight bytes, the payload, and its masked checksum.  A payload
is the length of the identifier's text (unsigned 32-bit, all ones for null), that text in UTF-8, and the token ids.  All numbers are
little-endian.  The index is a Parquet table with one row per record, so records can be read in any order without reading files.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_of
from .packing import text_encoder

MAGIC = b"seqrec01"
# Rotation and addend by which record checksums are masked, so that data holding checksums stays distinct from them.
MASK_TURN = 15
MASK_ADD = 0xA282EAD8
NULL_NAME = 0xFFFFFFFF
# Files end at the first record beyond FILE_BYTES; a task reads about READ_BYTES, in runs of at most RUN_BYTES.
FILE_BYTES = 1 << 28
READ_BYTES = 1 << 26
RUN_BYTES = 1 << 23

_INDEX = pa.schema([("part", pa.int32()), ("file", pa.string()), *[(c, pa.int64()) for c in ("nth", "at", "size", "tokens", "before")]])
INDEX_SHAPE = "part int, file string, nth bigint, at bigint, size bigint, tokens bigint, before bigint"


def masked(data: bytes) -> int:
    """The checksum (CRC-32) of bytes, turned and shifted."""
    crc = zlib.crc32(data)
    return (((crc >> MASK_TURN) | (crc << (32 - MASK_TURN))) + MASK_ADD) & 0xFFFFFFFF


def header(width: int) -> bytes:
    """Begin of a file with ``width`` bytes per token id."""
    begin = MAGIC + struct.pack("<I", width)
    return begin + struct.pack("<I", masked(begin))


HEADER_SIZE = len(header(4))


def frame(name: str | None, ids: np.ndarray) -> bytes:
    """One record."""
    key = None if name is None else name.encode()
    payload = struct.pack("<I", NULL_NAME if key is None else len(key)) + (key or b"") + ids.tobytes()
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def unframe(record: bytes, width: int) -> tuple[str | None, np.ndarray]:
    """Identifier and ids of one record; a damaged one raises an error."""
    if len(record) < 16 or struct.unpack_from("<I", record, 8)[0] != masked(record[:8]):
        raise ValueError("a record's length is damaged")
    (length,) = struct.unpack_from("<Q", record)
    payload = record[12 : 12 + length]
    if len(record) != length + 16 or struct.unpack_from("<I", record, 12 + length)[0] != masked(payload):
        raise ValueError("a record's content is damaged")
    (size,) = struct.unpack_from("<I", payload)
    name = None if size == NULL_NAME else payload[4 : 4 + size].decode()
    return name, np.frombuffer(payload, f"<u{width}", offset=4 + (0 if name is None else size)).astype("<u4")


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class _Writer:
    """Files of one task.  Each attempt has names of its own, and only the index of the attempt that succeeds is kept."""

    def __init__(self, path: str, width: int, file_bytes: int):
        self.store, self.folder = _place(path)
        self.store.create_dir(self.folder, recursive=True)
        self.width, self.file_bytes, self.out, self.before = width, file_bytes, None, 0
        self.part = TaskContext.get().partitionId()
        self.attempt = uuid.uuid4().hex

    def add(self, name: str | None, ids: np.ndarray) -> tuple:
        if self.out is None:
            self.nth, self.at = 0, HEADER_SIZE
            self.file = f"part-{self.part:06d}-{self.attempt}-{self.before:016d}.rec"
            self.out = self.store.open_output_stream(f"{self.folder}/{self.file}")
            self.out.write(header(self.width))
        record = frame(name, ids)
        self.out.write(record)
        row = (self.part, self.file, self.nth, self.at, len(record), len(ids), self.before)
        self.nth += 1
        self.at += len(record)
        self.before += len(ids)
        if self.at >= self.file_bytes:
            self.close()
        return row

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


@lru_cache(maxsize=2)
def id_width(tokenizer_path: str, end_id: int) -> int:
    """Two bytes per id where every id fits, else four."""
    return 2 if max(len(text_encoder(tokenizer_path).ends_line) - 1, end_id) < 1 << 16 else 4


def write_sequences(
    docs: DataFrame,
    tokenizer_path: str,
    path: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Encode each text, append ``end_id``, write records below ``path`` in ascending order of identifiers; return the index.

    Ids are those of the tokenizers library for a byte-level BPE file (see ``packing.TextEncoder``: its vocabulary is in merge
    order, so that ranks give the same merges).  Identifiers may be of any type that sorts and casts to text.  Null identifiers come first;
    rows with one identifier are ordered by a hash of the text, so that a hot identifier spreads over tasks.  A null or empty text gives
    just ``end_id``; repeated rows give a record each; an empty table gives an empty index; other columns are ignored.

    The index has ``part`` (ascending with the identifiers), ``file``, ``nth`` record there, ``at`` and ``size`` in bytes,
    ``tokens`` and ``before``, the tokens earlier in the same part.  A task that is run again writes files under new names; those of
    a lost attempt are in no index.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    keys = [F.asc_nulls_first("id"), F.xxhash64("text"), F.col("row")]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(F.col("id").cast("string").alias("id"), "text")

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, width = text_encoder(tokenizer_path), id_width(tokenizer_path, end_id)
        writer, last = None, np.array([end_id], "<u4")
        try:
            for batch in found:
                writer = writer or _Writer(f"{path}/records", width, file_bytes)
                made = []
                for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = np.concatenate((encoder.encode(text.as_py()), last))
                    made.append(writer.add(name, ids.astype(f"<u{width}")))
                yield pa.RecordBatch.from_pylist([dict(zip(_INDEX.names, row)) for row in made], _INDEX)
        finally:
            if writer:
                writer.close()

    ordered.mapInArrow(batches, INDEX_SHAPE).write.parquet(f"{path}/index")
    return read_index(docs.sparkSession, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index of the records below ``path``."""
    return spark.read.schema(INDEX_SHAPE).parquet(f"{path}/index")


def _runs(rows: list[tuple]) -> Iterator[list[tuple]]:
    """Neighbouring rows whose records follow each other in one file, up to RUN_BYTES at a time."""
    held: list[tuple] = []
    for row in rows:
        follows = held and held[-1][0] == row[0] and held[-1][1] + held[-1][2] == row[1]
        if held and not (follows and row[1] + row[2] - held[0][1] <= RUN_BYTES):
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def read_sequences(index: DataFrame, path: str, seed: int | None = None) -> DataFrame:
    """``id, part, before, ids`` (text, and little-endian unsigned 32-bit ids) of the records that ``index`` lists.

    ``index`` may be any part of the table that ``read_index`` gives.  Without a seed each task reads stretches of files in their
    order; with one, records are dealt out and read in an order drawn from the seed.  Every checksum is verified.
    """
    total = index.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    count = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // READ_BYTES))
    rows = index.select("file", "at", "size", "part", "before")
    if seed is None:
        dealt = rows.repartition(count, "file", F.expr(f"at div {READ_BYTES >> 3}")).sortWithinPartitions("file", "at")
    else:
        draw = F.xxhash64(F.lit(seed), "file", "at")
        dealt = rows.repartition(count, draw).sortWithinPartitions(draw)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _place(f"{path}/records")
        name, source, width = None, None, 0
        try:
            for batch in found:
                for run in _runs(list(zip(*[c.to_pylist() for c in batch.columns]))):
                    if run[0][0] != name:
                        if source:
                            source.close()
                        name = run[0][0]
                        source = store.open_input_file(f"{folder}/{name}")
                        begin = source.read_at(HEADER_SIZE, 0)
                        (width,) = struct.unpack_from("<I", begin, len(MAGIC))
                        if begin != header(width):
                            raise ValueError(f"{name} is no file of records")
                    first = run[0][1]
                    data = source.read_at(run[-1][1] + run[-1][2] - first, first)
                    made = [unframe(data[at - first : at - first + size], width) for _, at, size, _, _ in run]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([m[0] for m in made], pa.string()),
                            pa.array([r[3] for r in run], pa.int32()),
                            pa.array([r[4] for r in run], pa.int64()),
                            pa.array([m[1].tobytes() for m in made], pa.binary()),
                        ],
                        ["id", "part", "before", "ids"],
                    )
        finally:
            if source:
                source.close()

    return dealt.mapInArrow(batches, "id string, part int, before bigint, ids binary")


def part_starts(index: DataFrame) -> DataFrame:
    """``part, first``: the tokens of all earlier parts.  There is one row per part, however many records it has."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = index.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    return totals.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("first"))


def written_and_read(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write records below ``path`` and read them back: identifier, ``start`` (ids of all earlier records) and ``ids``.

    See ``write_sequences`` for nulls, ties, repeated rows and empty tables.
    """
    index = write_sequences(docs, tokenizer_path, path, end_id, id_col, text_col)
    # One row per part, of which there are no more than shuffle partitions: ids need no exchange to meet them.
    found = read_sequences(index, path).join(F.broadcast(part_starts(index)), "part")
    kind = docs.schema[id_col].dataType
    return found.select(F.col("id").cast(kind).alias(id_col), (F.col("first") + F.col("before")).alias("start"), "ids")

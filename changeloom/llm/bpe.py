"""Byte-level BPE encoding and decoding by overlapping chunks.

A long text is cut into chunks that overlap; the chunks are pre-tokenised in parallel.  Neighbouring chunks are
stitched where their pre-token boundaries agree again, the pieces between these places are encoded in parallel, and the
identifiers are put together in order.  Decoding concatenates the bytes of the identifiers.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import hot_key_join
from .common import slices, stored, text_of

CHUNK = 1 << 15
OVERLAP = 1 << 11
# Rows that share one copy of a long text's identifiers.
ROWS_A_COPY = 1_024


@lru_cache(maxsize=4)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks_of(path), special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    ranks = ranks_of(path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def encode_piece(text: str, path: str, pattern: str) -> bytes:
    """Identifiers of a text as little-endian unsigned 32-bit numbers."""
    return np.array(encoder(path, pattern).encode_ordinary(text), "<u4").tobytes()


def stitch_places(text: str, pattern: str, low: int, high: int) -> list[int]:
    """Pre-token boundaries between ``low`` and ``high`` where white space follows other text.

    No pre-token reaches over such a place, whatever stands on either side, so text on the two sides can be encoded apart.
    """
    starts = (m.start() for m in regex.compile(pattern).finditer(text))
    return [p for p in starts if low < p < high and text[p].isspace() and not text[p - 1].isspace()]


def chunked(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``key, text`` to ``key, nth, text`` with chunks of ``chunk + overlap`` characters."""

    def cut(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                for nth, at in enumerate(range(0, len(text), chunk)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key]), pa.array([nth], pa.int32()), pa.array([text[at : at + chunk + overlap]])],
                        ["key", "nth", "text"],
                    )

    return texts.mapInArrow(cut, "key string, nth int, text string")


def stitched(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Chunks to pieces ``key, piece, text`` whose encodings can be concatenated.

    Where two neighbours share no boundary in their overlap they stay one piece.
    """

    def pretokenise(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            texts = batch.column(2).to_pylist()
            head = [stitch_places(t, pattern, 0, overlap) for t in texts]
            tail = [[p - chunk for p in stitch_places(t, pattern, chunk, len(t))] for t in texts]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(head, kind), pa.array(tail, kind)], ["key", "nth", "text", "head", "tail"]
            )

    seen = chunks.repartition("key", "nth").mapInArrow(
        pretokenise, "key string, nth int, text string, head array<int>, tail array<int>"
    )
    in_text = Window.partitionBy("key").orderBy("nth")
    # Where this chunk ends and where it begins, counted from its own start.
    joint = F.array_min(F.array_intersect("tail", F.lead("head").over(in_text)))
    cut = seen.select("key", "nth", "text", joint.alias("joint"))
    cut = cut.withColumn("begin", F.coalesce(F.lag("joint").over(in_text), F.lit(0)))
    cut = cut.withColumn("piece", F.coalesce(F.sum(F.col("joint").isNotNull().cast("int")).over(in_text.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = F.when(F.col("joint").isNull(), F.lit(chunk)).otherwise(F.col("joint") + chunk) - F.col("begin")
    part = F.struct("nth", F.substr("text", F.col("begin") + 1, own).alias("part"))
    parts = F.array_sort(F.collect_list(part))
    return cut.groupBy("key", "piece").agg(F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("text"))


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per input row: identifier and ``ids``, token ids as little-endian unsigned 32-bit numbers.

    Equal to encoding each match of the pattern by itself.  A null or empty text has no ids; repeated rows give
    repeated rows, null identifiers stay null, an empty table gives no rows, other columns are ignored.  Texts of at
    most ``chunk`` characters are one chunk and one piece, so they need no exchange; equal long texts are encoded once.
    """
    if not 0 < overlap < chunk:
        raise ValueError("overlap lies between 0 and chunk")
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def whole(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(found):
            ids = [encode_piece(t.as_py(), ranks_path, pattern) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["id", "ids"])

    def pieces(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(found):
            ids = [encode_piece(t.as_py(), ranks_path, pattern) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(ids, pa.binary())], ["key", "piece", "ids"])

    is_long = F.char_length("text") > chunk
    short = rows.where(~is_long).mapInArrow(whole, f"id {kind}, ids binary")
    long = rows.where(is_long).withColumn("key", F.sha2("text", 256))
    texts = long.groupBy("key").agg(F.first("text").alias("text"))
    coded = stitched(chunked(texts, chunk, overlap), pattern, chunk, overlap)
    coded = coded.repartition("key", "piece").mapInArrow(pieces, "key string, piece bigint, ids binary")
    in_order = F.array_sort(F.collect_list(F.struct("piece", F.hex("ids").alias("ids"))))
    joined = coded.groupBy("key").agg(F.unhex(F.array_join(F.transform(in_order, lambda p: p["ids"]), "")).alias("ids"))
    # One long text may belong to a large share of the rows: its identifiers are copied once per ROWS_A_COPY of them.
    owners = stored(long.select("id", "key", F.spark_partition_id().alias("part")), "bpe-long")
    counts = owners.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / ROWS_A_COPY).alias("copies"))
    dealt = hot_key_join(owners, counts.hint("merge"), ["key"], "inner").withColumn("copy", F.pmod(F.xxhash64("id", "part"), F.col("copies")))
    copied = joined.join(counts.hint("merge"), "key").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    met = dealt.select("id", "key", "copy").join(copied.hint("merge"), ["key", "copy"])
    return short.union(met.select("id", "ids")).withColumnRenamed("id", id_col)


def decode(coded: DataFrame, ranks_path: str) -> DataFrame:
    """Add ``decoded``, the concatenated bytes of ``ids``.  Null ids give null; an unknown id raises an error."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(ranks_path)
        for batch in slices(found):
            made = [
                None if ids is None else b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])
                for ids in batch.column(batch.schema.get_field_index("ids")).to_pylist()
            ]
            yield batch.append_column("decoded", pa.array(made, pa.binary()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema)
    return coded.mapInArrow(batches, f"{fields}, decoded binary")

"""SimHash near-deduplication with a Gray-order hierarchical index.

Fingerprints that differ in few bits must agree in some pair of bit blocks, so each distinct fingerprint goes
to one bucket per pair.  Inside a bucket the fingerprints are sorted by Gray rank; runs of neighbours become
nodes that hold the bits all of them share, nodes become larger nodes, and two groups are compared by the
differences accumulated in their shared bits, which drops whole groups before any of their members are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_key_join
from .common import stored, words_of
from .graph import components

SEED = 42
# Fan-out of the index, group pairs compared at once, and codes worked on at once.
FAN = 8
PAIRS_AT_ONCE = 1 << 19
CODES_AT_ONCE = 1 << 16
# Larger buckets are split by further bits.  Once no more than FREE_BITS bits are open, a bucket cannot
# hold more than 2**FREE_BITS different codes.
BUCKET = 1 << 14
FREE_BITS = 14
SHINGLES_AT_ONCE = 1 << 15


def fingerprint(words: list[bytes], shingle: int) -> int:
    """64-bit SimHash of the word shingles; zero without words, one shingle if they are too few."""
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        part = zip(starts[at : at + SHINGLES_AT_ONCE], ends[at : at + SHINGLES_AT_ONCE])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in part], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Identifier and ``code``, the fingerprint as a signed 64-bit number.  A null text counts as empty."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            codes = [fingerprint(words_of(t.as_py()), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(codes, "<u8").view("<i8"))], ["id", "code"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"id {kind}, code bigint").withColumnRenamed("id", id_col)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def block_masks(free: int, bits: int) -> list[int]:
    """Masks of all pairs of the ``bits + 2`` blocks into which the set bits of ``free`` are cut.

    Two codes with at most ``bits`` differing bits agree on at least two blocks.
    """
    places = [i for i in range(64) if free >> i & 1]
    blocks = [sum(1 << i for i in part.tolist()) for part in np.array_split(np.array(places, int), bits + 2)]
    return [a | b for a, b in combinations(blocks, 2)]


class GrayIndex:
    """Nodes over codes sorted by (bucket, Gray rank): per level, shared bits and the mask of those bits."""

    def __init__(self, bucket: np.ndarray, codes: np.ndarray):
        full = np.full(len(codes), ~np.uint64(0))
        self.bits, self.mask, self.first = [codes], [full], []
        owner = bucket
        while True:
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            if len(starts) == len(owner):
                break
            size = np.diff(np.append(starts, len(owner)))
            inside = np.arange(len(owner)) - np.repeat(starts, size)
            heads = np.flatnonzero(inside % FAN == 0)
            held = np.bitwise_and.reduceat(self.mask[-1], heads)
            ones = np.bitwise_and.reduceat(self.bits[-1] | ~self.mask[-1], heads)
            zeros = np.bitwise_and.reduceat(~self.bits[-1] | ~self.mask[-1], heads)
            same = held & (ones | zeros)
            self.first.append(np.append(heads, len(owner)))
            self.mask.append(same)
            self.bits.append(ones & same)
            owner = owner[heads]

    def near_pairs(self, bits: int, linked) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of codes of one bucket with at most ``bits`` differing bits, in portions.

        ``linked(level, a, b)`` tells which node pairs need no further look.
        """
        top = np.arange(len(self.bits[-1]))
        todo = [(len(self.first), top, top, np.zeros(len(top), np.uint8))]
        while todo:
            level, a, b, far = todo.pop()
            if len(a) > PAIRS_AT_ONCE:
                half = len(a) // 2
                todo += [(level, a[half:], b[half:], far[half:]), (level, a[:half], b[:half], far[:half])]
                continue
            open_ = (far <= bits) & ~linked(level, a, b)
            a, b = a[open_], b[open_]
            if level == 0:
                yield a[a != b], b[a != b]
                continue
            first, shared = self.first[level - 1], self.mask[level][a] & self.mask[level][b]
            wide_a, wide_b = first[a + 1] - first[a], first[b + 1] - first[b]
            count = wide_a * wide_b
            pair = np.repeat(np.arange(len(a)), count)
            nth = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
            x = first[a[pair]] + nth // wide_b[pair]
            y = first[b[pair]] + nth % wide_b[pair]
            keep = x <= y
            x, y, pair = x[keep], y[keep], pair[keep]
            below = self.mask[level - 1]
            # The parents' difference covers the bits both share; only bits new at this level are counted.
            new = below[x] & below[y] & ~shared[pair]
            differ = np.bitwise_count((self.bits[level - 1][x] ^ self.bits[level - 1][y]) & new)
            todo.append((level - 1, x, y, far[open_][pair] + differ))


def _unite(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> bool:
    changed = False
    while True:
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            return changed
        u, v, changed = u[apart], v[apart], True
        np.minimum.at(label, np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart]))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def bucket_links(bucket: np.ndarray, codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected by near pairs within buckets: each code with its component's first.

    Groups already connected are skipped, so a bucket full of near copies is not compared pair by pair.
    """
    order = np.lexsort((gray_rank(codes), bucket))
    bucket, codes = bucket[order], codes[order]
    index = GrayIndex(bucket, codes)
    label = np.arange(len(codes))
    spans: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def linked(level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if level not in spans:
            low = high = label
            for first in index.first[:level]:
                low, high = np.minimum.reduceat(low, first[:-1]), np.maximum.reduceat(high, first[:-1])
            spans[level] = low, high
        low, high = spans[level]
        return (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]) & ((a != b) | (level > 0))

    for u, v in index.near_pairs(bits, linked):
        if _unite(label, u, v):
            spans.clear()
    moved = np.flatnonzero(label != np.arange(len(codes)))
    return codes[moved], codes[label[moved]]


def _cut_by_bucket(found: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole buckets from rows sorted by bucket, about ``most`` codes at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in found:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)))
        if sum(len(x[0]) for x in held) < most:
            continue
        bucket, codes = (np.concatenate(x) for x in zip(*held))
        cut = np.searchsorted(bucket, bucket[-1])
        held = [(bucket[cut:], codes[cut:])]
        if cut:
            yield bucket[:cut], codes[:cut]
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def code_links(codes: DataFrame, bits: int, bucket: int = BUCKET) -> DataFrame:
    """Links ``u, v`` that connect all distinct codes of ``code`` within ``bits`` differing bits of each other.

    A bucket with more than ``bucket`` codes is split again by pairs of blocks of its open bits, until it is small or
    so few bits are open that it cannot be large: no code is dropped and no task holds an unbounded bucket.
    """

    def spread(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            above, fixed = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            code = batch.column(2).to_numpy().view(np.uint64)
            for mask in np.unique(fixed):
                rows = fixed == mask
                for more in block_masks(~int(mask) & (2**64 - 1), bits):
                    held = np.uint64(int(mask) | more)
                    key = ((code[rows] & held) ^ (above[rows] * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
                    key = (key ^ (key >> np.uint64(32)) ^ held) * np.uint64(0xD6E8FEB86659FD93)
                    columns = [key, np.full(len(key), held), code[rows]]
                    yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], ["key", "fixed", "code"])

    def link(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, found_codes in _cut_by_bucket(found, CODES_AT_ONCE):
            u, v = bucket_links(keys, found_codes, bits)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    shape = "key bigint, fixed bigint, code bigint"
    wide = codes.select(F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("fixed"), "code").distinct()
    ready = None
    while True:
        keyed = stored(wide.mapInArrow(spread, shape), "simhash-keys")
        counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("fixed").alias("held"))
        large = counts.where((F.col("n") > bucket) & (F.lit(64) - F.bit_count("held") > FREE_BITS)).select("key")
        if large.isEmpty():
            ready = keyed if ready is None else ready.union(keyed)
            break
        large = large.hint("merge")
        small = hot_key_join(keyed, large, ["key"], "left_anti")
        ready = small if ready is None else ready.union(small)
        wide = hot_key_join(keyed, large, ["key"], "left_semi").select(*keyed.columns)
    sorted_ = ready.select("key", "code").repartition("key").sortWithinPartitions("key")
    return sorted_.mapInArrow(link, "u bigint, v bigint").distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 5, bits: int = 4, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET
) -> DataFrame:
    """One row per input row: identifier, ``fingerprint`` (16 hex digits) and ``component_id``.

    Texts link when their fingerprints differ in at most ``bits`` bits; ``component_id`` is the smallest identifier
    reached over any number of links.  Null and word-less texts have fingerprint zero and link like any other.  A null
    identifier never names a component, unless all identifiers in it are null.  Repeated rows give repeated
    rows; an empty table gives none; other columns are ignored.
    """
    codes = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = stored(codes.groupBy("code").agg(F.min(id_col).alias("least")), "classes")
    roots = components(code_links(classes, bits, bucket))
    member = classes.join(roots.withColumnRenamed("node", "code").hint("merge"), "code", "left").select(
        "code", F.coalesce("root", "code").alias("root"), "least"
    )
    # A family of near copies may hold a large share of the codes: its root is a hot key.
    names = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = hot_key_join(member, names, ["root"], "inner").select("code", "component_id")
    return hot_key_join(codes, named, ["code"], "inner").select(
        id_col, F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )

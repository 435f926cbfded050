"""Removal of repeated byte strings by a hash-compared suffix sort.

A string of ``length`` bytes is judged at every byte position of every text, but only where it can matter:

1. Each window of ``length`` bytes is led by the byte string of ``GRAM`` bytes in it with the smallest hash (its anchor).  Equal
   windows have equal anchors at equal places.  A run of windows with one anchor is one row; its whole text is known by
   the anchor's hash and a prefix polynomial hash.
2. Rows of one anchor meet.  Rows with equal texts are settled at once: all but the first are removed.  Only anchors that occur in
   different surroundings go on, and of equal rows only the first does.
3. These surroundings are fetched and suffix-sorted around their anchors, to the right and, reversed, to the left.  Prefix
   polynomial hashes and binary search give the common extension of two suffixes in a logarithmic number of steps; a mergesort
   uses it as its comparison, and all common extensions it reports are verified byte by byte.  Windows are equal when their
   two sides fall into the same groups of suffixes.
4. Anchors with very many surroundings are sorted in blocks; what is first in its block is compared over all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_key_join
from .common import slices, stored, text_of

GRAM = 24
PORTION = 1 << 19
# Surroundings of one anchor that one batch passes on to the anchor's own task, and that one block may hold.
MOST_HERE = 16
BLOCK = 1024
SORTED_AT_ONCE = 1 << 20
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
NO_ID = (1 << 63) - 1
PLACE_BITS = 32

ANCHOR, REMOVED, OPEN, MANY, SENT = range(5)
_SHAPE = "kind int, kh bigint, ctx bigint, tn int, doc bigint, tp bigint"
_NAMES = ["kind", "kh", "ctx", "tn", "doc", "tp"]


@lru_cache(maxsize=8)
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, and a table of random values for bytes."""
    count = 1 << bits
    inverse = pow(base, -1, 1 << 64)
    made = []
    for b in (base, inverse):
        table = np.ones(1, np.uint64)
        while len(table) < count:
            table = np.concatenate((table, table * np.uint64(pow(b, len(table), 1 << 64))))
        made.append(table[:count])
    values = np.random.default_rng(base % (1 << 32)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    return made[0], made[1], values


class PrefixHashes:
    """Polynomial hashes of all prefixes; of a substring in constant time."""

    def __init__(self, data: np.ndarray, base: int = BASES[0]):
        power, self.inverse, values = _powers(base, max(20, int(len(data)).bit_length()))
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(values[data] * power[: len(data)], dtype=np.uint64)))

    def of(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.inverse[start]


def _common(hashes: PrefixHashes, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Common extension of the suffixes at ``x`` and ``y``, at most ``most``, by binary search."""
    low, high = np.zeros(len(x), np.int64), most.copy()
    for _ in range(int(most.max(initial=0)).bit_length()):
        mid = (low + high + 1) >> 1
        same = hashes.of(x, mid) == hashes.of(y, mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def suffix_sort(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the substrings, and for each in order its common extension with the one before (0 for the first).

    A bottom-up mergesort: all pairs of runs of a level are merged at once, each place in the other run found by
    binary search with hash-compared suffixes.  Reported extensions are verified; on a collision another base is tried.
    """
    for base in BASES:
        order, shared = _sorted_by(PrefixHashes(data, base), data, start, size)
        if _verified(data, start[order], size[order], shared):
            return order, shared
    raise RuntimeError("hash collisions with every base")


def _sorted_by(hashes: PrefixHashes, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    padded = np.append(data, np.uint8(0))

    def before(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether item ``y`` sorts before item ``x``; equal items keep their order."""
        least = np.minimum(size[x], size[y])
        same = _common(hashes, start[x], start[y], least)
        ended = same == least
        smaller = padded[start[y] + np.where(ended, 0, same)] < padded[start[x] + np.where(ended, 0, same)]
        return np.where(ended, size[y] < size[x], smaller)

    count = len(start)
    order = np.arange(count)
    width = 1
    while width < count:
        at = np.arange(count)
        run = at // width
        left = at[(run % 2 == 0) & ((run + 1) * width < count)]
        low = (run[left] + 1) * width
        first = low.copy()
        high = np.minimum(low + width, count)
        while True:
            open_ = low < high
            if not open_.any():
                break
            mid = (low + high) >> 1
            goes = np.zeros(len(left), bool)
            goes[open_] = before(order[left[open_]], order[mid[open_]])
            low, high = np.where(open_ & goes, mid + 1, low), np.where(open_ & ~goes, mid, high)
        place = np.full(count, -1)
        place[left] = left + (low - first)
        alone = (run % 2 == 0) & ((run + 1) * width >= count)
        place[alone] = at[alone]
        merged = np.full(count, -1)
        merged[place[place >= 0]] = order[place >= 0]
        merged[merged < 0] = order[place < 0]
        order, width = merged, width * 2
    shared = np.zeros(count, np.int64)
    x, y = order[:-1], order[1:]
    shared[1:] = _common(hashes, start[x], start[y], np.minimum(size[x], size[y]))
    return order, shared


def _verified(data: np.ndarray, start: np.ndarray, size: np.ndarray, shared: np.ndarray) -> bool:
    rows = 1 << 12
    for at in range(1, len(start), rows):
        x, y, n = start[at - 1 : at - 1 + rows][: len(start[at : at + rows])], start[at : at + rows], shared[at : at + rows]
        step = np.arange(int(n.max(initial=0)))
        inside = step < n[:, None]
        last = len(data) - 1
        if (inside & (data[np.minimum(x[:, None] + step, last)] != data[np.minimum(y[:, None] + step, last)])).any():
            return False
    return True


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    words = np.ndarray(len(data) - 7, "<u8", data.tobytes(), 0, (1,))
    count = len(data) - GRAM + 1
    mixed = words[:count] * np.uint64(BASES[0])
    for k in range(8, GRAM, 8):
        mixed ^= mixed >> np.uint64(32)
        mixed += words[k : k + count]
        mixed *= np.uint64(BASES[1])
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(BASES[2])
    return mixed ^ (mixed >> np.uint64(32))


def anchor_runs(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text number, first window, windows, place of the anchor in the first window, hash of the anchor,
    hash of the run's text.  ``ends`` says where the texts laid end to end in ``data`` end."""
    nothing = np.zeros(0, np.int64)
    if len(data) < length:
        return nothing, nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
    grams = _gram_hashes(data)
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    reach, have = length - GRAM + 1, 1
    while have < reach:
        step = min(have, reach - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    text = np.repeat(np.arange(len(ends)), ends - starts)[: len(anchor)]
    inside = np.arange(len(anchor)) + length <= ends[text]
    turns = np.empty(len(anchor), bool)
    turns[0] = True
    turns[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(turns & inside)
    last = np.minimum(np.append(np.flatnonzero(turns), len(anchor))[np.searchsorted(np.flatnonzero(turns), first, "right")], ends[text[first]] - length + 1)
    windows = last - first
    hashes = PrefixHashes(data).of(first, windows + (length - 1))
    return text[first], first - starts[text[first]], windows, anchor[first] - first, grams[anchor[first]], hashes


def _spans(doc: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of overlapping or touching ranges ``first .. end`` per document."""
    order = np.lexsort((first, doc))
    doc, first, end = doc[order], first[order], end[order]
    if not len(doc):
        return doc, first, end
    new = np.concatenate(([True], doc[1:] != doc[:-1]))
    # Running maximum of the ends inside each document: lift each document above the one before it.
    group = np.cumsum(new) - 1
    rank = np.unique(end, return_inverse=True)[1] + group * (len(end) + 1)
    top = np.maximum.accumulate(rank) - group * (len(end) + 1)
    reached = np.sort(np.unique(end))[top]
    new[1:] |= first[1:] > reached[:-1]
    heads = np.flatnonzero(new)
    return doc[heads], first[heads], np.maximum.reduceat(end, heads)


def _rows(kind, kh, ctx, tn, doc, tp) -> pa.RecordBatch:
    count = len(doc)
    full = lambda v, t: np.broadcast_to(np.asarray(v).astype(t), (count,))
    columns = [full(kind, np.int32), np.asarray(kh).view(np.int64) if np.ndim(kh) else full(kh, np.int64)]
    columns += [np.asarray(ctx).view(np.int64) if np.ndim(ctx) else full(ctx, np.int64), full(tn, np.int32), full(doc, np.int64), full(tp, np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _NAMES)


def _removed_rows(doc: np.ndarray, tp: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    """Removed ranges as rows: ``ctx`` holds the number of bytes, ``kh`` spreads them."""
    doc, first, end = _spans(doc, tp, tp + size)
    spread = (doc.astype(np.uint64) * np.uint64(BASES[0])) ^ first.astype(np.uint64)
    return _rows(REMOVED, spread, (end - first).astype(np.int64), 0, doc, first)


def _anchors(length: int):
    def portions(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """Document, tie and first byte of some texts, and their bytes; a long text comes in pieces that overlap."""
        held, size, rows = [], 0, []
        for doc, tie, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            data = text.as_buffer()
            for at in range(0, max(1, len(data) - length + 1), PORTION):
                held.append(data[at : at + PORTION + length - 1].to_pybytes())
                rows.append((doc, tie, at))
                size += len(held[-1])
                if size >= PORTION:
                    yield np.array(rows, np.int64).T, held
                    held, size, rows = [], 0, []
        if held:
            yield np.array(rows, np.int64).T, held

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            parts = []
            for (doc, tie, at), texts in portions(batch):
                ends = np.cumsum([len(t) for t in texts])
                text, first, windows, place, kh, ctx = anchor_runs(np.frombuffer(b"".join(texts), np.uint8), ends, length)
                parts.append((kh, ctx, place << 8 | windows, doc[text], (tie[text] << PLACE_BITS) + at[text] + first))
            if not parts:
                continue
            kh, ctx, tn, doc, tp = (np.concatenate(x) for x in zip(*parts))
            if not len(kh):
                continue
            same = (kh ^ (ctx * np.uint64(BASES[2]))) * np.uint64(BASES[3]) ^ tn.astype(np.uint64)
            order = np.lexsort((tp, doc, same))
            kh, ctx, tn, doc, tp, same = (x[order] for x in (kh, ctx, tn, doc, tp, same))
            new = np.concatenate(([True], same[1:] != same[:-1]))
            heads = np.flatnonzero(new)
            head = heads[np.cumsum(new) - 1]
            later = (doc != doc[head]) | (tp != tp[head])
            if later.any():
                yield _removed_rows(doc[later], tp[later], (tn[later] & 255) + (length - 1))
            kh, ctx, tn, doc, tp = (x[heads] for x in (kh, ctx, tn, doc, tp))
            classes, at, count = np.unique(kh, return_inverse=True, return_counts=True)
            many = count[at] > MOST_HERE
            yield _rows(ANCHOR, kh[~many], ctx[~many], tn[~many], doc[~many], tp[~many])
            if many.any():
                # These are known to have other surroundings: they go on as they are, in a block of this batch.
                block = (int(doc[many].min()) * BASES[1] + int(tp[many].min())) % (1 << 62) + 1
                yield _rows(OPEN, kh[many], np.full(int(many.sum()), block), tn[many], doc[many], tp[many])
                told = classes[count > MOST_HERE]
                yield _rows(MANY, told, 0, 0, np.full(len(told), -1), -1)

    return batches


def _settle(length: int):
    """Meet rows of one anchor, sorted by ``kh, kind rank, tn, ctx, doc, tp``.  Between batches at most a few rows are carried."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: list[np.ndarray] | None = None
        seen = 0
        for batch in found:
            columns = [c.to_numpy() for c in batch.columns]
            passed = np.isin(columns[0], (REMOVED, OPEN))
            if passed.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[passed]) for c in columns] + [pa.array(np.full(passed.sum(), 1))], [*_NAMES, "many"])
                columns = [c[~passed] for c in columns]
            if carried is not None:
                columns = [np.concatenate(x) for x in zip(carried, columns)]
            if len(columns[0]):
                made, carried, seen = settle(columns, seen, False)
                yield from made
        if carried is not None:
            made, _, _ = settle(carried, seen, True)
            yield from made

    def settle(columns: list[np.ndarray], seen: int, last: bool):
        kind, kh, ctx, tn, doc, tp = columns
        count = len(kh)
        at = np.arange(count)
        new_class = np.concatenate(([True], kh[1:] != kh[:-1]))
        told = kind == MANY
        new = new_class | told
        new[1:] |= (tn[1:] != tn[:-1]) | (ctx[1:] != ctx[:-1]) | told[:-1]
        head = np.maximum.accumulate(np.where(new, at, 0))
        later = ~new & ((doc != doc[head]) | (tp != tp[head]))
        class_of = np.cumsum(new_class) - 1
        class_at = np.flatnonzero(new_class)
        groups = np.add.reduceat((new & ~told).astype(np.int64), class_at)
        flagged = np.logical_or.reduceat(told, class_at)
        several = ((groups > 1) | flagged)[class_of]
        is_group = new & ~told
        upto = np.cumsum(is_group)
        nth = upto - (upto - is_group)[class_at][class_of] - 1
        nth[class_of == 0] += seen
        report = new & (kind == ANCHOR) & several
        made = []
        if later.any():
            removed = _removed_rows(doc[later], tp[later], (tn[later] & 255) + (length - 1))
            made.append(removed.append_column("many", pa.array(np.zeros(removed.num_rows, np.int64))))
        # A class is in several blocks if it is flagged, or holds more than one block of groups.
        whole = np.maximum.reduceat(nth, class_at)[class_of]
        spread = flagged[class_of] | (whole >= BLOCK) | ((class_of == class_of[-1]) & (not last))
        block = np.maximum(nth, 0) // BLOCK
        if report.any():
            rows = _rows(OPEN, kh[report].view(np.uint64), block[report].astype(np.int64), tn[report], doc[report], tp[report])
            made.append(rows.append_column("many", pa.array(spread[report].astype(np.int64))))
        if last:
            return made, None, 0
        mine = class_of == class_of[-1]
        if several[-1]:
            # What has been told of the class, and the first row of its last group, which later rows may equal.
            end = head[-1]
            keep = [np.array([MANY], kind.dtype), kh[-1:], ctx[-1:] * 0, tn[-1:] * 0, doc[-1:] * 0 - 1, tp[-1:] * 0 - 1]
            tail = [np.array([SENT], kind.dtype), *(c[end : end + 1] for c in columns[1:])]
            if told[end]:
                return made, keep, int(nth[-1]) + 1
            return made, [np.concatenate(x) for x in zip(keep, tail)], int(nth[-1])
        end = np.flatnonzero(mine & new)[:1]
        return made, [c[end] for c in columns], 0

    return batches


def window_verdicts(
    data: np.ndarray, start: np.ndarray, place: np.ndarray, windows: np.ndarray, doc: np.ndarray, tp: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all windows of the surroundings: surrounding number, window number, and whether an equal window is earlier.

    ``start`` says where surroundings begin in ``data``, ``place`` where the anchor stands in each.
    """
    anchor, end = start + place, start + windows + (length - 1)
    right, right_shared = suffix_sort(data, anchor, end - anchor)
    mirrored = data[::-1]
    left, left_shared = suffix_sort(mirrored, len(data) - anchor, place)
    owner, number, earlier = [], [], []
    for t in range(int(place.max(initial=-1)) + 1):
        active = np.flatnonzero((place >= t) & (place - t < windows))
        if not len(active):
            continue
        of_right, of_left = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
        of_right[right] = np.cumsum(right_shared < length - t)
        of_left[left] = np.cumsum(left_shared < t)
        key = of_left[active] * (len(start) + 1) + of_right[active]
        nth = place[active] - t
        at, ids = tp[active] + nth, doc[active]
        order = np.lexsort((at, ids, key))
        new = np.concatenate(([True], np.diff(key[order]) != 0))
        head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        later = (ids[order] != ids[head]) | (at[order] != at[head])
        owner.append(active[order])
        number.append(nth[order])
        earlier.append(later)
    if not owner:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(owner), np.concatenate(number), np.concatenate(earlier)


def _sort_surroundings(length: int):
    """Rows ``kh, block, many, tn, doc, tp, bytes`` sorted by (kh, block) to removed ranges, and for anchors in several blocks the
    windows that are first in their block: ``h1, h2`` are then their hashes with two bases."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        many, tn, doc, tp = (np.array(x, np.int64) for x in list(zip(*rows))[2:6])
        texts = [r[6] for r in rows]
        data = np.frombuffer(b"".join(texts), np.uint8)
        start = np.cumsum([0, *map(len, texts[:-1])])
        owner, number, earlier = window_verdicts(data, start, tn >> 8, tn & 255, doc, tp, length)
        gone = _removed_rows(doc[owner[earlier]], tp[owner[earlier]] + number[earlier], np.full(int(earlier.sum()), length))
        zero = pa.array(np.zeros(gone.num_rows, np.int64))
        names = ["size", "h1", "h2", "doc", "tp"]
        yield pa.RecordBatch.from_arrays([gone.column(2), zero, zero, gone.column(4), gone.column(5)], names)
        asks = ~earlier & (many[owner] > 0)
        if asks.any():
            at, size = start[owner[asks]] + number[asks], np.full(int(asks.sum()), length)
            hashes = [PrefixHashes(data, b).of(at, size).view(np.int64) for b in BASES[:2]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (size * 0, *hashes, doc[owner[asks]], tp[owner[asks]] + number[asks])], names)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in found:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= SORTED_AT_ONCE and row[:2] != held[-1][:2]:
                    yield from solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[6])
        if held:
            yield from solve(held)

    return batches


def _surroundings(length: int):
    """Cut the bytes of each open run out of its text."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for i in range(batch.num_rows):
                doc, tie, text, runs = (batch.column(k)[i] for k in range(4))
                text = text.as_buffer()
                runs = runs.values
                tp, kh, block, many, tn = (runs.field(k).to_numpy() for k in ("tp", "kh", "block", "many", "tn"))
                at = (tp & ((1 << PLACE_BITS) - 1)).tolist()
                cut = [text[a : a + n].to_pybytes() for a, n in zip(at, ((tn & 255) + (length - 1)).tolist())]
                columns = [kh, block, many, tn, np.full(len(at), doc.as_py()), tp]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(cut, pa.binary())], ["kh", "block", "many", "tn", "doc", "tp", "bytes"])

    return batches


def removed_ranges(texts: DataFrame, length: int) -> DataFrame:
    """Ranges ``doc, tie, first, size`` of bytes to remove from rows ``doc, tie, text``; ranges may overlap."""
    found = texts.mapInArrow(_anchors(length), _SHAPE)
    rank = F.when(F.col("kind") == MANY, F.lit(0)).otherwise(F.lit(1))
    met = found.repartition("kh").sortWithinPartitions("kh", rank, "tn", "ctx", "doc", "tp")
    settled = stored(met.mapInArrow(_settle(length), _SHAPE + ", many bigint"), "suffix-settled")
    gone = settled.where(F.col("kind") == REMOVED).select("doc", "tp", F.col("ctx").alias("size"))

    tie = F.shiftright("tp", PLACE_BITS)
    run = F.struct("tp", "kh", F.col("ctx").alias("block"), "many", F.col("tn").cast("bigint").alias("tn"))
    runs = settled.where(F.col("kind") == OPEN).groupBy("doc", tie.alias("tie")).agg(F.collect_list(run).alias("runs"))
    cut = texts.join(runs, ["doc", "tie"]).select("doc", "tie", "text", "runs").mapInArrow(
        _surroundings(length), "kh bigint, block bigint, many bigint, tn bigint, doc bigint, tp bigint, bytes binary"
    )
    ordered = cut.repartition("kh", "block").sortWithinPartitions("kh", "block")
    judged = ordered.mapInArrow(_sort_surroundings(length), "size bigint, h1 bigint, h2 bigint, doc bigint, tp bigint")
    judged = stored(judged, "suffix-judged")
    sorted_out = judged.where("size > 0").select("doc", "tp", "size")
    windows = judged.where("size = 0").select("h1", "h2", "doc", "tp")
    first = windows.groupBy("h1", "h2").agg(F.min(F.struct("doc", "tp")).alias("first"))
    late = hot_key_join(windows, first, ["h1", "h2"], "inner").where(F.struct("doc", "tp") != F.col("first"))
    late = late.select("doc", "tp", F.lit(length).cast("bigint").alias("size"))
    place = F.col("tp").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return gone.union(sorted_out).union(late).select("doc", tie.alias("tie"), place.alias("first"), "size")


def remove_repeats(
    docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per input row: identifier, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept``, the remaining bytes, and columns ``carry``.

    A byte goes if a string of ``length`` bytes over it also starts earlier: in a document with a smaller identifier (null
    counts as largest), or earlier in the same one.  Different texts under one identifier are ordered by a
    hash; rows that repeat identifier and text are one document and get equal results.  Null and empty texts have no
    bytes.  Texts shorter than ``length`` are kept.  An empty table gives no rows; other columns are ignored.
    """
    if not GRAM + 1 <= length <= GRAM + 230:
        raise ValueError(f"length lies between {GRAM + 1} and {GRAM + 230}")
    data = text_of(text_col).cast("binary")
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("doc"),
        F.pmod(F.crc32(data), F.lit(1 << 31)).alias("tie"),
        data.alias("text"),
        F.struct(F.lit(0), *carry).alias("carried"),
    )
    ranges = removed_ranges(texts.drop("carried"), length).groupBy("doc", "tie").agg(F.collect_list(F.struct("first", "size")).alias("ranges"))

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(found):
            kept, removed, spans = [], [], []
            for text, ranges in zip(batch.column(2), batch.column(3)):
                text = text.as_buffer().to_pybytes()
                if not ranges.is_valid:
                    kept.append(text)
                    removed.append(0)
                    spans.append(0)
                    continue
                first, size = (ranges.values.field(k).to_numpy() for k in ("first", "size"))
                _, first, end = _spans(np.zeros(len(first), np.int64), first, first + size)
                edges = [0, *np.stack((first, end), 1).ravel().tolist(), len(text)]
                kept.append(b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])]))
                removed.append(len(text) - len(kept[-1]))
                spans.append(len(first))
            sizes = [len(t.as_buffer()) for t in batch.column(2)]
            columns = [pa.array(c, pa.int64()) for c in (sizes, removed, spans)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(kept, pa.binary()), batch.column(4)], ["doc", "n_bytes", "n_removed", "n_spans", "kept", "carried"])

    met = texts.join(ranges, ["doc", "tie"], "left").select("doc", "tie", "text", "ranges", "carried")
    kind = met.schema["carried"].dataType.simpleString()
    done = met.mapInArrow(batches, f"doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, carried {kind}")
    name = F.when(F.col("doc") != NO_ID, F.col("doc")).alias(id_col)
    return done.select(name, "n_bytes", "n_removed", "n_spans", "kept", *[F.col("carried")[c].alias(c) for c in carry])

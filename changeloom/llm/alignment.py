"""Alignment of two tokenizers over the same bytes, and which of their ids stand for each other in a corpus.

Both tokenizers' tokens end somewhere in the text's bytes.  A table from byte end to index is kept for each; the ends in both
cut the two lists of ids into groups, and inside a group every id of one side is linked to every id of the other.  Pairs of linked ids
are counted by documents; each document's links are then measured by these counts.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored
from .packing import text_encoder

# Pairs that a task counts before it sends them on, and that a task holds with their counts when links are measured.
COUNTED_AT_ONCE = 1 << 20
HELD_PAIRS = 1 << 18
# Links of one group beyond which equal ids are put together before links are made.
LARGE_GROUP = 1 << 16
TEXTS_AT_ONCE = 64
# Fixed value: the character that stands for a space in pieces.
PIECE_SPACE = "▁"


class Aligner:
    """A byte-level BPE (A, given the text with a space before it) and a piece model (B, which adds that space itself)."""

    def __init__(self, bpe_path: str, piece_path: str):
        encoder = text_encoder(bpe_path)
        # Special tokens' strings inside a text are plain text to this encoder.
        self.encode_a, self.decode_a = encoder.ranked.encode_ordinary, encoder.ranked.decode_bytes
        pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.encode_b = lambda texts: pieces.encode(texts, num_threads=1)
        self.bytes_a = [b""] * len(encoder.ends_line)
        for token in encoder.ranked.token_byte_values():
            self.bytes_a[encoder.ranked.encode_single_token(token)] = token
        self.bytes_b = [_piece_bytes(pieces, i) for i in range(pieces.vocab_size())]
        self.size_a, self.size_b = len(self.bytes_a), len(self.bytes_b)
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        names = np.array([str(i) for i in range(max(self.size_a, self.size_b))], "S")
        self.digits_of = np.strings.str_len(names)
        # Digits of each id, with room for the mark behind it.
        self.digits = np.pad(names.view(np.uint8).reshape(len(names), -1), ((0, 0), (0, 1)))

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B of each text; none where the text is null or empty or the tokens' bytes are not the text's."""
        none = np.empty(0, np.int64)
        whole = self.encode_b([t or "" for t in texts])
        for text, b in zip(texts, whole):
            if not text:
                yield none, none
                continue
            spaced = " " + text
            a = self.encode_a(spaced)
            expected = spaced.encode()
            same = self.decode_a(a) == expected and b"".join([self.bytes_b[i] for i in b]) == expected
            yield tuple(np.array(array("I", ids), np.int64) for ids in (a, b)) if same else (none, none)

    def cuts(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of A's and of B's tokens up to each end that both share."""
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        size = max(end_a[-1] if len(a) else 0, end_b[-1] if len(b) else 0) + 1
        upto_a, upto_b = np.zeros(size, np.int64), np.zeros(size, np.int64)
        # Of tokens without bytes, which repeat an end, the last one counts.
        upto_a[end_a], upto_b[end_b] = np.arange(1, len(a) + 1), np.arange(1, len(b) + 1)
        common = np.flatnonzero((upto_a > 0) & (upto_b > 0))
        return upto_a[common], upto_b[common]

    def links(self, a: np.ndarray, b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct linked pairs, as ``a * size_b + b`` in rising order, and how many links each has."""
        start_a, start_b = (np.concatenate(([0], s[:-1])) if len(s) else s for s in (stop_a, stop_b))
        wide_a, wide_b = stop_a - start_a, stop_b - start_b
        count = wide_a * wide_b
        large = np.flatnonzero(count > LARGE_GROUP)
        count[large] = 0
        group = np.repeat(np.arange(len(count)), count)
        nth = np.arange(len(group)) - np.repeat(np.cumsum(count) - count, count)
        keys, times = np.unique(
            a[start_a[group] + nth // np.maximum(wide_b, 1)[group]] * self.size_b + b[start_b[group] + nth % np.maximum(wide_b, 1)[group]],
            return_counts=True,
        )
        for g in large.tolist():
            of_a, times_a = np.unique(a[start_a[g] : stop_a[g]], return_counts=True)
            of_b, times_b = np.unique(b[start_b[g] : stop_b[g]], return_counts=True)
            more = (of_a[:, None] * self.size_b + of_b[None, :]).ravel()
            both, at = np.unique(np.concatenate((keys, more)), return_inverse=True)
            sums = np.zeros(len(both), np.int64)
            np.add.at(sums, at, np.concatenate((times, (times_a[:, None] * times_b[None, :]).ravel())))
            keys, times = both, sums
        return keys, times

    def written(self, a: np.ndarray, b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray) -> bytes:
        """Groups as text: ids of A, a bar, ids of B; groups are parted by semicolons."""
        ids, marks = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        # A token stands behind all tokens of earlier groups, and one of B also behind its own group's of A.
        ids[np.arange(len(a)) + np.repeat(np.concatenate(([0], stop_b[:-1])), np.diff(stop_a, prepend=0))] = a
        ids[np.arange(len(b)) + np.repeat(stop_a, np.diff(stop_b, prepend=0))] = b
        marks[stop_a + np.concatenate(([0], stop_b[:-1])) - 1] = ord("|")
        marks[stop_a + stop_b - 1] = ord(";")
        size = self.digits_of[ids]
        text = self.digits[ids]
        text[np.arange(len(ids)), size] = marks
        return text[np.arange(text.shape[1]) <= size[:, None]][:-1].tobytes()


def _piece_bytes(pieces: sentencepiece.SentencePieceProcessor, i: int) -> bytes:
    piece = pieces.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace(PIECE_SPACE, " ").encode()


@lru_cache(maxsize=2)
def aligner(bpe_path: str, piece_path: str) -> Aligner:
    return Aligner(bpe_path, piece_path)


_FOUND = ["row", "id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"]


def aligned(docs: DataFrame, bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", groups: bool = False) -> DataFrame:
    """One row per input row: ``row, id, n_a, n_b, n_groups, groups_sha256``, its distinct linked ``pairs`` and their ``times``.

    ``row`` numbers the rows.  With ``groups`` the text that was hashed is there too.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shape = f"row bigint, id {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(bpe_path, piece_path)
        for batch in slices(found, TEXTS_AT_ONCE):
            made = []
            for a, b in both.encode(batch.column(2).to_pylist()):
                cut = both.cuts(a, b)
                text = both.written(a, b, *cut) if len(a) else b""
                digest = hashlib.sha256(text).hexdigest() if len(a) else ""
                made.append((len(a), len(b), len(cut[0]), digest, *both.links(a, b, *cut), *([text.decode()] if groups else [])))
            kinds = [pa.int64()] * 3 + [pa.string()] + [pa.list_(pa.int64())] * 2 + [pa.string()] * groups
            columns = [pa.array(list(c), k) for c, k in zip(zip(*made), kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], _FOUND + ["groups"] * groups)

    return rows.mapInArrow(batches, shape + ", groups string" * groups)


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair, n``: how many rows hold each pair.  A task adds up a bounded number of pairs at a time before it sends them."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])

        for batch in source:
            held.append(batch.column(0).flatten().to_numpy())
            size += len(held[-1])
            if size >= COUNTED_AT_ONCE:
                yield counted()
                held, size = [], 0
        if size:
            yield counted()

    return found.select("pairs").mapInArrow(batches, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def _least_count(counts: DataFrame, most: int) -> int:
    """The smallest count such that no more than about ``most`` pairs have it, by a histogram of at most a few hundred steps."""
    step = F.floor(F.log2("n") * 8)
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("least"))
    total, least = 0, 1 << 62
    for r in sorted(steps.collect(), key=lambda r: -r["step"]):
        total += r["pairs"]
        if total > most:
            break
        least = r["least"]
    return least


def measured(found: DataFrame, counts: DataFrame, size_b: int, held_pairs: int = HELD_PAIRS) -> DataFrame:
    """``found`` with ``n_links, n_best, count_sum`` from the counts of all pairs.

    At most ``held_pairs`` of the most frequent pairs are held in tasks, which bounds what is broadcast and leaves no hot key; the
    pairs of documents that are not among them are joined.
    """
    of_a = F.expr(f"pair div {size_b}")
    best = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("top"))
    ranked = counts.withColumn("a", of_a).join(best, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    ranked = stored(ranked, "alignment-counts")
    least = _least_count(ranked, held_pairs)
    table = ranked.where(F.col("n") >= least).orderBy("pair").toArrow()
    known = tuple(table.column(c).to_numpy() for c in ("pair", "n", "best"))
    shared = found.sparkSession.sparkContext.broadcast(known)

    def looked_up(batch: pa.RecordBatch) -> tuple:
        pair, n, is_best = shared.value
        keys, times = (batch.column(i).flatten().to_numpy() for i in (1, 2))
        owner = np.repeat(np.arange(batch.num_rows), batch.column(1).value_lengths().to_numpy())
        at = np.minimum(np.searchsorted(pair, keys), max(len(pair) - 1, 0))
        met = pair[at] == keys if len(pair) else np.zeros(len(keys), bool)
        return keys, times, owner, at, met, n, is_best

    def sums(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            keys, times, owner, at, met, n, is_best = looked_up(batch)
            made = np.zeros((3, batch.num_rows), np.int64)
            np.add.at(made[0], owner, times)
            np.add.at(made[1], owner[met], times[met] * is_best[at[met]])
            np.add.at(made[2], owner[met], times[met] * n[at[met]])
            columns = [batch.column(0), *batch.columns[3:], *[pa.array(m) for m in made]]
            yield pa.RecordBatch.from_arrays(columns, ["row", *held, "n_links", "n_best", "count_sum"])

    def rest(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            keys, times, owner, _, met, _, _ = looked_up(batch)
            row = batch.column(0).to_numpy()[owner[~met]]
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(keys[~met]), pa.array(times[~met])], ["row", "pair", "times"])

    held = [c for c in found.columns if c not in ("row", "pairs", "times")]
    shape = ", ".join(f"`{c}` {found.schema[c].dataType.simpleString()}" for c in ("row", *held))
    whole = found.select("row", "pairs", "times", *held).mapInArrow(sums, f"{shape}, n_links bigint, n_best bigint, count_sum bigint")
    rare = found.select("row", "pairs", "times").mapInArrow(rest, "row bigint, pair bigint, times bigint")
    rare = rare.join(ranked.where(F.col("n") < least), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    return whole.join(rare, "row", "left").select(
        *held, "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )


def alignment(
    docs: DataFrame, bpe_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", held_pairs: int = HELD_PAIRS
) -> DataFrame:
    """One row per input row: identifier, ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A link joins a token of each side whose bytes share a group.  A pair of ids counts once per row that holds it linked;
    ``n_best`` are links whose pair has its A id's highest count (ties included), ``count_sum`` adds up the counts over links.  A
    null or empty text, or one that the piece model does not give back byte by byte, has zeros and an empty hash.  Repeated
    rows count as often as they occur; null identifiers stay null; an empty table gives no rows; other columns are ignored.
    """
    both = aligner(bpe_path, piece_path)
    found = stored(aligned(docs, bpe_path, piece_path, id_col, text_col), "alignment-rows")
    result = measured(found, pair_counts(found), both.size_b, held_pairs).withColumnRenamed("id", id_col)
    return result.select(id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

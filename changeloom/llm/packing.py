"""Order-preserving packing of token sequences by dynamic programming.

Documents are laid end to end in the order of their identifiers.  Sequences may end at document ends (free), at
sentence ends (a small penalty) and at regular steps inside long sentences (a larger one).  The cheapest choice
minimises padding plus penalties; a monotone queue gives the best earlier cut within reach in constant time.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import text_of

END_ID = 1
SENTENCE_PENALTY = 6
INSIDE_PENALTY = 20
SEQUENCE_COST = 8
INSIDE_STEP = 64
# Tokens laid end to end before sequences are cut; the last of them ends at a document end.
TOKENS_AT_ONCE = 1 << 21

# Fixed value: the pattern by which byte-level BPE of this kind splits text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

def _byte_names() -> dict[str, int]:
    """Characters that stand for bytes in vocabulary files: printable ones for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class TextEncoder:
    """Token ids as the tokenizers library gives them for a byte-level BPE file.

    The file's vocabulary is in merge order, so it serves as ranks for a faster encoder of the same kind.  Texts that
    hold the string of an added token go to the library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        added = [x["content"] for x in held.get("added_tokens", [])]
        names = _byte_names()
        ranks = {bytes(names[c] for c in token): rank for token, rank in held["model"]["vocab"].items() if token not in added}
        self.ranked = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.added = regex.compile("|".join(map(regex.escape, added)) or r"(?!)")
        self.library = Tokenizer.from_file(path)
        size = 1 + max([*ranks.values(), *(x["id"] for x in held.get("added_tokens", []))])
        self.ends_line, self.ends_sentence, self.starts_gap = (np.zeros(size, bool) for _ in range(3))
        for token, rank in ranks.items():
            self.ends_line[rank] = token.endswith(b"\n")
            self.ends_sentence[rank] = token.endswith((b".", b"!", b"?"))
            self.starts_gap[rank] = token[:1].isspace()

    def encode(self, text: str) -> np.ndarray:
        if self.added.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        return np.frombuffer(array("I", self.ranked.encode_ordinary(text)), np.uint32)

    def sentence_ends(self, ids: np.ndarray) -> np.ndarray:
        """Numbers of tokens after which a sentence or a line has ended."""
        ended = self.ends_line[ids]
        ended[:-1] |= self.ends_sentence[ids[:-1]] & self.starts_gap[ids[1:]]
        return np.flatnonzero(ended) + 1


@lru_cache(maxsize=2)
def text_encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


def best_cuts(at: np.ndarray, penalty: np.ndarray, length: int) -> list[int]:
    """Places (indices of ``at``, the first and last included) between which sequences lie.

    ``at`` holds rising token counts from 0 with steps of at most ``length``.  A sequence costs its padding (none if its
    size is a power of two), a constant, and the penalty of its end.
    """
    places, price, count = at.tolist(), (penalty + SEQUENCE_COST).tolist(), len(at)
    ends, begins = [], []
    for power in range(length.bit_length()):
        before = at - (1 << power)
        index = np.minimum(np.searchsorted(at, before), count - 1)
        ends.append(np.flatnonzero(at[index] == before))
        begins.append(index[ends[-1]])
    order = np.argsort(np.concatenate(ends), kind="stable")
    exact_end = [*np.concatenate(ends)[order].tolist(), count]
    exact_begin = np.concatenate(begins)[order].tolist()
    exact = 0
    cost, prev = [0.0], [0]
    # The queue: places from ``head`` on, with rising cost + place; only its front can be the best begin.
    queue, queued, head = [0], [0.0], 0
    for j in range(1, count):
        place = places[j]
        while places[queue[head]] < place - length:
            head += 1
        source, best = queue[head], queued[head] + length - place
        while exact_end[exact] == j:
            if cost[exact_begin[exact]] < best:
                source = exact_begin[exact]
                best = cost[source]
            exact += 1
        best += price[j]
        cost.append(best)
        prev.append(source)
        best += place
        while len(queue) > head and queued[-1] >= best:
            queue.pop()
            queued.pop()
        queue.append(j)
        queued.append(best)
    cuts = [count - 1]
    while cuts[-1]:
        cuts.append(prev[cuts[-1]])
    return cuts[::-1]


def cut_places(ids: list[np.ndarray], encoder: TextEncoder, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Allowed ends of sequences over documents laid end to end, and their penalties."""
    ends = np.cumsum([len(x) for x in ids])
    starts = ends - [len(x) for x in ids]
    inside = [s + np.arange(step, len(x), step) for s, x in zip(starts, ids) for step in (min(INSIDE_STEP, length),)]
    sentences = [s + encoder.sentence_ends(x) for s, x in zip(starts, ids)]
    at = np.concatenate([[0], ends, *sentences, *inside]).astype(np.int64)
    penalty = np.concatenate(
        [np.zeros(1 + len(ends)), np.full(sum(map(len, sentences)), SENTENCE_PENALTY), np.full(sum(map(len, inside)), INSIDE_PENALTY)]
    )
    order = np.lexsort((penalty, at))
    at, penalty = at[order], penalty[order]
    first = np.concatenate(([True], at[1:] != at[:-1]))
    return at[first], penalty[first]


def pack(
    docs: DataFrame, tokenizer_path: str, length: int = 2048, end_id: int | None = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: identifier, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id`` and ``offset``.

    Documents keep the order of their identifiers (null first, then by a hash of the text).  A null text is empty
    and gives just ``end_id``; without an end id it gives no piece.  Each row is packed by itself, so repeated rows repeat.  A
    text of any length is cut as often as needed.  An empty table gives no rows; other columns are ignored.

    Range partitions are packed independently: each ends at a document end, which costs less than one sequence of padding.
    ``sequence_id`` rises in packing order and is unique, with gaps between partitions.
    """
    if length < 2:
        raise ValueError("a sequence holds at least two tokens")

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer_path)
        sequence = TaskContext.get().partitionId() << 40
        last = np.array([] if end_id is None else [end_id], "<u4")
        names, ids, size = [], [], 0

        def packed() -> pa.RecordBatch:
            nonlocal sequence
            at, penalty = cut_places(ids, encoder, length)
            windows = at[best_cuts(at, penalty, length)]
            ends = np.cumsum([len(x) for x in ids])
            starts = ends - [len(x) for x in ids]
            data = np.concatenate(ids)
            cuts = np.union1d(windows, ends)
            begin, end = cuts[:-1], cuts[1:]
            doc = np.searchsorted(ends, begin, side="right")
            window = np.searchsorted(windows, begin, side="right") - 1
            made = pa.RecordBatch.from_arrays(
                [
                    pa.array(names).take(pa.array(doc)),
                    pa.array(begin - starts[doc]),
                    pa.array(end - begin),
                    pa.array([data[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist())], pa.binary()),
                    pa.array((ends - starts)[doc]),
                    pa.array(window + sequence),
                    pa.array(begin - windows[window]),
                ],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )
            sequence += len(windows) - 1
            return made

        for batch in found:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = np.concatenate((encoder.encode(text.as_py()), last))
                if len(tokens):
                    names.append(name)
                    ids.append(tokens)
                    size += len(tokens)
                if size >= TOKENS_AT_ONCE:
                    yield packed()
                    names, ids, size = [], [], 0
        if ids:
            yield packed()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    ordered = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text")
    shape = "id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return ordered.mapInArrow(batches, shape).withColumnRenamed("id", id_col)

"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words is trained from confirmed toxic texts and unlabelled ones.  The risk of the
negative class is estimated from the unlabelled texts less the share that the class prior says is toxic, and is kept
from falling below zero.  Training uses a bounded sample; every whole text is scored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, text_of

# Bounds of the training sample, and size of the feature table.
MOST_POSITIVE = 3_000
MOST_UNLABELLED = 9_000
FEATURE_BITS = 18
# Beginnings of words, in bytes, that are features besides the words themselves.
BEGINNINGS = (5, 7)
MOST_TIMES = 15
# Features carry weight if they occur in this many sampled texts and differ by so many standard errors
# between the two samples.
LEAST_TEXTS = 4
LEAST_ERRORS = 5.0
EPOCHS = 60
BATCHES = 4
RATE = 0.05
DECAY = 1e-5
SEED = 7

_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
Row = tuple[np.ndarray, np.ndarray]


def features(text: str | None) -> Row:
    """Places of a whole text's words and word beginnings in the feature table, and how often each occurs."""
    if not text:
        return np.zeros(0, np.int32), np.zeros(0, np.uint8)
    times: dict[int, int] = {}
    last = (1 << FEATURE_BITS) - 1
    for word, n in Counter(_WORD.findall(text.encode("utf-8", "surrogatepass").lower())).items():
        place = zlib.crc32(word) & last
        times[place] = times.get(place, 0) + n
        for size in BEGINNINGS:
            if len(word) >= size:
                place = zlib.crc32(b"^" + word[:size]) & last
                times[place] = times.get(place, 0) + n
    places = np.fromiter(times.keys(), np.int32, len(times))
    return places, np.minimum(np.fromiter(times.values(), np.int64, len(times)), MOST_TIMES).astype(np.uint8)


# How much an occurrence count says.
_SIZES = np.log2(1.0 + np.arange(MOST_TIMES + 1))


class Batch:
    """Rows of features laid end to end."""

    def __init__(self, rows: list[Row]):
        self.count = len(rows)
        self.place = np.concatenate([r[0] for r in rows]).astype(np.int64)
        self.value = _SIZES[np.concatenate([r[1] for r in rows])]
        self.row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])

    def scores(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weight[self.place] * self.value, self.count) + weight[-1]

    def gradient(self, slope: np.ndarray, size: int) -> np.ndarray:
        found = np.bincount(self.place, slope[self.row] * self.value, size + 1).astype(np.float64)
        found[size] = slope.sum()
        return found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _telling(positive: Batch, unlabelled: Batch, size: int) -> np.ndarray:
    """Features whose mean value differs clearly between the samples."""
    p, u = positive.count, unlabelled.count
    in_p, in_u = (np.bincount(b.place, b.value, size) for b in (positive, unlabelled))
    squares = sum(np.bincount(b.place, b.value**2, size) for b in (positive, unlabelled))
    texts = sum(np.bincount(b.place, minlength=size) for b in (positive, unlabelled))
    spread = np.maximum(squares / (p + u) - ((in_p + in_u) / (p + u)) ** 2, 1e-12)
    return (np.abs(in_p / p - in_u / u) >= LEAST_ERRORS * np.sqrt(spread * (1 / p + 1 / u))) & (texts >= LEAST_TEXTS)


def nnpu_train(positive: list[Row], unlabelled: list[Row], prior: float) -> np.ndarray:
    """Weights, the bias last, that minimise the non-negative risk with sigmoid loss, by Adam over mixed batches.

    With loss l(z) = sigmoid(-z), the risk is prior * P[l(f)] + max(0, U[l(-f)] - prior * P[l(-f)]).  Where the
    second part is negative in a batch, the step goes up that part instead, as the method prescribes.
    """
    size = 1 << FEATURE_BITS
    telling = _telling(Batch(positive), Batch(unlabelled), size)
    positive, unlabelled = ([(k[telling[k]], n[telling[k]]) for k, n in rows] for rows in (positive, unlabelled))
    rng = np.random.default_rng(SEED)
    weight = np.zeros(size + 1)
    weight[size] = np.log(prior / (1 - prior))
    first, second, step = np.zeros(size + 1), np.zeros(size + 1), 0
    for _ in range(EPOCHS):
        of_p, of_u = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
        for part in range(BATCHES):
            chosen_p, chosen_u = of_p[part::BATCHES], of_u[part::BATCHES]
            if not len(chosen_p) or not len(chosen_u):
                continue
            p, u = Batch([positive[i] for i in chosen_p]), Batch([unlabelled[i] for i in chosen_u])
            s_p, s_u = _sigmoid(p.scores(weight)), _sigmoid(u.scores(weight))
            # l(f) = 1 - s and l(-f) = s; both slopes are s * (1 - s).
            slope_p, slope_u = s_p * (1 - s_p) / p.count, s_u * (1 - s_u) / u.count
            if s_u.mean() >= prior * s_p.mean():
                grad = p.gradient(-2 * prior * slope_p, size) + u.gradient(slope_u, size)
            else:
                grad = p.gradient(prior * slope_p, size) - u.gradient(slope_u, size)
            grad[:size] += DECAY * weight[:size]
            step += 1
            first = 0.9 * first + 0.1 * grad
            second = 0.999 * second + 0.001 * grad * grad
            weight -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weight.astype(np.float32)


def _sampled(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` identifiers, in the order of a hash: the same ones on every run."""
    return ids.orderBy(F.xxhash64("id"), "id").limit(most)


def train(
    docs: DataFrame, labels: DataFrame, for_training: Column, id_col: str = "doc_id", text_col: str = "text"
) -> np.ndarray:
    """Weights, fitted on at most ``MOST_POSITIVE`` texts confirmed as toxic and ``MOST_UNLABELLED`` others, whatever their labels.

    ``for_training`` is a condition on ``id_col`` and holds for both sides.  The class prior is the toxic share of all
    labelled identifiers that pass it.  Without toxic or unlabelled texts every score is 0.
    """
    known = labels.where(for_training).where(f"{id_col} IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").alias("toxic"))
    rated, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0))).first()
    nothing = np.zeros((1 << FEATURE_BITS) + 1, np.float32)
    nothing[-1] = -40.0
    if not toxic:
        return nothing
    prior = min(max(toxic / rated, 1e-4), 0.9)
    ids = docs.where(for_training).select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct()
    chosen = _sampled(known.where("toxic = 1").select("id"), MOST_POSITIVE).withColumn("positive", F.lit(True))
    chosen = chosen.union(_sampled(ids, MOST_UNLABELLED).withColumn("positive", F.lit(False)))

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            rows = [features(t.as_py()) for t in batch.column(1)]
            columns = [pa.array([r[k].tobytes() for r in rows], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["positive", "places", "times"])

    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    # At most MOST_POSITIVE + MOST_UNLABELLED identifiers are broadcast.
    met = texts.join(F.broadcast(chosen), "id").select("positive", "text")
    sample = met.mapInArrow(batches, "positive boolean, places binary, times binary").toArrow()
    held = sorted(zip(*(sample.column(c).to_pylist() for c in ("positive", "places", "times"))))  # whatever order tasks end in
    rows = [(m, (np.frombuffer(k, np.int32), np.frombuffer(n, np.uint8))) for m, k, n in held]
    positive, unlabelled = ([r for m, r in rows if m is mark] for mark in (True, False))
    if not positive or not unlabelled:
        return nothing
    return nnpu_train(positive, unlabelled, prior)


def score(docs: DataFrame, weight: np.ndarray, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``toxic_score`` between 0 and 1.  Null and empty texts get the bias alone."""
    if "toxic_score" in docs.columns:
        raise ValueError("the table already has a column toxic_score")
    shared = docs.sparkSession.sparkContext.broadcast(weight)
    place = docs.columns.index(text_col)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, sizes = shared.value, _SIZES.astype(np.float32)
        for batch in slices(found):
            sums = []
            for text in batch.column(place):
                places, times = features(text.as_py())
                sums.append(float(weight[places] @ sizes[times]) + float(weight[-1]))
            yield batch.append_column("toxic_score", pa.array(_sigmoid(np.array(sums)), pa.float64()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(batches, f"{fields}, toxic_score double")


def toxicity(docs: DataFrame, labels: DataFrame, for_training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: identifier, ``score`` and ``predicted`` (1 from 0.5 on).

    Repeated rows give repeated rows, null identifiers are scored but never learned from, an empty table gives no rows and
    other columns are ignored.
    """
    weight = train(docs, labels, for_training, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return score(rows, weight).select(
        F.col("id").alias(id_col), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted")
    )

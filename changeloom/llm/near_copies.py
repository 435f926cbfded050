"""Near copies by the similarity of their word shingles.

Candidates come from two places.  The Gray-order index over SimHash fingerprints of the shingles finds close copies, whole families of
them at once; its fingerprints are too short to find a similarity of 0.8 surely.  Therefore each text also gets minimum
hashes of its set of word shingles, taken in bands, and texts that agree in a whole band are candidates too.  A pair of candidates is linked only if the exact Jaccard similarity of the two shingle sets reaches
the threshold, so fingerprints and bands decide what is compared and never what is a copy.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_key_join
from .common import slices, stored, temporary, words_of
from .graph import components, united
from .simhash import SEED, code_links, fingerprints

# Bands and their depth.  A pair of similarity s agrees in some band with probability 1 - (1 - s**depth)**bands: 0.9996 at 0.8 for
# the first row, 0.996 at 0.8 and 0.99997 at 0.85 for the second, which only texts meet whose buckets stay large and in several groups.
LEVELS = ((20, 5), (48, 10))
# Within buckets of at most so many texts all pairs are compared; in larger ones all texts meet pivots first.
SMALL = 4
PIVOT_ROUNDS = 2
# Tasks over which the pairs of a text, or of a bucket, that is frequent are spread; what they meet is copied so often.
SPREAD = 32
# Of a bucket whose texts are all compared, so many meet the whole bucket in one task; a piece of fewer would only copy the bucket more often.
BUCKET_PIECE = 1 << 10
# Identifiers that are broadcast to pick out texts: at most so many numbers, some megabytes.
HELD_IDS = 1 << 18
# Differing bits up to which the Gray-order index takes fingerprints together.
CLOSE_BITS = 4

# Sketches of sets of similarity 0.8 differ in more than so many of their 1,024 bits with probability below 0.00001 (a tenth do, 4.5 deviations).
SKETCH_WORDS = 16
SKETCH_BITS = 145
HASHES_AT_ONCE = 1 << 13
TEXTS_AT_ONCE = 256


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word shingles: one shingle if the words are too few, the empty one without words."""
    words = words_of(text)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words] or [1]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = max(1, min(shingle, len(words)))
    spans = zip(starts[: len(ends) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.array(sorted({xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans}), np.uint64)


@lru_cache(maxsize=4)
def _functions(bands: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    random = np.random.default_rng((SEED, bands, depth))
    flips = random.integers(0, 1 << 64, (bands, depth, 1), np.uint64)
    factors, mixers = (random.integers(0, 1 << 63, (bands, depth, n), np.uint64) * np.uint64(2) + np.uint64(1) for n in (1, 1))
    return flips, factors, mixers[:, :, 0]


def band_keys(hashes: np.ndarray, bands: int, depth: int) -> np.ndarray:
    """One number per band, of the minimum hashes in it."""
    flips, factors, mixers = _functions(bands, depth)
    keys = np.empty(bands, np.uint64)
    for band in range(bands):
        least = np.full(depth, ~np.uint64(0))
        for at in range(0, len(hashes), HASHES_AT_ONCE):
            np.minimum(least, ((hashes[at : at + HASHES_AT_ONCE] ^ flips[band]) * factors[band]).min(1), out=least)
        mixed = (least ^ (least >> np.uint64(32))) * mixers[band]
        keys[band] = ((mixed ^ (mixed >> np.uint64(29))).sum(dtype=np.uint64, keepdims=True) * mixers[band, :1])[0]
    return keys


def sketch(hashes: np.ndarray) -> np.ndarray:
    """SKETCH_WORDS numbers with one bit of each of 64 minimum hashes.  Bits of two sets differ with probability (1 - similarity) / 2."""
    flips, factors, mixers = _functions(SKETCH_WORDS, 64)
    words = np.empty(SKETCH_WORDS, np.uint64)
    for i in range(SKETCH_WORDS):
        least = np.full(64, ~np.uint64(0))
        for at in range(0, len(hashes), HASHES_AT_ONCE):
            np.minimum(least, ((hashes[at : at + HASHES_AT_ONCE] ^ flips[i]) * factors[i]).min(1), out=least)
        mixed = (least ^ (least >> np.uint64(32))) * mixers[i]
        words[i] = np.packbits((mixed >> np.uint64(63)).astype(bool), bitorder="little").view("<u8")[0]
    return words


def _sketches(texts: DataFrame, shingle: int) -> DataFrame:
    """``id, sketch`` of rows ``id, text``."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(found, TEXTS_AT_ONCE):
            made = [sketch(shingle_set(t.as_py(), shingle)).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.int64()))], ["id", "sketch"])

    return texts.mapInArrow(batches, "id bigint, sketch array<bigint>")


def _buckets(texts: DataFrame, shingle: int, bands: int, depth: int) -> DataFrame:
    """``id, size, keys`` per text, with a key for each band, of rows ``id, text``."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(found, TEXTS_AT_ONCE):
            sets = [shingle_set(t.as_py(), shingle) for t in batch.column(1)]
            keys = np.concatenate([band_keys(s, bands, depth) for s in sets]) if sets else np.empty(0, np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) + 1, bands), pa.int32()), pa.array(keys.view(np.int64)))
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, lists], ["id", "size", "keys"])

    return texts.mapInArrow(batches, "id bigint, size bigint, keys array<bigint>")


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``id, shingles`` of rows ``id, text``."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(found, TEXTS_AT_ONCE):
            sets = [pa.array(shingle_set(t.as_py(), shingle).view(np.int64)) for t in batch.column(1)]
            column = pa.array([s.to_numpy() for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], ["id", "shingles"])

    return texts.mapInArrow(batches, "id bigint, shingles array<bigint>")


def _some(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of distinct ``ids``: up to HELD_IDS of them are broadcast, for more the texts are shuffled."""
    return texts.join(F.broadcast(ids) if ids.count() <= HELD_IDS else ids.hint("merge"), "id", "left_semi")


def similar(texts: DataFrame, pairs: DataFrame, shingle: int, share: tuple[int, int]) -> DataFrame:
    """Those pairs ``u, v`` whose shingle sets have a Jaccard similarity of ``share`` (a fraction) or more."""
    part, whole = share
    ids = stored(pairs.select(F.col("u").alias("id")).distinct().union(pairs.select("v").distinct()).distinct(), "near-ids")
    sets = stored(_sets(_some(texts, ids), shingle), "near-sets")
    # Sets are far larger in memory than as files, so they are never broadcast.
    met = hot_key_join(pairs, sets.toDF("u", "left").hint("merge"), ["u"], "inner", SPREAD)
    met = hot_key_join(met, sets.toDF("v", "right").hint("merge"), ["v"], "inner", SPREAD)
    both = F.size(F.array_intersect("left", "right"))
    return met.where(both * (part + whole) >= (F.size("left") + F.size("right")) * part).select("u", "v")


def close_copies(texts: DataFrame, shingle: int, bits: int) -> DataFrame:
    """Candidates ``u, v`` by SimHash: texts of one fingerprint with the first of them, and what the Gray-order index links."""
    codes = stored(fingerprints(texts, shingle, "id"), "near-codes")
    classes = stored(codes.groupBy("code").agg(F.min("id").alias("least")), "near-classes")
    equal = hot_key_join(codes, classes.hint("merge"), ["code"], "inner").where("id <> least").select(F.col("least").alias("u"), F.col("id").alias("v"))
    linked = code_links(classes, bits).select(F.col("u").alias("code"), F.col("v").alias("other"))
    linked = linked.join(classes.hint("merge"), "code").select("other", F.col("least").alias("one"))
    linked = hot_key_join(linked, classes.toDF("other", "two").hint("merge"), ["other"], "inner")
    return equal.union(linked.select(*_ordered("one", "two")))


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def _named(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows``, one per text, with ``root``, the group of ``id``.

    A text is named once and not once for each of its buckets: those are as many as there are bands.
    """
    met = rows.join(groups.withColumnRenamed("node", "id").hint("merge"), "id", "left")
    return met.withColumn("root", F.coalesce("root", "id"))


def _by_bucket(texts: DataFrame) -> DataFrame:
    """``id, size, key, root`` for each key of rows ``id, size, keys, root``."""
    return texts.select("id", "size", F.explode("keys").alias("key"), "root")


class _Search:
    """Groups found so far, and the pairs that were compared for them."""

    def __init__(self, texts: DataFrame, shingle: int, share: tuple[int, int]):
        self.texts, self.shingle, self.share = texts, shingle, share
        self.groups = self.tested = None

    def alike(self, a: str, b: str):
        """Sets of such sizes can be similar enough."""
        part, whole = self.share
        return F.least(a, b) * whole >= F.greatest(a, b) * part

    def compare(self, pairs: DataFrame) -> None:
        """Compare pairs ``u, v`` that were not compared before and join the groups of those that are similar."""
        fresh = pairs.distinct()
        if self.tested is not None:
            fresh = fresh.join(self.tested.hint("merge"), ["u", "v"], "left_anti")
        fresh = stored(fresh, "near-pairs")
        links = stored(similar(self.texts, fresh, self.shingle, self.share), "near-links")
        self.tested = fresh if self.tested is None else self.tested.union(fresh)
        if self.groups is None:
            self.groups = stored(components(links), "near-groups")
        elif not links.isEmpty():
            self.groups = united(self.groups, links)

    def starred(self, rows: DataFrame) -> DataFrame:
        """Texts of a bucket with its pivot, where their groups differ."""
        apart = (F.col("id") != F.col("pivot.id")) & (F.col("root") != F.col("pivot.root"))
        return rows.where(apart & self.alike("size", "pivot.size")).select(*_ordered("id", "pivot.id"))

    def buckets(self, texts: DataFrame, bands: int, depth: int, more: DataFrame | None = None) -> DataFrame | None:
        """Compare texts that agree in a band, and pairs ``more``; return ``id, size, key, root`` of large buckets still in several groups."""
        keys = stored(_buckets(texts, self.shingle, bands, depth), "near-keys")
        keys = _by_bucket(keys.withColumn("root", F.col("id")) if self.groups is None else stored(_named(keys, self.groups), "near-keys"))
        counts = keys.groupBy("key").agg(
            F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"), F.min(F.struct("id", "size", "root")).alias("pivot")
        )
        counts = counts.where("low < high").select("key", "n", "pivot")
        met = stored(hot_key_join(keys, counts.hint("merge"), ["key"], "inner").select(*keys.columns, "n", "pivot"), "near-buckets")
        held = met.where(F.col("n") <= SMALL).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("id", "size", "root"))).alias("texts"))
        firsts = held.select(F.posexplode("texts").alias("at", "a"), "texts")
        pairs = firsts.select("a", F.explode(F.expr("slice(texts, at + 2, size(texts))")).alias("b")).where("a.root <> b.root")
        pairs = pairs.where(self.alike("a.size", "b.size")).select(F.col("a.id").alias("u"), F.col("b.id").alias("v"))
        large = met.where(F.col("n") > SMALL)
        pairs = pairs.union(self.starred(large))
        self.compare(pairs if more is None else pairs.union(more))
        large = large.select("id", "size", "key")
        for turn in range(PIVOT_ROUNDS):
            listed = large.groupBy("id", "size").agg(F.collect_list("key").alias("keys"))
            named = _by_bucket(stored(_named(listed, self.groups), "near-named"))
            open_ = named.groupBy("key").agg(
                F.min("root").alias("low"), F.max("root").alias("high"),
                F.min(F.struct(F.xxhash64("root", F.lit(turn)), F.xxhash64("id", F.lit(turn)), "id", "size", "root")).alias("pivot"),
            ).where("low < high").select("key", "pivot")
            large = stored(hot_key_join(named, open_.hint("merge"), ["key"], "inner").select("id", "size", "key", "root", "pivot"), "near-open")
            if large.isEmpty():
                return None
            if turn < PIVOT_ROUNDS - 1:
                self.compare(self.starred(large))
                large = large.select("id", "size", "key")
        return large.select("id", "size", "key", "root")

    def all_pairs(self, large: DataFrame) -> None:
        """Compare all texts of a bucket that are in different groups and whose sketches are not too far apart."""
        some = _some(self.texts, stored(large.select("id").distinct(), "near-ids"))
        sketches = stored(_sketches(some, self.shingle), "near-sketches")
        large = hot_key_join(large, sketches.hint("merge"), ["id"], "inner")
        words = [F.col("sketch")[i].alias(f"word{i}") for i in range(SKETCH_WORDS)]
        large = stored(large.select("id", "size", "key", "root", *words), "near-open")
        a, b = (large.select("key", *[F.col(c).alias(c + x) for c in large.columns if c != "key"]) for x in "ab")
        differ = sum(F.bit_count(F.col(f"word{i}a").bitwiseXOR(F.col(f"word{i}b"))) for i in range(SKETCH_WORDS))
        near = (F.col("ida") < F.col("idb")) & (F.col("roota") != F.col("rootb")) & (differ <= SKETCH_BITS) & self.alike("sizea", "sizeb")
        met = hot_key_join(a, b.hint("merge"), ["key"], "inner", SPREAD, BUCKET_PIECE).where(near)
        self.compare(met.select(F.col("ida").alias("u"), F.col("idb").alias("v")))


def near_groups(texts: DataFrame, shingle: int = 5, share: tuple[int, int] = (4, 5)) -> DataFrame:
    """``node, root`` for rows ``id, text`` with distinct numbers as ``id`` that have a near copy.

    Two texts are near copies when the Jaccard similarity of their word shingles is ``share`` or more; ``root`` is the smallest
    ``id`` reached over any number of near copies.  Texts without words are copies of each other.  An empty table gives none.

    Of small buckets all pairs are compared.  In a large one all texts that are in another group than a pivot meet
    it, which joins a family of copies in linear time.  Texts of large buckets that are still in several groups go to deeper bands among
    themselves; what those leave is compared pair by pair, first by sketches of 1,024 bits.  No bucket is cut and no pair capped.
    """
    search = _Search(texts.select("id", "text"), shingle, share)
    with temporary() as tables:
        _run(search)
        return tables.kept(search.groups, "near-groups")


def _run(search: _Search) -> None:
    texts, shingle, left = search.texts, search.shingle, None
    for bands, depth in LEVELS:
        if left is None:
            left = search.buckets(texts, bands, depth, close_copies(texts, shingle, CLOSE_BITS))
        else:
            some = _some(texts, stored(left.select("id").distinct(), "near-ids"))
            left = search.buckets(some, bands, depth)
        if left is None:
            return
    search.all_pairs(left)

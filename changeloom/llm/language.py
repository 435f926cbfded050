"""Language identification by prediction by partial matching.

For each language, counts of byte strings form a context tree: contexts of zero to three bytes with the bytes that follow them.  A byte
costs -log2 of its probability in the longest known context; an unknown byte first pays the escape of that context and
then is looked for in the next shorter one.  Counts come from all training texts and are frozen; the language with the shortest
code length wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

ORDER = 3
# Strings of each length that tasks hold in memory; where there are more, the costs of the rarer ones are joined, not left out.
MOST_STRINGS = 1 << 20
BYTES_AT_ONCE = 1 << 21
UNKNOWN = "und"
# Bits for a byte that no context knows.
UNIFORM_BITS = 8.0

_LETTER = regex.compile(r"\p{L}")


def _strings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte with the three before it (zero bytes before the start), and the number of bytes of each text."""
    gap = bytes(ORDER)
    data = np.frombuffer(gap + gap.join(texts), np.uint8).astype(np.uint32)
    sizes = np.array([len(t) for t in texts])
    keys = data[ORDER:] | data[2:-1] << np.uint32(8) | data[1:-2] << np.uint32(16) | data[:-3] << np.uint32(24)
    own = np.ones(len(keys), bool)
    ends = np.cumsum(sizes + ORDER) - ORDER
    for shift in range(ORDER):
        own[ends[:-1] + shift] = False
    return keys[own], sizes


def _portions(texts: Iterator[bytes], most: int) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def count_strings(docs: DataFrame) -> DataFrame:
    """``lang, key, n`` for the 4-byte strings of columns ``lang, text``; added up per task before the exchange."""

    def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[heads], np.add.reduceat(counts, heads)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in found:
            langs = batch.column(0).to_pylist()
            for lang in sorted(set(langs)):
                texts = (_bytes(t.as_py()) for t, x in zip(batch.column(1), langs) if x == lang)
                for part in _portions(texts, BYTES_AT_ONCE):
                    keys, _ = _strings(part)
                    if len(keys):
                        held.setdefault(lang, []).append(np.unique(keys, return_counts=True))
                if len(held.get(lang, ())) > 8:
                    held[lang] = [merge(held[lang])]
        for lang, parts in held.items():
            keys, counts = merge(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))], ["lang", "key", "n"])

    counted = docs.select("lang", "text").mapInArrow(batches, "lang string, key bigint, n bigint")
    return counted.groupBy("lang", "key").agg(F.sum("n").alias("n"))


class Trees:
    """Frozen code lengths, per order: known strings with their bits per language, known contexts with their escape bits."""

    def __init__(self, langs: list[str], tables: list[tuple[np.ndarray, ...]]):
        """``tables[k]``: language number, string of k + 1 bytes, its count, and of its context the count and number of followers."""
        self.langs = langs
        self.keys, self.bits, self.contexts, self.escapes = [], [], [], []
        for k, (lang, key, n, total, followers) in enumerate(tables):
            contexts, at = np.unique(key >> 8, return_inverse=True)
            escape = np.zeros((len(langs), len(contexts)))
            escape[lang, at] = np.log2((total + followers) / followers)
            self.contexts.append(contexts)
            self.escapes.append(escape)
            keys, at = np.unique(key, return_inverse=True)
            bits = self._lower(k, keys)
            bits[lang, at] = np.log2((total + followers) / n)
            self.keys.append(keys)
            self.bits.append(bits)

    def _lower(self, k: int, keys: np.ndarray) -> np.ndarray:
        """Bits of strings unknown at order ``k``: the escape of their context, then the shorter string."""
        escape = _look_up(self.contexts[k], self.escapes[k], keys >> 8, lambda missed: 0.0)
        if k == 0:
            return escape + UNIFORM_BITS
        return escape + self.cost(k - 1, keys & ((1 << 8 * k) - 1))

    def cost(self, k: int, keys: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each string of ``k + 1`` bytes, per language."""
        return _look_up(self.keys[k], self.bits[k], keys, lambda missed: self._lower(k, missed))


def _look_up(known: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise) -> np.ndarray:
    if not len(known):
        return np.zeros((len(values), len(wanted))) + otherwise(wanted)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    found = values[:, at]
    missed = known[at] != wanted
    if missed.any():
        found[:, missed] = otherwise(wanted[missed])
    return found


def _order(counts: DataFrame, k: int) -> DataFrame:
    """``lang, key, n, total, followers`` of the strings of ``k + 1`` bytes."""
    key = F.col("key").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))
    strings = counts.groupBy("lang", key.alias("key")).agg(F.sum("n").alias("n"))
    context = Window.partitionBy("lang", F.shiftright("key", 8))
    return strings.withColumn("total", F.sum("n").over(context)).withColumn("followers", F.count(F.lit(1)).over(context))


def _trees(langs: list[str], orders: list[DataFrame]) -> Trees:
    number = {lang: i for i, lang in enumerate(langs)}
    tables = []
    for strings in orders:
        table = strings.toArrow()
        lang = np.array([number[x] for x in table.column("lang").to_pylist()], np.int64)
        tables.append((lang, *[table.column(c).to_numpy() for c in ("key", "n", "total", "followers")]))
    return Trees(langs, tables)


def _costs(keys: DataFrame, langs: list[str], orders: list[DataFrame]) -> DataFrame:
    """``key, bits`` for distinct 4-byte strings ``key``: bits per language in the order of ``langs``, from all counted strings."""
    wanted = [keys.select("key")]
    for k in reversed(range(ORDER)):
        wanted.insert(0, wanted[0].select(F.col("key").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("key")).distinct())
    every = F.explode(F.array(*[F.lit(x) for x in langs]))
    lower = None
    for k, strings in enumerate(orders):
        known = strings.select("lang", "key", F.log2((F.col("total") + F.col("followers")) / F.col("n")).alias("known"))
        context = strings.select("lang", F.shiftright("key", 8).alias("context"), F.log2((F.col("total") + F.col("followers")) / F.col("followers")).alias("escape"))
        met = wanted[k].select("key", every.alias("lang"), F.shiftright("key", 8).alias("context"))
        met = met.join(known, ["lang", "key"], "left").join(context.distinct(), ["lang", "context"], "left")
        if k == 0:
            met = met.withColumn("below", F.lit(UNIFORM_BITS))
        else:
            met = met.withColumn("short", F.col("key").bitwiseAND(F.lit((1 << 8 * k) - 1)))
            met = met.join(lower.select(F.col("key").alias("short"), "lang", F.col("bits").alias("below")), ["short", "lang"])
        bits = F.coalesce("known", F.coalesce("escape", F.lit(0.0)) + F.col("below"))
        lower = stored(met.select("key", "lang", bits.alias("bits")), "language-costs")
    rows = F.sort_array(F.collect_list(F.struct("lang", "bits")))
    return lower.groupBy("key").agg(rows.getField("bits").alias("bits"))


def _winner(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shortest code of each column, and its share of the probability."""
    return total.argmin(0), 1 / np.exp2(np.maximum(total.min(0) - total, -1000)).sum(0)


def identify(
    docs: DataFrame, for_training: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = MOST_STRINGS
) -> DataFrame:
    """One row per input row: identifier, ``lang_pred`` and ``score``, the winner's share of the probability of the text.

    Learns from rows that pass ``for_training`` and have a language.  A null text, or one without a letter, gets ``und`` and
    score 0, and so does every text when there is nothing to learn from.  Ties go to the name that sorts first.
    Repeated rows give repeated rows; null identifiers stay null; other columns are ignored.  ``most`` bounds the strings a task
    holds and does not change results.
    """
    learned = docs.where(for_training).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = stored(count_strings(learned.where("lang IS NOT NULL")), "language-counts")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    orders = [stored(_order(counts, k), "language-order") for k in range(ORDER + 1)]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # The strings of the longest order are the most numerous.
    if orders[ORDER].count() > most:
        return _identify_joined(rows, langs, orders, most).withColumnRenamed("id", id_col)
    trees = _trees(langs, orders)
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in found:
            texts = [t.as_py() for t in batch.column(1)]
            known = [i for i, t in enumerate(texts) if trees.langs and t and _LETTER.search(t)]
            names, scores, done = [UNKNOWN] * len(texts), np.zeros(len(texts)), 0
            for part in _portions((_bytes(texts[i]) for i in known), BYTES_AT_ONCE // 4):
                keys, sizes = _strings(part)
                starts = np.cumsum(sizes) - sizes
                total = np.add.reduceat(trees.cost(ORDER, keys.astype(np.int64)), starts, axis=1)
                best, share = _winner(total)
                for j, i in enumerate(known[done : done + len(part)]):
                    names[i], scores[i] = trees.langs[best[j]], share[j]
                done += len(part)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)], ["id", "lang_pred", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def _identify_joined(rows: DataFrame, langs: list[str], orders: list[DataFrame], most: int) -> DataFrame:
    """The same for trees that are too large for a task: costs of the texts' frequent strings are held, those of others joined."""
    texts = rows.select(F.lit("").alias("lang"), "text")
    found = stored(count_strings(texts).select("key", "n"), "language-found")
    costs = stored(_costs(found, langs, orders), "language-bits")
    held = found.orderBy(F.desc("n"), "key").limit(max(1, most // len(langs))).select("key")
    table = costs.join(held, "key").orderBy("key").toArrow()
    known = table.column("key").to_numpy().astype(np.int64)
    bits = np.array(table.column("bits").to_pylist(), float).reshape(-1, len(langs)).T
    shared = rows.sparkSession.sparkContext.broadcast((known, bits))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = shared.value
        for batch in batches:
            sums, keys, counts = [], [], []
            for text in batch.column(2):
                text = text.as_py()
                if not text or not _LETTER.search(text):
                    sums.append(None)
                    keys.append([])
                    counts.append([])
                    continue
                key, n = np.unique(_strings([_bytes(text)])[0].astype(np.int64), return_counts=True)
                at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                met = known[at] == key
                sums.append((bits[:, at[met]] * n[met]).sum(1))
                keys.append(key[~met])
                counts.append(n[~met])
            columns = [pa.array(sums, pa.list_(pa.float64())), pa.array(keys, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["row", "id", "sums", "keys", "counts"])

    kind = rows.schema["id"].dataType.simpleString()
    shape = f"row bigint, id {kind}, sums array<double>, keys array<bigint>, counts array<bigint>"
    parts = stored(rows.select(F.monotonically_increasing_id().alias("row"), "id", "text").mapInArrow(partial, shape), "language-parts")
    rare = parts.select("row", F.explode(F.arrays_zip("keys", "counts")).alias("x")).select("row", F.col("x.keys").alias("key"), F.col("x.counts").alias("n"))
    each = [F.sum(F.col("bits")[i] * F.col("n")) for i in range(len(langs))]
    more = rare.join(costs, "key").groupBy("row").agg(F.array(*each).alias("more"))
    whole = parts.select("row", "id", "sums").join(more, "row", "left").select("id", "sums", "more")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            for i, (sums, more) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                if sums is not None:
                    best, share = _winner((np.array(sums) + (more if more is not None else 0.0))[:, None])
                    names[i], scores[i] = langs[best[0]], share[0]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)], ["id", "lang_pred", "score"])

    return whole.mapInArrow(settle, f"id {kind}, lang_pred string, score double")

"""Scoring of texts with a gated recurrent language model.

Word counts of all training texts give the vocabulary.  A small GRU is trained by truncated backpropagation in numpy: each
task trains on its documents from the shared parameters, and the results are averaged, round by round, until every
training document has been seen once.  The output softmax is factored by word class.  The state is carried across windows, so
the score is the log-likelihood of the complete document.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# Sizes of the model: words it tells apart, classes, state.  All further words share one output; which of them it is follows
# their counts.
CLASSES = 32
CLASS_SIZE = 64
WORDS = CLASSES * CLASS_SIZE
STATE = 16
# Most frequent words whose counts every task knows; the counts of all others are joined.
HEAD = 1 << 17
LANES = 128
SCORE_LANES = 512
WINDOW = 32
ROUNDS = 3
RATE = 0.01
SMOOTH = 0.5
# Bytes of text that are split into words at a time; the last text may go beyond.
SPLIT_AT_ONCE = 1 << 23
CHUNK = 1 << 13
SLOTS = 256


class Network:
    """Parameters as views of one flat array.  Word 0 is the end of a text, ``WORDS`` is any other word."""

    SHAPES = {
        "wx": (WORDS + 1, 3 * STATE), "wh": (STATE, 3 * STATE), "wc": (STATE, CLASSES + 1), "bc": (CLASSES + 1,),
        "wo": (CLASSES, STATE, CLASS_SIZE), "bo": (CLASSES, CLASS_SIZE),
    }

    def __init__(self, flat: np.ndarray | None = None):
        sizes = [int(np.prod(s)) for s in self.SHAPES.values()]
        self.flat = np.zeros(sum(sizes), np.float32) if flat is None else flat
        at = 0
        for (name, shape), size in zip(self.SHAPES.items(), sizes):
            setattr(self, name, self.flat[at : at + size].reshape(shape))
            at += size

    @classmethod
    def initial(cls, counts: np.ndarray, others: float) -> Network:
        """Small random weights; biases that give the unigram distribution."""
        made, rng = cls(), np.random.default_rng(11)
        for name, scale in (("wx", 0.3), ("wh", STATE**-0.5), ("wc", 0.1), ("wo", 0.1)):
            view = getattr(made, name)
            view[...] = rng.normal(0, scale, view.shape)
        held = (counts + SMOOTH).reshape(CLASSES, CLASS_SIZE)
        made.bo[...] = np.log(held)
        made.bc[...] = np.log(np.append(held.sum(1), others + SMOOTH))
        made.bc[...] -= made.bc.max()
        return made

    def forward(self, tokens: np.ndarray, begins: np.ndarray, state: np.ndarray):
        """States after reading each row of ``tokens`` (steps x lanes); ``begins`` marks texts that start there.

        Inside, lanes are the last axis: gates are whole blocks of memory then, and each step runs over long rows.
        """
        steps, lanes = tokens.shape
        states = np.empty((steps + 1, STATE, lanes), np.float32)
        states[0] = state.T
        # The first two gates with their signs turned, for 1 / (1 + exp(-x)).
        read, wh = np.take(self.wx, tokens, axis=0).transpose(0, 2, 1), np.ascontiguousarray(self.wh.T)
        gates, from_h = np.empty((steps, 3 * STATE, lanes), wh.dtype), np.empty((steps, 3 * STATE, lanes), wh.dtype)
        np.negative(read[:, : 2 * STATE], out=gates[:, : 2 * STATE])
        gates[:, 2 * STATE :] = read[:, 2 * STATE :]
        wh[: 2 * STATE] *= -1
        before, going = np.empty((steps, STATE, lanes), np.float32), (~begins).astype(np.float32)
        for t in range(steps):
            h = np.multiply(states[t], going[t], out=before[t])
            np.matmul(wh, h, out=from_h[t])
            zr, n = gates[t, : 2 * STATE], gates[t, 2 * STATE :]
            zr += from_h[t, : 2 * STATE]
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            n += zr[STATE:] * from_h[t, 2 * STATE :]
            np.tanh(n, out=n)
            after = np.subtract(h, n, out=states[t + 1], casting="same_kind")
            after *= zr[:STATE]
            after += n
        return states.transpose(0, 2, 1), (before, from_h[:, 2 * STATE :], gates)

    def backward(self, grad: Network, tokens: np.ndarray, begins: np.ndarray, kept: tuple, d_states: np.ndarray) -> None:
        """Add the gradient of the recurrent part, given the gradients of the states after each step."""
        steps, lanes = tokens.shape
        before, u, gates = kept
        z, r, n = (gates[:, i * STATE : (i + 1) * STATE] for i in range(3))
        # What the gradient of a state is multiplied by: for the last gate, the first two, and the last one's part that is read from h.
        factors = np.empty((steps, 4, STATE, lanes), np.float32)
        rest = 1 - z
        factors[:, 0] = rest * (1 - n * n)
        factors[:, 1] = (before - n) * z * rest
        factors[:, 3] = factors[:, 0] * r
        factors[:, 2] = factors[:, 3] * u * (1 - r)
        d_after, going = np.ascontiguousarray(d_states.transpose(0, 2, 1)), (~begins).astype(np.float32)
        carried = np.zeros((STATE, lanes), np.float32)
        for t in range(steps - 1, -1, -1):
            dh = carried
            dh += d_after[t]
            factors[t] *= dh
            carried = self.wh @ factors[t, 1:].reshape(3 * STATE, lanes)
            carried += dh * z[t]
            carried *= going[t]
        rows = np.ascontiguousarray(factors.reshape(steps, 4 * STATE, lanes).transpose(0, 2, 1)).reshape(-1, 4 * STATE)
        grad.wh[...] += before.transpose(0, 2, 1).reshape(-1, STATE).T @ rows[:, STATE:]
        order = np.argsort(tokens.ravel().astype(np.uint16), kind="stable")
        flat = tokens.ravel()[order]
        heads = np.flatnonzero(np.concatenate(([True], np.diff(flat) != 0)))
        sums = np.add.reduceat(np.take(rows[:, : 3 * STATE], order, axis=0), heads, axis=0)
        grad.wx[flat[heads]] += np.concatenate((sums[:, STATE:], sums[:, :STATE]), axis=1)

    def outputs(self, states: np.ndarray, targets: np.ndarray, grad: Network | None = None, scale: float = 1.0):
        """Natural log-probabilities of ``targets``; with ``grad`` also the gradient with respect to ``states`` of
        minus their sum times ``scale``.

        Targets are taken in order, so that a class is one range of rows; the biases are weights of a column of ones.
        """
        order = np.argsort(targets.astype(np.uint16), kind="stable")
        targets = targets[order]
        # WORDS, any other word, comes after the last class.
        word_class = targets // CLASS_SIZE
        seen = np.ones((len(order), STATE + 1), states.dtype)
        np.take(states, order, axis=0, out=seen[:, :STATE])
        of_class = np.concatenate((self.wc, self.bc[None]))
        chance = seen @ of_class
        logs, d_seen = _chances(chance, word_class, None if grad is None else scale), None
        if grad is not None:
            change = seen.T @ chance
            grad.wc[...] += change[:STATE]
            grad.bc[...] += change[STATE]
            d_seen = chance @ self.wc.T
        edges = np.searchsorted(word_class, np.arange(CLASSES + 1)).tolist()
        present = [c for c in range(CLASSES) if edges[c] < edges[c + 1]]
        of_word = np.concatenate((self.wo, self.bo[:, None]), axis=1)
        words = np.empty((edges[CLASSES], CLASS_SIZE), chance.dtype)
        for c in present:
            a, b = edges[c], edges[c + 1]
            np.matmul(seen[a:b], of_word[c], out=words[a:b])
        logs[: len(words)] += _chances(words, targets[: len(words)] % CLASS_SIZE, None if grad is None else scale)
        found, d_states = np.empty_like(logs), None
        found[order] = logs
        if grad is not None:
            for c in present:
                a, b = edges[c], edges[c + 1]
                change = seen[a:b].T @ words[a:b]
                grad.wo[c] += change[:STATE]
                grad.bo[c] += change[STATE]
                d_seen[a:b] += words[a:b] @ self.wo[c].T
            d_states = np.empty(states.shape, d_seen.dtype)
            d_states[order] = d_seen
        return found, d_states


# Values whose exponentials, and sums of some of these, are numbers of 32 bits.
EXPONENTS = 70.0


def _chances(logits: np.ndarray, columns: np.ndarray, scale: float | None) -> np.ndarray:
    """Logs of the chances that the rows of ``logits`` give to ``columns``; with ``scale`` the logits become the gradients of minus
    the sum of these logs times ``scale``."""
    if logits.size and max(logits.max(), -logits.min()) > EXPONENTS:
        logits -= logits.max(1, keepdims=True)
    rows = np.arange(len(columns))
    found = logits[rows, columns]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    found -= np.log(total)
    if scale is not None:
        logits *= (scale / total)[:, None]
        logits[rows, columns] -= scale
    return found


def in_lanes(texts: list[np.ndarray], lanes: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Windows of texts laid end to end in lanes of about equal length: inputs, targets, begins, text numbers (-1 past the end).

    Lanes are in falling order of length, and a window holds only those that go on; a lane's next window follows
    where this one ends.
    """
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    heap = [(0, k) for k in range(min(lanes, len(texts)))]
    rows: list[list[int]] = [[] for _ in heap]
    for i in order:
        size, k = heapq.heappop(heap)
        rows[k].append(i)
        heapq.heappush(heap, (size + len(texts[i]), k))
    rows.sort(key=lambda r: -sum(len(texts[i]) for i in r))
    sizes = np.array([sum(len(texts[i]) for i in r) for r in rows], np.int64)
    if not len(sizes):
        return
    # All lanes in one array, one after the other: memory follows the tokens, not the longest lane.
    laid = np.array([i for r in rows for i in r], np.int32)
    lengths = np.array([len(texts[i]) for i in laid], np.int64)
    flat = np.concatenate([texts[i] for i in laid]).astype(np.int32)
    owner = np.repeat(laid, lengths)
    starting = np.zeros(len(flat), bool)
    starting[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    # A text begins after the end of another: the input there is word 0.
    before = np.concatenate((np.zeros(1, np.int32), flat[:-1]))
    before[starting] = 0
    first = np.cumsum(sizes) - sizes
    for at in range(0, int(sizes[0]), WINDOW):
        live = int((sizes > at).sum())
        step = np.arange(at, min(at + WINDOW, int(sizes[0])))[:, None]
        inside = step < sizes[:live]
        place = np.where(inside, first[:live] + step, 0)
        yield before[place] * inside, flat[place] * inside, starting[place] & inside, np.where(inside, owner[place], -1)


def train_on(network: Network, texts: list[np.ndarray], memory: dict) -> int:
    """One pass over the texts with Adam, a step per window; the state is carried on, its gradient is cut."""
    state, seen = None, 0
    grad = Network()
    first, second, change = memory["first"], memory["second"], memory["change"]
    for inputs, targets, begins, number in in_lanes(texts, LANES):
        lanes = inputs.shape[1]
        state = np.zeros((lanes, STATE), np.float32) if state is None else state[:lanes]
        states, kept = network.forward(inputs, begins, state)
        state = states[-1]
        real = (number >= 0).ravel()
        count = int(real.sum())
        grad.flat[:] = 0
        flat = states[1:].reshape(-1, STATE)
        d_states = np.zeros_like(flat)
        _, d_states[real] = network.outputs(flat[real], targets.ravel()[real], grad, 1 / count)
        network.backward(grad, inputs, begins, kept, d_states.reshape(states[1:].shape))
        clip = min(1.0, 1.0 / max(float(np.linalg.norm(grad.flat)), 1e-9))
        memory["step"] += 1
        # Adam with moments 0.9 and 0.99, in place.
        grad.flat *= 0.1 * clip
        first *= 0.9
        first += grad.flat
        second *= 0.99
        np.multiply(grad.flat, grad.flat, out=change)
        second += change
        np.sqrt(second, out=change)
        change += 1e-7
        np.divide(first, change, out=change)
        change *= RATE * np.sqrt(1 - 0.99 ** memory["step"]) / (1 - 0.9 ** memory["step"])
        network.flat -= change
        seen += count
    return seen


def score_texts(network: Network, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of each whole text."""
    found, state = np.zeros(len(texts)), None
    for inputs, targets, begins, number in in_lanes(texts, SCORE_LANES):
        lanes = inputs.shape[1]
        state = np.zeros((lanes, STATE), np.float32) if state is None else state[:lanes]
        states, _ = network.forward(inputs, begins, state)
        state = states[-1]
        real = (number >= 0).ravel()
        logs, _ = network.outputs(states[1:].reshape(-1, STATE)[real], targets.ravel()[real])
        found += np.bincount(number.ravel()[real], logs, len(texts))
    return found


def by_size(found: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of the batches of about SPLIT_AT_ONCE bytes in column ``name``."""
    for batch in found:
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        before = (np.cumsum(sizes) - sizes) // SPLIT_AT_ONCE
        edges = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if a < b:
                yield batch.slice(a, b - a)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """What ``words_of`` gives for a column of texts: distinct words, the place of each occurrence among them, and where texts end.

    There may be distinct words that do not occur.
    """
    found = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = found.flatten()
    # Gaps at the ends of a text leave empty words.
    real = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    ends = np.concatenate(([0], np.cumsum(real)))[found.offsets.to_numpy()[1:] - found.offsets[0].as_py()]
    coded = flat.dictionary_encode()
    return coded.dictionary.cast(pa.binary()), coded.indices.to_numpy()[real], ends


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` over all words of column ``text``, added up in tasks before the exchange."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(found):
            words, places, _ = split_words(part.column(0))
            n = np.bincount(places, minlength=len(words))
            occur = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([words.take(pa.array(occur)), pa.array(n[occur], pa.int64())], ["word", "n"])

    counted = texts.select("text").mapInArrow(batches, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Counts the tasks know: of the ``HEAD`` most frequent words, and sums over all words."""

    def __init__(self, words: pa.Array, counts: np.ndarray, tokens: int, distinct: int, texts: int):
        self.words, self.counts, self.tokens, self.distinct, self.texts = words, counts, tokens, distinct, texts
        self.logs = np.log10(counts + SMOOTH)
        known = min(len(words), WORDS - 1)
        self.model_counts = np.zeros(WORDS)
        self.model_counts[0] = texts
        self.model_counts[1 : known + 1] = counts[:known]
        self.other_tokens = tokens - int(self.model_counts.sum())
        self.other_distinct = max(0, distinct - known - (texts > 0))

    def places(self, words: pa.Array) -> np.ndarray:
        """Ranks of words by frequency, -1 outside the head."""
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)

    @staticmethod
    def tokens_of(places: np.ndarray) -> np.ndarray:
        """Model words of a text with its end."""
        known = (places >= 0) & (places < WORDS - 1)
        return np.append(np.where(known, places + 1, WORDS), 0).astype(np.int32)


def _averaged(parts: DataFrame) -> tuple[np.ndarray | None, float]:
    """Weighted mean of parameter chunks, in two stages so that no group grows with the number of tasks alone."""

    def add(frame):
        total = sum(np.frombuffer(x, np.float64) for x in frame["values"])
        return frame.iloc[:1].assign(weight=frame["weight"].sum(), values=[total.tobytes()])

    shape = "slot int, chunk int, weight double, values binary"
    first = parts.groupBy("slot", "chunk").applyInPandas(add, shape)
    whole = first.groupBy("chunk").applyInPandas(add, shape).orderBy("chunk").toPandas()
    if not len(whole):
        return None, 0.0
    return np.concatenate([np.frombuffer(x, np.float64) for x in whole["values"]]) / whole["weight"][0], float(whole["weight"][0])


def vocabulary_of(docs: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """Vocabulary and table of all word counts from the rows of ``text``."""
    counts = stored(word_counts(docs), "word-counts")
    texts = docs.count()
    words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # A table of at most HEAD words reaches the driver, whatever the input.
    head = counts.orderBy(F.desc("n"), "word").limit(HEAD).toArrow()
    found = Vocabulary(
        head.column("word").combine_chunks(), head.column("n").to_numpy().astype(np.float64), words + texts, distinct + (texts > 0), texts
    )
    return found, counts


def encoded(rows: DataFrame, known) -> DataFrame:
    """Texts of ``id, hash, learn, turn, text`` as model words, so that training and scoring read numbers only.

    ``tokens`` holds two bytes a token.  Beside it are sums over the words whose counts the tasks know, and the other words of the
    text with how often they occur in it.  ``known`` is the broadcast vocabulary.
    """
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "hash", "learn", "turn")}
    shape = ", ".join(f"{name} {kind}" for name, kind in kinds.items())
    shape += ", n_tokens bigint, n_head bigint, head_logs double, other_logs double, n_other bigint, tokens binary"
    shape += ", words array<binary>, times array<bigint>"
    names = [*kinds, "n_tokens", "n_head", "head_logs", "other_logs", "n_other", "tokens", "words", "times"]

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = known.value
        for part in by_size(found):
            facts, tokens, rare, times, ends = [], [], [], [], [0]
            distinct, occurring, stops = split_words(part.column("text"))
            ranks = vocabulary.places(distinct)
            for own in np.split(occurring, stops[:-1]):
                places = ranks[own]
                inside = places[places >= 0]
                other = inside[inside >= WORDS - 1]
                facts.append((len(places) + 1, len(inside), vocabulary.logs[inside].sum(), vocabulary.logs[other].sum(), len(other)))
                tokens.append(vocabulary.tokens_of(places).astype(np.uint16).tobytes())
                if len(inside) < len(places):
                    held = Counter(own[places < 0].tolist())
                    rare += held.keys()
                    times += held.values()
                ends.append(len(rare))
            at = pa.array(ends, pa.int32())
            kinds_of = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())
            made = [pa.array(x, kind) for x, kind in zip(zip(*facts), kinds_of)]
            made.append(pa.array(tokens, pa.binary()))
            made += [pa.ListArray.from_arrays(at, distinct.take(pa.array(rare, pa.int64()))), pa.ListArray.from_arrays(at, pa.array(times, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kinds), *made], names)

    return rows.select(*kinds, "text").mapInArrow(batches, shape)


def tokens_in(batch: pa.RecordBatch) -> list[np.ndarray]:
    """Model words of the texts of column ``tokens``."""
    return [np.frombuffer(t.as_py(), np.uint16) for t in batch.column("tokens")]


def train(texts: DataFrame, vocabulary: Vocabulary) -> Network:
    """The network after one pass over the encoded texts, a third of them a round."""
    context = texts.sparkSession.sparkContext
    network = Network.initial(vocabulary.model_counts, vocabulary.other_tokens)
    for number in range(ROUNDS if vocabulary.texts else 0):
        shared = context.broadcast(network.flat)

        def batches(found: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, seen = Network(shared.value.copy()), 0
            memory = {"step": 0} | {name: np.zeros_like(own.flat) for name in ("first", "second", "change")}
            for batch in found:
                seen += train_on(own, tokens_in(batch), memory)
            if seen:
                slot = TaskContext.get().partitionId() % SLOTS
                for at in range(0, len(own.flat), CHUNK):
                    values = (own.flat[at : at + CHUNK].astype(np.float64) * seen).tobytes()
                    row = {"slot": [slot], "chunk": [at // CHUNK], "weight": [float(seen)], "values": [values]}
                    schema = pa.schema([("slot", pa.int32()), ("chunk", pa.int32()), ("weight", pa.float64()), ("values", pa.binary())])
                    yield pa.RecordBatch.from_pydict(row, schema)

        turn = texts.where(F.col("turn") == number).select("tokens")
        flat, seen = _averaged(turn.mapInArrow(batches, "slot int, chunk int, weight double, values binary"))
        if seen:
            network = Network(flat.astype(np.float32))
    return network


def scores(docs: DataFrame, for_training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: identifier, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Learns from the rows that pass ``for_training``.  Both scores are base-10 log-probabilities of the words and the end of the
    text; ``base_score`` is that of the smoothed unigram model.  A null or empty text is just an end.  Repeated rows give repeated
    rows, null identifiers stay null, an empty table gives no rows, other columns are ignored.
    """
    vocabulary, counts = vocabulary_of(docs.where(for_training).select(F.col(text_col).alias("text")))
    context = docs.sparkSession.sparkContext
    known = context.broadcast(vocabulary)
    turn = F.pmod(F.xxhash64(id_col, text_col), F.lit(ROUNDS)).cast("int")
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("hash"),
        F.coalesce(for_training, F.lit(False)).alias("learn"),
        turn.alias("turn"),
        F.col(text_col).alias("text"),
    )
    # Texts are split into words once to be counted and once here.
    texts = stored(encoded(rows, known), "encoded-texts")
    network = train(texts.where("learn"), vocabulary)
    shared = context.broadcast(network.flat)
    facts = ["id", "hash", "n_tokens", "n_head", "head_logs", "other_logs", "n_other"]

    def score(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(shared.value.copy())
        for batch in found:
            logs = score_texts(network, tokens_in(batch)) / np.log(10)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in facts), pa.array(logs, pa.float64())], [*facts, "model"])

    kind = rows.schema["id"].dataType.simpleString()
    scored = texts.select(*facts, "tokens").mapInArrow(
        score,
        f"id {kind}, hash bigint, n_tokens bigint, n_head bigint, head_logs double, other_logs double, n_other bigint, model double",
    )
    # Counts of the words that the tasks do not know: a join on the word, then sums per text.
    rare = texts.where(F.size("words") > 0).select("id", "hash", F.explode(F.arrays_zip("words", "times")).alias("w"))
    tails = rare.select("id", "hash", F.col("w.words").alias("word"), F.col("w.times").alias("times")).join(counts, "word", "left")
    count = F.coalesce("n", F.lit(0))
    tails = tails.groupBy("id", "hash").agg(
        F.sum("times").alias("tail_tokens"),
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("times") * F.log10(count + SMOOTH)).alias("tail_logs"),
    )
    tails = tails.withColumnsRenamed({"id": "tail_id", "hash": "tail_hash"})
    same = F.col("id").eqNullSafe(F.col("tail_id")) & (F.col("hash") == F.col("tail_hash"))
    met = scored.join(tails, same, "left")
    own = F.col("n_tokens") - 1 - F.col("n_head")
    # Rows that repeat identifier and text have added up their words together.
    share = F.when(F.col("tail_tokens") > 0, own / F.col("tail_tokens")).otherwise(F.lit(0.0))
    tail_logs, tail_known = F.coalesce(F.col("tail_logs") * share, F.lit(0.0)), F.coalesce(F.round(F.col("tail_known") * share), F.lit(0))
    total = float(np.log10(vocabulary.tokens + SMOOTH * (vocabulary.distinct + 1)))
    others = float(np.log10(vocabulary.other_tokens + SMOOTH * (vocabulary.other_distinct + 1)))
    end = float(np.log10(vocabulary.texts + SMOOTH))
    return met.select(
        F.col("id").alias(id_col),
        "n_tokens",
        (F.col("n_head") + tail_known + F.lit(int(vocabulary.texts > 0))).cast("long").alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("head_logs") + tail_logs + F.lit(end) - F.col("n_tokens") * F.lit(total)).alias("base_score"),
        (F.col("model") + F.col("other_logs") + tail_logs - (F.col("n_other") + own) * F.lit(others)).alias("score"),
    )

"""Language model, language identification, toxicity and quality rules: brute force, identities and held-out accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changeloom.llm import language, language_model, quality, toxicity
from changeloom.llm.common import fold, words_of

from .conftest import SCHEMA, prose, word

GAPS = " \t\n\v\f\r"


def crc(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def test_base_scores(messy, messy_rows):
    counts = Counter(w for r in messy_rows if crc(r[0]) % 5 != 1 for w in [*words_of(r[1]), None])
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for r in messy_rows:
        tokens = [*words_of(r[1]), None]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens)
        want.append((r[0], len(tokens), sum(counts[t] > 0 for t in tokens), total, round(base, 6)))
    found = language_model.scores(messy, fold(5) != 1).collect()
    got = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found]
    assert Counter(got) == Counter(want)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)


def test_rare_words_are_joined(messy, messy_rows, monkeypatch):
    """With a tiny known head, the same base scores come from the join."""
    wide = {(r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in language_model.scores(messy, fold(5) != 1).collect()}
    monkeypatch.setattr(language_model, "HEAD", 5)
    found = language_model.scores(messy, fold(5) != 1).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in found} == wide


def test_scores_on_nothing(no_rows):
    assert language_model.scores(no_rows, fold(5) != 1).collect() == []


def test_scores_without_training_rows(messy, messy_rows):
    found = language_model.scores(messy, F.lit(False)).collect()
    assert len(found) == len(messy_rows) and all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in found)


def network():
    made = language_model.Network.initial(np.arange(language_model.WORDS, 0, -1.0), 50.0)
    made.flat = made.flat.astype(np.float64)
    return language_model.Network(made.flat)


def test_gradients():
    """Backpropagation against finite differences."""
    rng = np.random.default_rng(0)
    net = network()
    tokens, targets = rng.integers(0, 40, (6, 3)), rng.integers(0, 40, 18)
    targets[4] = language_model.WORDS
    begins = rng.random((6, 3)) < 0.2
    state = rng.normal(0, 0.5, (3, language_model.STATE))

    def loss():
        states, _ = net.forward(tokens, begins, state)
        return -net.outputs(states[1:].reshape(18, -1), targets)[0].sum()

    grad = language_model.Network(np.zeros_like(net.flat))
    states, kept = net.forward(tokens, begins, state)
    _, d_states = net.outputs(states[1:].reshape(18, -1), targets, grad, 1.0)
    net.backward(grad, tokens, begins, kept, d_states.reshape(6, 3, -1))
    places = rng.choice(np.flatnonzero(grad.flat), 60, replace=False)
    for at in places:
        step = 1e-3
        net.flat[at] += step
        up = loss()
        net.flat[at] -= 2 * step
        down = loss()
        net.flat[at] += step
        assert abs((up - down) / (2 * step) - grad.flat[at]) < 2e-2 * max(1, abs(grad.flat[at]))


def test_outputs_are_a_distribution():
    net = network()
    state = np.random.default_rng(1).normal(0, 1, (1, language_model.STATE))
    every = np.arange(language_model.WORDS + 1)
    logs, _ = net.outputs(np.repeat(state, len(every), 0), every)
    assert abs(np.exp(logs).sum() - 1) < 1e-6


def test_state_is_carried_over_windows_and_lanes():
    """Texts scored together in lanes and windows get what each gets alone, step by step."""
    rng = np.random.default_rng(2)
    net = language_model.Network(network().flat.astype(np.float32))
    texts = [np.append(rng.integers(1, 90, n), 0).astype(np.int32) for n in (0, 3, 200, 77, 31, 32, 33, 500)]
    together = language_model.score_texts(net, texts)
    for text, found in zip(texts, together):
        state, total, before = np.zeros((1, language_model.STATE), np.float32), 0.0, 0
        for k, token in enumerate(text):
            states, _ = net.forward(np.array([[before]]), np.array([[k == 0]]), state)
            state = states[-1]
            total += net.outputs(state, np.array([token]))[0][0]
            before = token
        assert abs(total - found) < 1e-2 + 1e-4 * abs(total)


def test_model_beats_unigrams_on_held_out_texts(spark):
    """Words come in two dialects; knowing the words before tells which."""
    rng = random.Random(8)
    words = [[word(rng, letters) for _ in range(60)] for letters in ("abcde", "fghij")]
    rows = []
    for i in range(400):
        rows.append((i, " ".join(rng.choice(words[i % 2]) for _ in range(80)), None, None, 0))
    found = language_model.scores(spark.createDataFrame(rows, SCHEMA).repartition(2), fold(5) != 1)
    held = found.where(fold(5) == 1).agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert held["s"] > 0.97 * held["b"] and held["s"] > held["b"]


def brute_ppm(rows, text):
    """Code length per language, from the definition."""
    counts = defaultdict(Counter)
    langs = sorted({r[2] for r in rows if r[2] is not None})
    for r in rows:
        if r[2] is None or not r[1]:
            continue
        data = b"\0\0\0" + r[1].encode().lower()
        for i in range(3, len(data)):
            for k in range(4):
                counts[(r[2], data[i - k : i])][data[i]] += 1
    data = b"\0\0\0" + text.encode().lower()
    bits = {}
    for lang in langs:
        total = 0.0
        for i in range(3, len(data)):
            for k in (3, 2, 1, 0):
                held = counts.get((lang, data[i - k : i]))
                if not held:
                    continue
                whole = sum(held.values()) + len(held)
                if held[data[i]]:
                    total += math.log2(whole / held[data[i]])
                    break
                total += math.log2(whole / len(held))
            else:
                total += 8
        bits[lang] = total
    return bits


def test_language_against_definition(messy, messy_rows):
    learned = [r for r in messy_rows if crc(r[0]) % 4 != 2]
    found = defaultdict(list)
    for r in language.identify(messy, fold(4) != 2).collect():
        found[r["doc_id"]].append((r["lang_pred"], round(r["score"], 6)))
    want = defaultdict(list)
    for r in messy_rows:
        if not r[1] or not any(c.isalpha() for c in r[1]):
            want[r[0]].append(("und", 0.0))
            continue
        bits = brute_ppm(learned, r[1])
        best = min(bits, key=lambda x: (bits[x], x))
        want[r[0]].append((best, round(1 / sum(2 ** -min(1000, b - bits[best]) for b in bits.values()), 6)))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


def test_language_without_anything_to_learn(messy, no_rows, messy_rows):
    assert language.identify(no_rows, fold(4) != 2).collect() == []
    found = language.identify(messy, F.lit(False)).collect()
    assert len(found) == len(messy_rows) and {r["lang_pred"] for r in found} == {"und"}


def test_language_held_out_accuracy(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, 15, letters), name, "s", 0) for i in range(300) for name, letters in [(("aa", "abcdefg"), ("bb", "defghij"), ("cc", "ghijéèü"))[i % 3]]]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = language.identify(docs, fold(4) != 2).join(docs.select("doc_id", "lang"), "doc_id").where(fold(4) == 2)
    right, count = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert count > 40 and right > 0.97


def test_toxicity_held_out(spark):
    rng = random.Random(7)
    bad = ["gleep", "snork", "blarg"]
    rows, labels = [], []
    for i in range(900):
        words = prose(rng, rng.randint(30, 80)).split(" ")
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), "en", "s", 0))
        if rng.random() < 0.5:
            labels.append((i, 1, int(toxic)))
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = {r["doc_id"]: r for r in toxicity.toxicity(docs, marks, fold(5) != 0).collect()}
    held = [i for i in range(900) if crc(i) % 5 == 0]
    right = sum(found[i]["predicted"] == (i % 6 == 0) for i in held)
    assert right / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())


def test_toxicity_edges(messy, messy_rows, no_rows, spark):
    shape = "doc_id bigint, quality int, toxic int"
    none = spark.createDataFrame([], shape)
    some = spark.createDataFrame([(1, 1, 1), (1, 1, None), (None, 1, 1), (2, 0, 0), (2, 0, 0), (3, None, 1), (99999, 1, 1)], shape)
    docs = messy.drop("toxic_score")
    assert toxicity.toxicity(no_rows, some, F.lit(True)).collect() == []
    assert {r["score"] < 1e-9 for r in toxicity.toxicity(docs, none, F.lit(True)).collect()} == {True}
    found = toxicity.toxicity(docs, some, F.lit(True)).collect()
    assert sorted(r["doc_id"] or -1 for r in found) == sorted(r[0] or -1 for r in messy_rows)
    with pytest.raises(ValueError):
        toxicity.score(messy, np.zeros(4, np.float32))


def brute_counts(text):
    text = text or ""
    table = str.maketrans(dict.fromkeys(GAPS, " "))
    words = [w for w in text.translate(table).split(" ") if w]
    lines = [x for x in text.split("\n") if x.translate(table).strip(" ")]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    many = Counter(windows)
    covered = {j for i, w in enumerate(windows) if many[w] > 1 for j in range(i, i + 8)}
    chars = sum(map(len, words))
    return (len(words), chars, sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark, messy_rows):
    rng = random.Random(3)
    texts = [r[1] for r in messy_rows]
    for _ in range(30):
        part = prose(rng, 12)
        texts.append("\n".join(rng.choice([part, prose(rng, 9), "", " \t", part + " x"]) for _ in range(rng.randint(1, 9))))
    texts += ["a " * 40, "a b c d " * 5, "\n\n\n", "x " * 7 + "x", "p q r s t u v w " * 2]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    found = quality.text_counts(docs, ["doc_id"]).collect()
    for r in found:
        want = brute_counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, texts[r["doc_id"]]
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])


def test_outliers(spark, messy, messy_rows, no_rows):
    """Ordinary texts stay, texts full of symbols go, though a tenth of all are such; there is no Python in the plan."""
    rng = random.Random(12)
    rows = []
    for i in range(1200):
        words = prose(rng, rng.randint(40, 200)).split(" ")
        if i % 10 == 0:
            words = [w + "%%%" for w in words]
        rows.append((i, " ".join(words), "en", f"s{i // 10 % 4}" if i % 400 else None, 0))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    judged = quality.outlier_verdicts(docs)
    assert "Python" not in judged._jdf.queryExecution().toString()
    found = {r["doc_id"]: r["kept"] for r in judged.collect()}
    assert len(found) == 1200
    assert sum(found[i] for i in range(0, 1200, 10) if i % 400) <= 2
    clean = [i for i in range(1200) if i % 10]
    assert sum(found[i] for i in clean) >= 0.995 * len(clean)
    assert quality.outlier_verdicts(no_rows).collect() == []
    edges = quality.outlier_verdicts(messy)
    assert edges.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept"]
    assert Counter(r["doc_id"] for r in edges.collect()) == Counter(r[0] for r in messy_rows)


def test_windows_take_memory_by_tokens_not_by_the_longest_text():
    """One very long text beside many short ones: windows hold every token once, in order, in little memory."""
    import tracemalloc

    rng = np.random.default_rng(0)
    texts = [rng.integers(1, 2000, n).astype(np.uint16) for n in (400_000, *[5] * 511, 0, 1)]
    tracemalloc.start()
    read = [[] for _ in texts]
    for inputs, targets, begins, number in language_model.in_lanes(texts, language_model.SCORE_LANES):
        assert inputs.shape == targets.shape == begins.shape == number.shape and len(inputs) <= language_model.WINDOW
        for i in np.unique(number[number >= 0]):
            read[i].append(targets[number == i])
        assert (inputs[begins] == 0).all() and (targets[number < 0] == 0).all()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(np.array_equal(np.concatenate([*r, []]), t) for r, t in zip(read, texts))
    # Dense steps x lanes would take 400,000 x 512 x 9 bytes.
    assert peak < 100 * 400_000


def test_columns_of_texts_are_split_like_single_texts(monkeypatch):
    """All white space and letters that only some functions change; a slice of a column, and parts of it by size."""
    texts = [None, "", " \t\n\x0b\x0c\r", "  a B  a ", "Ünï A\u00a0b \u2003c", "x\x1cy\x85z İ ẞ", "\x00 q\x00", None, "one", "a" * 50 + " a"]
    monkeypatch.setattr(language_model, "SPLIT_AT_ONCE", 40)
    whole = pa.record_batch({"text": pa.array(["zz", *texts])}).slice(1)
    parts = [p.column("text") for p in language_model.by_size([whole, whole.slice(0, 0)])]
    assert len(parts) > 1 and [t for p in parts for t in p.to_pylist()] == texts
    for part in (*parts, whole.column("text"), whole.column("text").slice(0, 2)):
        words, places, ends = language_model.split_words(part)
        found = [[words[int(j)].as_py() for j in own] for own in np.split(places, ends[:-1])]
        assert found == [words_of(t) for t in part.to_pylist()]


def test_outputs_of_any_size_are_a_distribution():
    """Logits beyond the numbers whose exponentials are finite, and gradients of states against the definition."""
    net, rng = network(), np.random.default_rng(9)
    states = rng.normal(0, 1, (6, language_model.STATE))
    targets = np.array([0, 70, language_model.WORDS, 5, language_model.WORDS - 1, 70])
    for size in (1.0, 400.0):
        net.flat *= size / max(1.0, np.abs(net.flat).max())
        logs, d_states = net.outputs(states, targets, language_model.Network(np.zeros_like(net.flat)), 0.5)
        for i, target in enumerate(targets.tolist()):
            place = min(target // language_model.CLASS_SIZE, language_model.CLASSES)
            steps = [(net.wc, net.bc, place)]
            if place < language_model.CLASSES:
                steps.append((net.wo[place], net.bo[place], target % language_model.CLASS_SIZE))
            want, slope = 0.0, 0.0
            for weights, bias, at in steps:
                logits = states[i] @ weights + bias
                chances = np.exp(logits - logits.max())
                chances /= chances.sum()
                want += logits[at] - logits.max() - np.log(np.exp(logits - logits.max()).sum())
                slope = slope + weights @ (chances - np.eye(len(chances))[at]) * 0.5
            assert abs(logs[i] - want) < 1e-6 * max(1, abs(want))
            assert np.allclose(d_states[i], slope, atol=1e-6 * size)

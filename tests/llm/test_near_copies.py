"""Near copies against brute force, and repeated and null identifiers through the stages of the pipeline."""

import random
from collections import Counter
from itertools import combinations

import pytest

import corpus_pipeline
from changeloom.llm import near_copies, simhash
from changeloom.llm.common import words_of

from .conftest import SCHEMA, prose


def shingles(text, width=5):
    words = words_of(text)
    width = min(width, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def changed(rng, text, count):
    words = text.split(" ")
    for at in rng.sample(range(len(words)), count):
        words[at] = "zz" + words[at]
    return " ".join(words)


def roots(texts):
    label = list(range(len(texts)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if jaccard(texts[i], texts[j]) >= 0.8:
            a, b = sorted((top(i), top(j)))
            label[b] = a
    return [top(i) for i in range(len(texts))]


def groups(spark, texts, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(3)
    found = {r["node"]: r["root"] for r in near_copies.near_groups(docs, **more).collect()}
    return [found.get(i, i) for i in range(len(texts))]


@pytest.mark.parametrize("small", [near_copies.SMALL, 2])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, small):
    """With small=2 nearly all buckets count as large."""
    monkeypatch.setattr(near_copies, "SMALL", small)
    monkeypatch.setattr(near_copies, "PIVOT_ROUNDS", 1)
    rng = random.Random(3)
    texts = ["", None, " \t", "one", "one", "two"]
    for _ in range(12):
        base = prose(rng, 150)
        texts += [base] + [changed(rng, base, rng.randint(1, 4)) for _ in range(12)]
    rng.shuffle(texts)
    assert groups(spark, texts) == roots(texts)


def test_pairs_from_the_threshold_on_are_found(spark):
    rng = random.Random(4)
    texts, pairs = [], []
    while len(pairs) < 200:
        base = prose(rng, 150)
        other = changed(rng, base, rng.randint(2, 3))
        if 0.8 <= jaccard(base, other) < 0.9:
            pairs.append(len(texts))
            texts += [base, other]
    found = groups(spark, texts)
    assert sum(found[i] == found[i + 1] for i in pairs) >= 198


def test_link_needs_similar_shingles(spark):
    """Texts of six words whose fingerprints differ in no more than six bits, but that share no shingle."""
    rng, seen, pair = random.Random(5), [], None
    while pair is None:
        text = prose(rng, 6)
        code = simhash.fingerprint(words_of(text), 5)
        if code.bit_count() <= 6:
            pair = (text, "")
    docs = spark.createDataFrame([(1, pair[1], "en", "s", 0), (2, pair[0], "en", "s", 0)], SCHEMA)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert {r["doc_id"] for r in kept} == {1, 2}


def test_one_row_of_repeated_rows_stays(spark, messy, messy_rows):
    rows = Counter((r[0], (r[1] or "").lower()) for r in messy_rows)
    assert max(rows.values()) > 1
    exact = corpus_pipeline.stored(corpus_pipeline.drop_copies(spark, messy, ""), "test-exact")
    assert exact.columns == corpus_pipeline.COLUMNS
    texts = [(r["text"] or "").lower() for r in exact.collect()]
    assert sorted(texts) == sorted({t for _, t in rows})
    least = {}
    for i, t in rows:
        least[t] = min(least.get(t, (True, 0)), (i is None, i or 0))
    assert {(r["text"] or "").lower(): (r["doc_id"] is None, r["doc_id"] or 0) for r in exact.collect()} == least
    near = corpus_pipeline.stored(corpus_pipeline.drop_near_copies(spark, exact, ""), "test-near")
    ordered = sorted(exact.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    names = roots([r["text"] for r in ordered])
    assert sorted(r["doc_id"] or -1 for r in near.collect()) == sorted(ordered[i]["doc_id"] or -1 for i in set(names))
    rest = corpus_pipeline.drop_repeats(spark, near, "")
    assert rest.columns == corpus_pipeline.COLUMNS and rest.count() == near.count()


def test_rows_that_share_an_identifier_stay_apart(spark):
    rng = random.Random(6)
    texts = [prose(rng, 60) for _ in range(4)]
    rows = [(None, texts[0], "en", "a", 0), (None, texts[0], "en", "a", 0), (None, texts[1], "de", "b", 0), (1, texts[1], "en", "c", 0)]
    rows += [(7, texts[2], "fr", "d", 0), (7, texts[3], "es", "e", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for stage in (corpus_pipeline.drop_copies, corpus_pipeline.drop_near_copies, corpus_pipeline.drop_repeats):
        docs = corpus_pipeline.stored(stage(spark, docs, ""), "test-shared")
        got = sorted((r["doc_id"] or 0, r["text"], r["lang"], r["source"]) for r in docs.collect())
        assert got == sorted([(0, texts[0], "en", "a"), (1, texts[1], "en", "c"), (7, texts[2], "fr", "d"), (7, texts[3], "es", "e")])


def test_texts_are_named_once_for_all_their_buckets(spark, monkeypatch):
    """A large family beside texts that share half of it: its buckets stay open through both levels."""
    rng, named = random.Random(7), []
    plain = near_copies._named

    def counted(rows, groups):
        named.append((rows.count(), rows.select("id").distinct().count()))
        return plain(rows, groups)

    monkeypatch.setattr(near_copies, "_named", counted)
    base = prose(rng, 120)
    texts = [changed(rng, base, 1) for _ in range(30)]
    texts += [changed(rng, base, rng.randint(4, 6)) for _ in range(30)]
    assert groups(spark, texts) == roots(texts)
    assert len(named) >= 3 and all(rows == ids <= len(texts) for rows, ids in named)

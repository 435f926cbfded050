"""Cross-tokenizer alignment against a token by token version."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from changeloom.llm import alignment

from .test_tokens import texts

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(BPE)
LIBRARY.encode_special_tokens = True
MODEL = sentencepiece.SentencePieceProcessor(model_file=PIECES)
PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_OF = {chr(b): b for b in PLAIN} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in PLAIN)}


def bytes_a(i):
    return bytes(BYTE_OF[c] for c in LIBRARY.id_to_token(i))


def bytes_b(i):
    piece = MODEL.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()


def groups_of(text):
    """(ids of A, ids of B) per group, by walking both lists and comparing ends."""
    if not text:
        return []
    a, b = LIBRARY.encode(" " + text, add_special_tokens=False).ids, MODEL.encode(text)
    whole = (" " + text).encode()
    if b"".join(map(bytes_a, a)) != whole or b"".join(map(bytes_b, b)) != whole:
        return []
    found, one, two, i, j, end_a, end_b = [], [], [], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if end_a <= end_b and i < len(a):
            one.append(a[i])
            end_a += len(bytes_a(a[i]))
            i += 1
        else:
            two.append(b[j])
            end_b += len(bytes_b(b[j]))
            j += 1
        if end_a == end_b:
            found.append((one, two))
            one, two = [], []
    return found


def brute(rows):
    groups = [groups_of(t) for _, t in rows]
    links = [Counter((x, y) for one, two in g for x in one for y in two) for g in groups]
    counts = Counter(pair for found in links for pair in found)
    top = defaultdict(int)
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    result = Counter()
    for (name, _), g, found in zip(rows, groups, links):
        written = ";".join(f"{','.join(map(str, one))}|{','.join(map(str, two))}" for one, two in g)
        best = sum(n for pair, n in found.items() if counts[pair] == top[pair[0]])
        total = sum(n * counts[pair] for pair, n in found.items())
        digest = hashlib.sha256(written.encode()).hexdigest() if g else ""
        sizes = sum(len(one) for one, _ in g), sum(len(two) for _, two in g)
        result[(name, *sizes, len(g), sum(found.values()), best, total, digest)] += 1
    return result


@pytest.mark.parametrize("held_pairs", [0, 40, 1 << 18])
def test_alignment_equals_brute_force(spark, held_pairs):
    """Whatever share of the pairs tasks hold, results are those of the plain version."""
    rows = list(enumerate(texts())) + [(900, "one two three"), (900, "one two three"), (901, "a▁b"), (902, "x <0x41> <s></s> <unk>"), (903, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    expected = brute(rows)
    assert Counter(map(tuple, alignment.alignment(docs, BPE, PIECES, held_pairs=held_pairs).collect())) == expected
    assert sum(r[1] > 0 for r in expected) > 100 and sum(r[1] == 0 for r in expected) > 3


def test_alignment_edges(messy, messy_rows, no_rows):
    """Nulls, empty and very long texts, repeated rows and clashing names; nothing for no rows."""
    assert Counter(map(tuple, alignment.alignment(messy, BPE, PIECES).collect())) == brute([r[:2] for r in messy_rows])
    assert alignment.alignment(no_rows, BPE, PIECES).collect() == []


def test_large_groups_put_equal_ids_together(monkeypatch):
    """The short way for large groups gives the same pairs and numbers of links."""
    both, rng = alignment.aligner(BPE, PIECES), np.random.default_rng(3)
    a, b = rng.integers(0, 50, 400), rng.integers(0, 30, 300)
    cut_a, cut_b = [5, 6, 206, 400], [90, 91, 191, 300]
    plain = both.links(a, b, cut_a, cut_b)
    monkeypatch.setattr(alignment, "LARGE_GROUP", 20)
    assert all((x == y).all() for x, y in zip(plain, both.links(a, b, cut_a, cut_b)))
    expected = Counter()
    for i, x, j, y in zip([0, *cut_a], cut_a, [0, *cut_b], cut_b):
        expected.update(int(p) * both.size_b + int(q) for p in a[i:x] for q in b[j:y])
    assert dict(zip(*map(np.ndarray.tolist, plain))) == expected


def test_cuts_are_arrays_and_take_the_last_of_tokens_without_bytes():
    made = alignment.Aligner.__new__(alignment.Aligner)
    made.length_a, made.length_b = np.array([0, 1, 2, 3]), np.array([0, 1, 2, 3])
    cut_a, cut_b = made.cuts(np.array([2, 0, 3, 1]), np.array([1, 1, 0, 0, 2, 2]))
    assert isinstance(cut_a, np.ndarray) and (cut_a.tolist(), cut_b.tolist()) == ([2, 4], [4, 6])
    none = np.empty(0, np.int64)
    assert [len(c) for c in made.cuts(none, none)] == [0, 0]
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 4, 40), rng.integers(0, 4, 40)
        ends = [dict(zip(np.cumsum(x).tolist(), range(1, 41))) for x in (a, b)]
        common = sorted(ends[0].keys() & ends[1].keys())
        assert [c.tolist() for c in made.cuts(a, b)] == [[e[c] for c in common] for e in ends]

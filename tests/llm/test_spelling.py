"""Spelling variants against a comparison of all words with all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from changeloom.llm import spelling


def brute_words(rows, least_length, least_count, one_in):
    counts = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % one_in == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, least_length=7, least_count=2, ratio=10, one_in=31):
    words = brute_words(rows, least_length, least_count, one_in)
    near = {w: [v for v in words if is_near(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    result = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        result.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return result


def found(df, **args):
    rows = [tuple(r) for r in spelling.variants(df, **args).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def changed(rng, word):
    at, letter = rng.randrange(len(word)), rng.choice("abélÀ")
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :], word[:at] + letter + word[at:]])


@pytest.mark.parametrize("least_length,ratio,one_in", [(7, 10, 31), (3, 2, 5), (1, 3, 4)])
def test_variants_equal_brute_force(spark, least_length, ratio, one_in):
    """Chains of forms, equal letters side by side, ties, letters beyond ASCII, and words as short as one letter."""
    rng = random.Random(least_length)
    base = ["aabbaab", "ballooon", "Straßenbahn", "élève" * 2, "letters", "lettters", "aaaaaaa", "aaaaaaaa", "ab", "a", "b", "ÀÉÎÕÜçñ"]
    words = [w for w in base for _ in range(rng.choice([1, 4, 30, 400]))]
    for _ in range(300):
        words.append(changed(rng, rng.choice(base)))
        words += [changed(rng, words[-1])] * rng.choice([1, 2, 9]) if len(words[-1]) > 1 else []
    rng.shuffle(words)
    rows = [(i // 2, " ".join(words[i * 9 : i * 9 + 9]).replace(" ", rng.choice([" ", "-", "4", "\n", "漢"]))) for i in range(len(words) // 9 + 1)]
    rows += [(None, "letters letteré letters"), (7, None), (8, ""), (8, "..."), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    expected = brute(rows, least_length, 2, ratio, one_in)
    assert found(docs, least_length=least_length, ratio=ratio, delete_one_in=one_in) == expected
    assert len({r for r in expected if r[1]}) > 10


def test_chain_of_forms(spark):
    """Roots are followed over several forms."""
    rows = [(0, "letterz " * 2 + "lettery " * 20 + "letterx " * 200 + "lutterx " * 2000 + "luttery " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    held = {r[0]: r for r in found(docs, delete_one_in=1 << 40)}
    assert held == {r[0]: r for r in brute(rows, one_in=1 << 40)}
    assert spelling.roots(spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)], "word string, form string"), 10**11, 10).where(
        "root = 'w11'"
    ).count() == 11


def test_variants_edges(spark, messy, messy_rows, no_rows):
    """Nulls, empty and very long texts, repeated rows, clashing names; nothing for no rows."""
    assert found(messy, least_length=3) == brute([r[:2] for r in messy_rows], least_length=3)
    assert found(no_rows) == set()
    assert found(spark.createDataFrame([(1, "one two"), (2, None)], "doc_id bigint, text string")) == set()
    with pytest.raises(ValueError):
        spelling.variants(no_rows, ratio=1)

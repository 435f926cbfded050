"""Exact, near and substring deduplication against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from changeloom.llm import exact_dedup, graph, simhash, suffix_dedup
from changeloom.llm.common import words_of

from .conftest import SCHEMA, prose

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(row):
    return tuple((v is None, str(v)) for v in row)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact(messy, messy_rows, keep):
    groups = defaultdict(list)
    for row in messy_rows:
        groups[(row[1] or "").translate(UPPER)].append(row[0])
    want = []
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (min if keep == "smallest" else max)(known) if known else None
        stays = ids.index(best)
        digest = hashlib.sha256(norm.encode()).hexdigest()
        want += [(i, best, len(ids), n == stays, digest) for n, i in enumerate(ids)]
    found = exact_dedup.exact_dedup(messy, keep=keep, salts=3)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)


def test_exact_on_nothing(no_rows):
    assert exact_dedup.exact_dedup(no_rows).collect() == []


def test_exact_has_no_python(messy):
    plan = exact_dedup.exact_dedup(messy)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def roots(count, pairs):
    up = list(range(count))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(count)]


def brute_fingerprint(text, shingle):
    import xxhash

    words = words_of(text)
    if not words:
        return 0
    width = min(shingle, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("bits", [3, 4, 8])
def test_near(messy, messy_rows, bits):
    codes = [brute_fingerprint(r[1], 4) for r in messy_rows]
    pairs = [(a, b) for a in range(len(codes)) for b in range(a) if (codes[a] ^ codes[b]).bit_count() <= bits]
    root = roots(len(codes), pairs)
    least = {}
    for row, r in zip(messy_rows, root):
        ids = [x for x in (least.get(r), row[0]) if x is not None]
        least[r] = min(ids) if ids else None
    want = [(row[0], f"{code:016x}", least[r]) for row, code, r in zip(messy_rows, codes, root)]
    found = simhash.near_duplicates(messy, shingle=4, bits=bits)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)


def test_near_on_nothing(no_rows):
    assert simhash.near_duplicates(no_rows).collect() == []


def test_large_buckets_are_split_without_loss(spark):
    """A ball of codes around one centre: every bucket is too large for the bound given."""
    rng = random.Random(3)
    codes = {rng.getrandbits(64) for _ in range(300)}
    for centre in (rng.getrandbits(64), 0):
        for _ in range(400):
            code = centre
            for place in rng.sample(range(64), rng.randint(0, 7)):
                code ^= 1 << place
            codes.add(code)
    codes = sorted(codes)
    pairs = [(a, b) for a in range(len(codes)) for b in range(a) if (codes[a] ^ codes[b]).bit_count() <= 4]
    root = roots(len(codes), pairs)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    links = simhash.code_links(spark.createDataFrame([(c,) for c in signed], "code bigint"), 4, bucket=50)
    place = {c: i for i, c in enumerate(signed)}
    assert roots(len(codes), [(place[r["u"]], place[r["v"]]) for r in links.collect()]) == root


def test_gray_index_finds_all_pairs_and_prunes():
    rng = np.random.default_rng(1)
    codes = np.unique(np.concatenate([rng.integers(0, 1 << 63, 400, np.uint64), np.uint64(5) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))]))
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    index = simhash.GrayIndex(np.zeros(len(codes), int), codes)
    found = {tuple(sorted(p)) for u, v in index.near_pairs(4, lambda level, a, b: np.zeros(len(a), bool)) for p in zip(u.tolist(), v.tolist())}
    want = {(a, b) for a in range(len(codes)) for b in range(a + 1, len(codes)) if int(codes[a] ^ codes[b]).bit_count() <= 4}
    assert found == want
    assert all((np.diff(simhash.gray_rank(codes).astype(float)) > 0).tolist())


def test_components_of_a_hub_and_united_groups(spark):
    """A node with a third of all links, and further links joined to groups as if all links had come at once."""
    rng = random.Random(8)
    pairs = [(900, i) for i in range(300)] + [(rng.randint(0, 2000), rng.randint(0, 2000)) for _ in range(600)]
    first, more = pairs[:500], pairs[500:]
    links = [spark.createDataFrame(part, "u bigint, v bigint") for part in (pairs, first, more)]
    whole = dict(map(tuple, graph.components(links[0]).collect()))
    found = graph.united(graph.components(links[1]), links[2]).collect()
    assert len(found) == len(whole) and {r["node"]: r["root"] for r in found} == whole
    none = spark.createDataFrame([], "u bigint, v bigint")
    assert dict(map(tuple, graph.united(graph.components(none), links[0]).collect())) == whole
    assert dict(map(tuple, graph.united(graph.components(links[0]), none).collect())) == whole


def test_components(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)]
    pairs += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7), (1, 0)]
    found = dict(map(tuple, graph.components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()))
    root = roots(300, pairs)
    assert found == {x: root[x] for p in pairs for x in p if p[0] != p[1]}


def brute_repeats(rows, length):
    """Removed bytes per (identifier, text), judged string by string."""
    import zlib

    order = sorted({(1 if i is None else 0, i or 0, zlib.crc32((t or "").encode()) % (1 << 31), t or "") for i, t, *_ in rows})
    seen, gone = set(), {}
    for absent, i, _, text in order:
        data, flags = text.encode(), bytearray(len(text.encode()))
        for at in range(len(data) - length + 1):
            piece = data[at : at + length]
            if piece in seen:
                flags[at : at + length] = b"\1" * length
            seen.add(piece)
        gone[(None if absent else i, text)] = flags
    return gone


def check_repeats(docs, rows, length):
    gone = brute_repeats(rows, length)
    want = []
    for row in rows:
        data, flags = (row[1] or "").encode(), gone[(row[0], row[1] or "")]
        spans = sum(1 for a, b in zip(b"\0" + bytes(flags), flags) if not a and b)
        want.append((row[0], len(data), sum(flags), spans, bytes(x for x, f in zip(data, flags) if not f)))
    found = [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffix_dedup.remove_repeats(docs, length).collect()]
    assert Counter(found) == Counter(want)
    assert sum(r[2] for r in want) > 0


@pytest.mark.parametrize("length", [40, 100])
def test_repeats(messy, messy_rows, length):
    check_repeats(messy, messy_rows, length)


@pytest.mark.parametrize("block,here", [(1024, 16), (4, 16), (4, 2)])
def test_repeats_with_edits_and_frequent_passages(spark, monkeypatch, block, here):
    """Passages with many surroundings, texts of one letter, near copies, and blocks too small for them."""
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    monkeypatch.setattr(suffix_dedup, "MOST_HERE", here)
    rng = random.Random(9)
    passage, other = prose(rng, 30), prose(rng, 25)
    texts = [f"{prose(rng, 12)} {passage} {prose(rng, 12)}" for _ in range(40)] + [f"{other}{passage}" for _ in range(3)]
    texts += ["a" * n for n in (99, 100, 101, 500)] + ["ab" * 200, "ba" * 200, passage * 4]
    for _ in range(20):
        data = list(rng.choice(texts[:40]))
        data[rng.randrange(len(data))] = "é"
        texts.append("".join(data))
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    check_repeats(spark.createDataFrame(rows, SCHEMA).repartition(6), rows, 100)


def test_long_text_is_cut_with_overlap(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PORTION", 700)
    rng = random.Random(4)
    part = prose(rng, 200)
    rows = [(1, part + prose(rng, 300) + part, "en", "s", 0), (2, "x" + part[100:900], "en", "s", 0)]
    check_repeats(spark.createDataFrame(rows, SCHEMA), rows, 100)


def test_repeats_on_nothing(no_rows):
    assert suffix_dedup.remove_repeats(no_rows).collect() == []


def test_suffix_sort_sees_collisions(monkeypatch):
    """With a hash that is always equal every extension is wrong, and the next base is taken."""
    data = np.frombuffer(prose(random.Random(1), 200).encode(), np.uint8)
    start = np.arange(0, len(data) - 50, 7)
    size = np.full(len(start), 50)
    want = sorted(data[a : a + 50].tobytes() for a in start)
    real = suffix_dedup.PrefixHashes.of
    tried = []

    class Bad(suffix_dedup.PrefixHashes):
        def __init__(self, data, base=suffix_dedup.BASES[0]):
            super().__init__(data, base)
            tried.append(base)
            self.bad = base == suffix_dedup.BASES[0]

        def of(self, start, size):
            return np.zeros(len(start), np.uint64) if self.bad else real(self, start, size)

    monkeypatch.setattr(suffix_dedup, "PrefixHashes", Bad)
    order, _ = suffix_dedup.suffix_sort(data, start, size)
    assert [data[start[i] : start[i] + 50].tobytes() for i in order] == want
    assert len(tried) == 2

"""BPE and packing against the libraries, and sharding laws."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from changeloom.llm import bpe, packing, sharding

from .conftest import SCHEMA, prose

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["word", " two", "  ", " ", "\n", "\t", "\n\n ", "'s", "'re x", "42", "½", "漢字", "é́", ".", "...", " ", "\r\n", "<|endoftext|>", "\0", "—", "🙂", "x" * 50, " " * 30]


def texts():
    rng = random.Random(11)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    return made + ["a" * 3000, " " * 700 + "b", "\n" * 900, prose(rng, 900), "ab\n\n cd" * 200]


@pytest.mark.parametrize("chunk,overlap", [(1 << 15, 1 << 11), (64, 20), (31, 30), (7, 3)])
def test_bpe_equals_library(spark, chunk, overlap):
    library = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, None), (1, None), (5, "again " * 50), (5, "again " * 50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    coded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap)
    found = Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist()), bytes(r["decoded"])) for r in bpe.decode(coded, RANKS).collect())
    assert found == Counter((i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)


def test_bpe_edges(messy, messy_rows, no_rows):
    assert bpe.encode(no_rows, RANKS, public_tokenizers.PATTERN).collect() == []
    found = bpe.decode(bpe.encode(messy, RANKS, public_tokenizers.PATTERN, chunk=500, overlap=99), RANKS).collect()
    assert Counter((r["doc_id"], bytes(r["decoded"])) for r in found) == Counter((r[0], (r[1] or "").encode()) for r in messy_rows)
    with pytest.raises(ValueError):
        bpe.encode(no_rows, RANKS, public_tokenizers.PATTERN, chunk=5, overlap=5)


def test_rows_that_share_one_long_text(spark, monkeypatch):
    """A third of all rows hold one long text, with and without an identifier of their own."""
    monkeypatch.setattr(bpe, "ROWS_A_COPY", 100)
    shared, other = "one long text " * 20, "another long text " * 20
    rows = [(i % 7 if i % 2 else None, shared) for i in range(1000)] + [(i, f"short {i}") for i in range(1999)] + [(-1, other)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    decoded = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, chunk=100, overlap=20), RANKS).collect()
    assert Counter((r["doc_id"], bytes(r["decoded"]).decode()) for r in decoded) == Counter(rows)


def test_text_encoder_equals_library():
    library, own = Tokenizer.from_file(FILE), packing.text_encoder(FILE)
    for text in [*texts(), "", " ", "x <|endoftext|>y"]:
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def brute_cost(at, penalty, length):
    cost = [0.0] + [float("inf")] * (len(at) - 1)
    for j in range(1, len(at)):
        for i in range(j):
            size = at[j] - at[i]
            if size <= length:
                pad = 0 if size & (size - 1) == 0 else length - size
                cost[j] = min(cost[j], cost[i] + pad + penalty[j] + packing.SEQUENCE_COST)
    return cost[-1]


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(4)
    for length in (16, 20, 64):
        for _ in range(30):
            at = np.concatenate(([0], np.cumsum(rng.integers(1, 13, 60))))
            penalty = rng.choice([0, 6, 20], len(at)).astype(float)
            cuts = packing.best_cuts(at, penalty, length)
            assert cuts[0] == 0 and cuts[-1] == len(at) - 1 and cuts == sorted(set(cuts))
            total = 0.0
            for i, j in zip(cuts, cuts[1:]):
                size = at[j] - at[i]
                assert size <= length
                total += (0 if size & (size - 1) == 0 else length - size) + penalty[j] + packing.SEQUENCE_COST
            assert total == brute_cost(at, penalty, length)


@pytest.mark.parametrize("length", [64, 2048])
def test_packing(messy, messy_rows, length):
    library = Tokenizer.from_file(FILE)
    want = Counter((r[0], tuple([*library.encode(r[1] or "", add_special_tokens=False).ids, 1])) for r in messy_rows)
    rows = [r.asDict() for r in packing.pack(messy, FILE, length).collect()]
    for r in rows:
        r["ids"] = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(r["ids"]) == r["length"] > 0
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
    used = padded = 0
    for parts in sequences.values():
        parts.sort(key=lambda r: r["offset"])
        at = 0
        for r in parts:
            assert r["offset"] == at
            at += r["length"]
        assert at <= length
        used += at
        padded += at if at & (at - 1) == 0 else length
    assert used == sum(len(ids) for _, ids in want.elements())
    assert padded - used <= 0.05 * used + 4 * length
    # Pieces in packing order give the documents again, one after the other.
    found, held = Counter(), []
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["start"] == len(held)
        held += r["ids"]
        if len(held) == r["doc_tokens"]:
            found[(r["doc_id"], tuple(held))] += 1
            held = []
    assert not held and found == want


def test_packing_on_nothing(no_rows):
    assert packing.pack(no_rows, FILE).collect() == []
    with pytest.raises(ValueError):
        packing.pack(no_rows, FILE, 1)


def check_shards(found, rows, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows
    )
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("shards", [1, 4, 40, 97])
def test_shards(messy, messy_rows, shards):
    check_shards(sharding.balanced_shards(messy, shards).collect(), messy_rows, shards)


def test_shards_keep_groups_together(spark, no_rows):
    """A third of all rows are one text, others come in groups of three; few groups are cut, most of the large one is in four shards."""
    rng = random.Random(2)
    rows = [(i, "hot", None, None, 0) for i in range(400)]
    rows += [(400 + i, f"group {i // 3}", None, None, 0) for i in range(300)] + [(700 + i, prose(rng, 8), None, None, 0) for i in range(500)]
    found = sharding.balanced_shards(spark.createDataFrame(rows, SCHEMA).repartition(4), 10).collect()
    check_shards(found, rows, 10)
    text = {r[0]: r[1] for r in rows}
    where = defaultdict(Counter)
    for r in found:
        where[text[r["doc_id"]]][r["shard"]] += 1
    assert sum(n for _, n in where["hot"].most_common(4)) >= 0.8 * 400
    assert sum(len(where[f"group {i}"]) > 1 for i in range(100)) <= 15
    assert sharding.balanced_shards(no_rows, 10).collect() == []


def test_no_group_is_cut_where_none_has_to_be(spark):
    """Rows that are alone can fill every shard, so the fewest groups that must be cut are none; cuts are compared with that."""
    rng = random.Random(6)
    rows = []
    for g in range(60):
        rows += [(len(rows) + i, f"group {g}", None, None, 0) for i in range(rng.randint(2, 5))]
    rows += [(len(rows) + i, prose(rng, 8), None, None, 0) for i in range(400)]
    found = sharding.balanced_shards(spark.createDataFrame(rows, SCHEMA).repartition(3), 6).collect()
    check_shards(found, rows, 6)
    text, where = {r[0]: r[1] for r in rows}, defaultdict(set)
    for r in found:
        where[text[r["doc_id"]]].add(r["shard"])
    assert sum(len(s) > 1 for s in where.values()) == 0


def test_shards_without_room_for_all(spark):
    """Groups that fill the shards to the last row: some must be cut, none is lost, and the rounds end."""
    rows = [(i, f"group {i // 3}", None, None, 0) for i in range(40)]
    found = sharding.balanced_shards(spark.createDataFrame(rows, SCHEMA).repartition(3), 4).collect()
    check_shards(found, rows, 4)


def test_cutoffs_fill_the_room():
    """Draws are granted from the lowest on, up to the first that no longer fits."""
    asks = [{"target": t, "draw": d, "n": n} for t, d, n in [(0, 5, 3), (0, 2, 4), (0, 9, 1), (1, 0, 9), (2, 7, 2)]]
    assert sharding._cutoffs(asks, [7, 8, 2]) == {0: 6, 2: 8}

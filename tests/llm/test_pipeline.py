"""The pipeline on planted documents, and the registry."""

import random

import pytest

import corpus_pipeline
from changeloom.llm import queries

from .conftest import SCHEMA, prose


def test_registry():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_neardup", "suffix_dedup", "packing"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    rows, labels, bad = [], [], ["gleep", "snork", "blarg"]
    for i in range(400):
        words = prose(rng, 120, "abcdefghijklmn").split(" ")
        if i % 8 == 0:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(bad)
            labels.append((i, 1, 1))
        elif i % 3 == 0:
            labels.append((i, 1, 0))
        rows.append((i, " ".join(words), "en", "s", 0))
    clean = [r for r in rows if r[0] % 8]
    copies = [(1000 + k, r[1], "en", "s", 0) for k, r in enumerate(clean[:20])]
    near = [(2000 + k, r[1] + " end", "en", "s", 0) for k, r in enumerate(clean[20:40])]
    shared = "ü" + prose(rng, 80, "abcdefghijklmn")
    passages = [(3000 + k, f"{prose(rng, 60)} {shared} {prose(rng, 60)}", "en", "s", 0) for k in range(6)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows + copies + near + passages, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.stored(stage(spark, docs, corpus), f"test-{name}")
        assert docs.columns == corpus_pipeline.COLUMNS
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    toxic = set(range(0, 400, 8))
    assert len(toxic & set(kept["toxicity"])) <= 2
    assert len(set(kept["toxicity"])) >= 0.99 * (446 - len(toxic))
    assert not set(range(1000, 1020)) & set(kept["exact_dedup"])
    assert len(set(kept["exact_dedup"])) == len(set(kept["toxicity"])) - 20
    assert len(set(range(2000, 2020)) & set(kept["simhash_neardup"])) <= 2
    assert set(kept["exact_dedup"]) - set(kept["simhash_neardup"]) <= set(range(2000, 2020))
    assert set(kept["suffix_dedup"]) == set(kept["simhash_neardup"])
    before, after = kept["simhash_neardup"], kept["suffix_dedup"]
    assert all(len(after[3000 + k]) < 0.75 * len(before[3000 + k]) for k in range(1, 6))
    assert after[3000] == before[3000] and sum(after[i] == before[i] for i in range(400) if i in after) > 300
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, corpus).collect()
    assert {r["doc_id"] for r in pieces} == set(after)


def test_run(spark, corpus):
    assert corpus_pipeline.run(spark, corpus).count() > 300


def test_run_on_nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_copies_of_rows_are_compressed_more(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline._keyed(docs, "compressed")
    assert all(f.endswith(".zstd.parquet") for f in found.inputFiles()) and found.count() == 1

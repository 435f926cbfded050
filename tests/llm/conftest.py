import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside, as further columns of the input.
CLASHING = ["id", "key", "code", "hash", "kept", "n", "group", "shard", "doc", "tie", "first", "cell", "x0", "toxic_score", "nth"]


def word(rng, letters="abcdefgh"):
    return "".join(rng.choice(letters) for _ in range(rng.randint(2, 7)))


def prose(rng, words, letters="abcdefgh"):
    made = []
    for k in range(words):
        made.append(word(rng, letters) + ("." if rng.random() < 0.1 else ""))
    return " ".join(made) + "."


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls in every column, empty and very long texts, copies, near copies, ties and repeated rows."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(5, 120)) for _ in range(40)]
    texts = list(base)
    texts += [base[3], base[3].upper(), base[4], "", "", None, None, " \t\n ", "one", "Ünïcödé ß — 漢字 " * 3, "#%% $$ || &&" * 4]
    for t in base[10:16]:
        parts = t.split(" ")
        parts[len(parts) // 2] = "changed"
        texts.append(" ".join(parts))
    shared = prose(rng, 60)
    texts += [f"{prose(rng, 20)} {shared} {prose(rng, 20)}" for _ in range(5)]
    texts.append(prose(rng, 30_000))
    rows = [(i, t, ["en", "de", None][i % 3], ["s0", "s1", None][i % 2 + (i % 7 == 0)], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], rows[3], (7, base[20], None, None, None), (None, base[5], "en", "s0", 1), (None, base[5], "en", "s0", 1), (None, None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(messy_rows, SCHEMA).repartition(3)
    return docs.withColumns({name: F.lit("clash") for name in CLASHING})


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)

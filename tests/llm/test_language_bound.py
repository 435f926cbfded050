"""What a task may hold does not change the languages found."""

import random
from collections import Counter

from pyspark.sql import functions as F

from changeloom.llm import language

from .conftest import SCHEMA, prose


def test_bound_changes_nothing(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 30, "abcdefghijkl"), "aa", "s", 0) for i in range(60)]
    rows += [(100 + i, prose(rng, 20, "efghijklmnop"), "bb", "s", 0) for i in range(6)]
    rows += [(200, None, "aa", "s", 0), (201, "12", "bb", "s", 0), (None, "été zzzz", None, "s", 0), (0, "abc", "aa", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    whole, bound = (language.identify(docs, F.lit(True), most=most).collect() for most in (1 << 20, 50))
    name = lambda r: (r["doc_id"], r["lang_pred"], round(r["score"], 6))
    assert Counter(map(name, bound)) == Counter(map(name, whole)) and len(bound) == len(rows)
    assert {r["lang_pred"] for r in bound if r["doc_id"] in range(100, 106)} == {"bb"}

"""A pipeline over the table of documents: filter, deduplicate, remove repeats, pack.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns the documents it keeps, the last
one the pieces of packed sequences.  ``run`` applies them in order and writes each result to the shared folder before the next
stage reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import exact_dedup, near_copies, packing, suffix_dedup, toxicity
from changeloom.llm.common import stored
from changeloom.operators.joins import hot_key_join

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHINGLE_WORDS = 5
NEAR_SHARE = (4, 5)
REPEAT_BYTES = 100
SEQUENCE = 2048


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labels and drop documents that score 0.5 or more.

    A null or empty text is scored like any other; equal texts get equal scores, so repeated rows stay or go together.  Without
    labels of toxic documents, and in an empty table, nothing is dropped beyond what the scores say.
    """
    docs = docs.select(*COLUMNS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, F.lit(True))
    return toxicity.score(docs, model).where("toxic_score < 0.5").select(*COLUMNS)


def _keyed(docs: DataFrame, label: str) -> DataFrame:
    """The documents with ``row``, a number of each row that stays the same however often they are read.

    These copies stay while later stages run, so they are compressed more than other tables.
    """
    return stored(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), label, "zstd")


def _place() -> Column:
    """Order of rows by identifier, null last, and then by number."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, that with the smallest identifier; null counts as the largest."""
    rows = _keyed(docs, "copies-rows")
    found = exact_dedup.exact_dedup(rows.select(_place().alias("place"), "text"), id_col="place")
    return rows.join(found.where("kept").select("place.row"), "row", "left_semi").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, that with the smallest identifier; null counts as the largest.

    Rows are near copies when the Jaccard similarity of their five-word shingles is 0.8 or more.
    """
    rows = _keyed(docs, "near-rows")
    groups = near_copies.near_groups(rows.select(F.col("row").alias("id"), "text"), SHINGLE_WORDS, NEAR_SHARE)
    member = stored(rows.select(_place().alias("place"), "row").join(groups.withColumnRenamed("node", "row").hint("merge"), "row"), "near-members")
    first = member.groupBy("root").agg(F.min("place").alias("first"))
    extra = hot_key_join(member, first.hint("merge"), ["root"], "inner").where(F.col("row") != F.col("first.row")).select("row")
    return rows.join(extra, "row", "left_anti").select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that occurred earlier are cut out; a character of which a part is cut goes as a whole.

    Every row stays, with an empty text if all of it occurred earlier; a null text becomes the empty text.  Earlier is by identifier, null
    last, and of one identifier by a hash of the text; rows that repeat both are one document.  An empty table gives no rows.
    """
    found = suffix_dedup.remove_repeats(docs, length=REPEAT_BYTES, carry=("lang", "source"))
    text = F.try_validate_utf8(F.col("kept").cast("string"))
    whole = F.coalesce(text, F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "�", ""))
    return found.select("doc_id", whole.alias("text"), "lang", "source", F.char_length(whole).cast("long").alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens; one row per piece.

    A null or empty text gives the end id alone; repeated rows are packed as often as they occur; an empty table gives no rows.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), length=SEQUENCE)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_neardup", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# Trained classifiers and components over any number of links have no SQL form; tests compare with brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}

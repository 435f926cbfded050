"""Exact deduplication by content sort.

Sampled splitters range-partition the normalised texts, each partition is sorted externally so that
equal texts are neighbours, and neighbours are compared in full.  All steps are built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import hot_key_join
from .common import lower_ascii, stored, text_of

# Characters of a text that the splitters see; the rest of the order is a hash, so that a prefix
# which many texts share does not end up in one partition.
SPLIT_CHARS = 64
# Runs of one text are cut into so many parts, by the identifier.
SALTS = 256


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", salts: int = SALTS
) -> DataFrame:
    """One row per input row: identifier, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they are identical after lower-casing A-Z; a null text counts as empty.  Of each
    group the row with the smallest (or ``keep="largest"``) identifier stays.  A null identifier stays only
    where no other exists (``keep_id`` is then null).  Of rows that repeat identifier and text exactly one
    stays.  An empty table gives no rows; other columns are ignored.

    The only exchange that carries texts is the range partitioning.  Its order is (prefix, hash, salt),
    so a text that a third of all rows share is spread over ``salts`` runs; within a run, the window compares
    neighbours by their whole text.  Runs are merged by digest on narrow rows.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    best, order = (F.min, F.asc_nulls_last("id")) if keep == "smallest" else (F.max, F.desc_nulls_last("id"))
    rows = docs.select(F.col(id_col).alias("id"), lower_ascii(text_of(text_col)).alias("norm")).withColumns(
        {
            "head": F.substring("norm", 1, SPLIT_CHARS),
            "hash": F.xxhash64("norm"),
            "salt": F.pmod(F.xxhash64("id"), F.lit(salts)),
        }
    )
    run = Window.partitionBy("head", "hash", "salt", "norm")
    runs = rows.repartitionByRange("head", "hash", "salt").select(
        "id",
        F.row_number().over(run.orderBy(order)).alias("place"),
        F.count(F.lit(1)).over(run).alias("run_size"),
        F.sha2("norm", 256).alias("text_sha256"),
    )
    runs = stored(runs, "exact-runs")
    groups = (
        runs.where("place = 1")
        .groupBy("text_sha256")
        .agg(best("id").alias("keep_id"), F.sum("run_size").alias("group_size"))
    )
    return hot_key_join(runs, groups, ["text_sha256"], "inner").select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        ((F.col("place") == 1) & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )

"""Equi-joins that keep working when one key holds a large share of the rows.

Two ways to spread a hot key: :func:`salted_join` copies every row of a narrow right
side, :func:`hot_key_join` finds the hot keys first and copies only their rows.

No join here forces a broadcast: Spark's own size threshold decides, at planning
time or from the shuffle statistics at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_SALTS = 16


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Join a side with hot keys (``left``) to a narrow side (``right``).

    Left rows of one key are spread over ``salts`` tasks; every right row is
    copied once per salt, so each left row still meets each right row once.  The
    salt is the number of the input partition: it depends neither on the row
    values, so equal rows spread too, nor on the order in which rows arrive, so a
    recomputed task gives the same salt.
    """
    _check_side(how)
    spread = left.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    copied = right.withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return spread.join(copied, on=[*on, "__salt"], how=how).drop("__salt")


# A key is hot from this share of the rows on; there can be no more than this many.
HOT_SHARE = 256
HOT_SALTS = 1_024
TRACKED_PER_HOT_KEY = 5
# A hot key is cut into pieces of about this share of the rows, but of no fewer rows than the second number.
PIECE_SHARE = 1_024
PIECE_ROWS = 64


def _frequent(df: DataFrame, on: Sequence[str], share: int) -> tuple[DataFrame, Column]:
    """One row with ``n``, the number of rows, and a column of hashes and counts of the keys with at least ``1/share`` of them.

    One narrow pass with a frequent-items sketch of fixed size.  The sketch only
    decides how rows are spread, so a missed or a wrong key cannot change a result.
    """
    names = ", ".join(f"`{c}`" for c in on)
    tracked = share * TRACKED_PER_HOT_KEY
    sketch = F.expr(f"approx_top_k(xxhash64({names}), {share}, {tracked})")
    found = df.select(sketch.alias("top"), F.count(F.lit(1)).alias("n"))
    return found, F.filter("top", lambda t: t.getField("count") * share >= F.col("n"))


def hot_keys(df: DataFrame, on: Sequence[str], share: int = HOT_SHARE) -> Column:
    """Hashes of the keys with at least ``1/share`` of all rows, as a scalar subquery."""
    found, frequent = _frequent(df, on, share)
    return found.select(F.transform(frequent, lambda t: t.getField("item"))).scalar()


def hot_pieces(df: DataFrame, on: Sequence[str], salts: int, piece_rows: int = PIECE_ROWS) -> Column:
    """Hashes of the hot keys and the number of pieces, at most ``salts``, into which each is cut, as a scalar subquery.

    The numbers follow the rows of the keys, so all of them together are no more than ``PIECE_SHARE`` and one for each
    hot key, and far fewer for a small table, in which every key has a large share of the rows.
    """
    found, frequent = _frequent(df, on, HOT_SHARE)

    def pieces(t: Column) -> Column:
        n = t.getField("count")
        return F.least(F.lit(salts), F.ceil(n * PIECE_SHARE / F.col("n")), F.ceil(n / piece_rows)).cast("int")

    cut = F.transform(frequent, lambda t: F.struct(t.getField("item").alias("item"), pieces(t).alias("pieces")))
    return found.select(F.map_from_entries(F.filter(cut, lambda t: t.getField("pieces") > 1))).scalar()


def hot_key_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, salts: int = HOT_SALTS, piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """Join a side with hot keys (``left``) to a side that may be large itself.

    Left rows of hot keys are spread over up to ``salts`` tasks by their input partition,
    and only the right rows of those keys are copied, once for each piece of the key.
    No piece is made for fewer than ``piece_rows`` rows.
    """
    _check_side(how)
    hot = hot_pieces(left, on, salts, piece_rows)
    # Equal keys of different types hash differently, so both sides use the left types.
    alike = [F.col(c).try_cast(left.schema[c].dataType) for c in on]
    own, other = (F.coalesce(F.try_element_at(hot, F.xxhash64(*keys)), F.lit(1)) for keys in (on, alike))
    spread = left.withColumn("__salt", F.pmod(F.spark_partition_id(), own))
    copied = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), other - 1)))
    return spread.join(copied, on=[*on, "__salt"], how=how).drop("__salt")


def _check_side(how: str) -> None:
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("the copied side can only be the right side")


def detail_for_recent_headers(
    detail: DataFrame,
    header: DataFrame,
    detail_key: str,
    header_key: str,
    recent: Column,
) -> DataFrame:
    """Detail rows whose header passes ``recent``.

    The header key is unique, so the join only filters and is written as a semi
    join on the header keys; details of one very large header are spread.
    """
    keys = header.where(recent).select(F.col(header_key).alias(detail_key)).distinct()
    return hot_key_join(detail, keys, [detail_key], "left_semi").select(*detail.columns)


def parents_with_recent_children(
    parent: DataFrame,
    child: DataFrame,
    parent_key: str,
    child_key: str,
    recent: Column,
) -> DataFrame:
    """Distinct parent rows with at least one child that passes ``recent``.

    Child keys are made distinct before the shuffle, which removes hot parents.
    """
    keys = child.where(recent).select(F.col(child_key).alias(parent_key)).distinct()
    return parent.join(keys, on=parent_key, how="left_semi").select(*parent.columns)


def rows_in_subquery(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """``key IN (SELECT ...)``; ``keys`` has one column."""
    wanted = keys.toDF(key).distinct()
    return hot_key_join(df, wanted, [key], "left_semi").select(*df.columns)


def deletable_keys(
    parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, min_key
) -> DataFrame:
    """Parents above ``min_key`` with no child, newest key first."""
    used = child.select(F.col(child_key).alias(parent_key)).distinct()
    free = parent.where(F.col(parent_key) > F.lit(min_key)).join(
        used, on=parent_key, how="left_anti"
    )
    return free.select(*parent.columns).orderBy(F.col(parent_key).desc())


def multiply_rows(
    df: DataFrame, copies: int, number: str = "copy_no", limit: int | None = None, index=None
) -> DataFrame:
    """Each row ``copies`` times, numbered 1..copies, without a cross join.

    With ``limit``, ``index`` names an existing 0-based row number of ``df`` and
    exactly the first ``limit`` of the numbered copies are kept, each with its
    surrogate key ``row_key`` counted from 1.
    """
    many = df.withColumn(number, F.explode(F.sequence(F.lit(1), F.lit(copies))))
    if index is None:
        return many
    many = many.withColumn(
        "row_key", F.col(index) * F.lit(copies) + F.col(number)
    )
    return many.where(F.col("row_key") <= limit) if limit is not None else many

"""Source tables and table targets."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import latest_per_key, settling
from ..plans.snapshot import check_bounds


def sql_literal(value) -> str:
    """A value as standard SQL text."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"no SQL literal for {type(value).__name__}")


def range_predicates(key: str, bounds: Sequence[tuple]) -> list[str]:
    """One condition per key range; together they hold once for each row.  Null keys go to the first."""
    check_bounds(bounds)
    predicates = []
    for number, (lo, hi) in enumerate(bounds):
        parts = [f"{key} >= {sql_literal(lo)}"] if lo is not None else []
        parts += [f"{key} < {sql_literal(hi)}"] if hi is not None else []
        held = " AND ".join(parts) or "1 = 1"
        predicates.append(f"({held}) OR {key} IS NULL" if number == 0 and parts else held)
    return predicates


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str | None = None,
    bounds: Sequence[tuple] = (),
    **properties: str,
) -> DataFrame:
    """A database table, read as parallel key ranges when ``bounds`` are given."""
    if not bounds:
        return spark.read.jdbc(url, table, properties=properties)
    if not key:
        raise ValueError("bounds need the column they are for")
    predicates = range_predicates(key, bounds)
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def upsert_batch(
    batch: DataFrame, batch_id: int, target: str, pk: Sequence[str], order: Sequence[str]
) -> None:
    """Write one micro-batch of flattened rows: the latest row per key.

    Each attempt has its own directory, and readers see it once its entry in the list of finished parts is there, so
    half a batch is never read, a retry changes nothing and no earlier data is rewritten.  Where rows carry an
    operation, events that say nothing about a row are left out first, as in a batch.
    """
    rows = settling(batch) if "op" in batch.columns else batch
    deliver(latest_per_key(rows, pk, order), batch_id, target)


def deliver(rows: DataFrame, batch_id: int, target: str, partition_by: Sequence[str] = ()) -> None:
    """Add the rows of one batch to a target; :func:`delivered` reads them once all are written."""
    folder = f"{target.rstrip('/')}/batch_id={batch_id}/attempt={uuid.uuid4().hex}"
    rows.write.partitionBy(*partition_by).parquet(folder)
    _finish(rows.sparkSession, target, "batch", batch_id, folder)


def sink_upsert(change: DataFrame, target: str, pk: Sequence[str], order: Sequence[str], checkpoint: str):
    """Deliver a stream of flattened rows to ``target``; returns the query."""
    return (
        change.writeStream.foreachBatch(
            lambda batch, batch_id: upsert_batch(batch, batch_id, target, pk, order)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_upserted(
    spark: SparkSession,
    target: str,
    pk: Sequence[str],
    order: Sequence[str],
    deleted: str = "__deleted",
) -> DataFrame:
    """The table in ``target``: latest row per key over all batches, without deletes."""
    rows = delivered(spark, target)
    latest = latest_per_key(rows, pk, order)
    return latest.where(F.col(deleted) == "false").drop(deleted) if deleted in rows.columns else latest


def delivered(spark: SparkSession, target: str, partitioned: bool = False) -> DataFrame:
    """Rows of the newest base, if there is one, and of the finished batches after it.

    The parts are fixed when this is called: what is written or compacted later does not change the result.
    ``partitioned`` is for batches delivered with ``partition_by``: a filter on those columns then picks folders.
    """
    _, base, batches = _parts(spark, target)
    if partitioned and base is None:
        # The numbers of batch and attempt are part of the path, too.
        return spark.read.option("basePath", target).parquet(*batches.values()).drop("batch_id", "attempt")
    return _rows(spark, base, batches)


def _rows(spark: SparkSession, base: str | None, batches: dict[int, str]) -> DataFrame:
    folders = [batches[n] for n in sorted(batches)]
    later = spark.read.parquet(*folders) if folders else None
    if base is None:
        return later
    held = spark.read.parquet(base)
    return held if later is None else held.unionByName(later, allowMissingColumns=True)


_FINISHED = "kind string, number bigint, folder string, made timestamp"


def finished_folder(target: str) -> str:
    """Where the list of finished parts lies: one small file per part, added in one step."""
    return f"{target.rstrip('/')}-finished"


def _finish(spark: SparkSession, target: str, kind: str, number: int, folder: str) -> None:
    entry = spark.range(1).select(
        F.lit(kind).alias("kind"), F.lit(number).cast("long").alias("number"), F.lit(folder).alias("folder"), F.current_timestamp().alias("made")
    )
    entry.coalesce(1).write.mode("append").parquet(finished_folder(target))


def _parts(spark: SparkSession, target: str) -> tuple[int | None, str | None, dict[int, str]]:
    """Last batch in the newest finished base, the base's folder, and folders of finished batches after it."""
    try:
        entries = spark.read.schema(_FINISHED).parquet(finished_folder(target))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ValueError(f"no batch of {target} is finished") from error
    newest = entries.where("kind = 'base'").agg(F.max_by(F.struct("number", "folder"), F.struct("number", "made")).alias("n")).first()["n"]
    upto, base = (newest["number"], newest["folder"]) if newest else (None, None)
    later = entries.where("kind = 'batch'" + ("" if upto is None else f" AND number > {upto}"))
    found = later.groupBy("number").agg(F.max_by("folder", "made").alias("folder")).collect()
    return upto, base, {r["number"]: r["folder"] for r in found}


def base_folder(target: str) -> str:
    """Where compacted batches lie: beside the batches, so that a running sink is not disturbed."""
    return f"{target.rstrip('/')}-base"


def compact_target(spark: SparkSession, target: str, pk: Sequence[str], order: Sequence[str]) -> int | None:
    """Merge all finished batches so far into a new base, which readers use from then on; returns the last batch merged.

    The sink may go on writing: later batches are read on top of the base, and a batch that is not finished yet is not merged.
    Readers go over to the base in one step, when its entry is written.  Folders of merged batches and older bases may be removed
    once nobody reads them any more.
    """
    return compact_parts(spark, target, lambda rows: latest_per_key(rows, pk, order))


def compact_parts(spark: SparkSession, target: str, merge: Callable[[DataFrame], DataFrame]) -> int | None:
    """:func:`compact_target` for rows of any kind: ``merge`` gives the rows that stand for those of all parts."""
    upto, base, batches = _parts(spark, target)
    if not batches:
        return upto
    last = max(batches)
    folder = f"{base_folder(target)}/upto={last}"
    merge(_rows(spark, base, batches)).write.mode("overwrite").parquet(folder)
    _finish(spark, target, "base", last, folder)
    return int(last)

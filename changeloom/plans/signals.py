"""Backfills that signals start, narrow and stop.

Signals are a control log: one row per table and signal, few beside the rows they ask for.  What they ask for becomes a list of runs with
positions; each table is then read once for all its runs, as one plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_key_join
from .incremental import snapshot_schedule, with_chunks


@dataclass(frozen=True)
class Source:
    """A table that signals may name: its rows, key, live changes (key and position) and how it is cut into chunks."""

    rows: DataFrame
    pk: Sequence[str]
    live: DataFrame | None = None
    mode: str = "key_range"


@dataclass(frozen=True)
class Run:
    """One table of one signal.  ``chunks`` of the ``planned`` ones are read; the first opens at ``start``."""

    run_no: int
    offset: int
    collection: str
    condition: str | None
    start: int
    planned: int
    chunks: int


def plan_runs(signals: DataFrame, chunks: Mapping[str, int], length: int) -> list[Run]:
    """Runs in order, from accepted signals and the number of chunks of each table.

    Tables are read one after the other: a run opens at its signal's offset or where the run before it ended.  Each chunk is open for
    ``length`` positions.  A stop behind the signal ends the run after the chunk that is open then, and cancels a run that has not begun;
    earlier stops do not touch it.  Signals for tables that are not in ``chunks`` start nothing and get no number.
    """
    wanted = snapshot_schedule(signals.where(F.col("collection").isin(*chunks)))
    stops = signals.where(F.col("accepted") & (F.col("type") == "stop-snapshot")).select("collection", F.col("offset").alias("stop"))
    ahead = wanted.join(stops, (wanted["collection"] == stops["collection"]) & (F.col("stop") > wanted["offset"]), "left")
    first = ahead.groupBy("run_no", "offset", wanted["collection"], "condition").agg(F.min("stop").alias("stop"))
    found, end = [], 0
    for r in sorted(first.collect(), key=lambda r: r["run_no"]):
        start, planned = max(end, r["offset"]), chunks[r["collection"]]
        held = planned
        if r["stop"] is not None:
            held = 0 if r["stop"] < start else min(planned, (r["stop"] - start) // length + 1)
        end = start + held * length
        found.append(Run(r["run_no"], r["offset"], r["collection"], r["condition"], start, planned, held))
    return found


def _chunk_count(numbered: DataFrame) -> int:
    last = numbered.agg(F.max("chunk_id")).first()[0]
    return 0 if last is None else last + 1


def run_reads(numbered: DataFrame, runs: Sequence[Run], length: int) -> DataFrame:
    """Rows with ``chunk_id`` once per run that reads them, with ``run_no, open_pos, close_pos``.

    One scan serves all runs of a table: each row meets the conditions of its runs, which are compiled into the plan.
    """
    asked = [
        F.when(
            (F.expr(f"({run.condition})") if run.condition else F.lit(True)) & (F.col("chunk_id") < run.chunks),
            F.struct(F.lit(run.run_no).cast("long").alias("run_no"), F.lit(run.start).cast("long").alias("start")),
        )
        for run in runs
    ]
    held = F.filter(F.array(*asked).cast("array<struct<run_no:bigint,start:bigint>>"), lambda x: x.isNotNull())
    opened = F.col("__run.start") + F.col("chunk_id") * length
    return numbered.withColumn("__run", F.explode(held)).select(
        *numbered.columns, F.col("__run.run_no").alias("run_no"), opened.alias("open_pos"), (opened + (length - 1)).alias("close_pos")
    )


def signal_backfill(
    sources: Mapping[str, Source], signals: DataFrame, size: int, length: int, position: str = "lsn", done: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Per table the reads that all its runs keep: its columns, ``run_no``, ``chunk_id``, ``op`` and the close position.

    ``signals`` are those of ``parse_signals``.  A read is dropped where a live change of its key lies between the positions at which its chunk
    was open.  ``done`` lists chunks (``collection, run_no, chunk_id``) finished before a restart; they are not read again.  A table
    without rows or without runs gives no reads; a null condition reads all rows, and a row for which a condition is null is not read.
    The wide rows are shuffled once, to leave out stale ones; everything before that is narrow.
    """
    numbered = {name: with_chunks(s.rows, list(s.pk), size, s.mode) for name, s in sources.items()}
    runs = plan_runs(signals, {name: _chunk_count(df.select("chunk_id")) for name, df in numbered.items()}, length)
    found = {}
    for name, source in sources.items():
        keys = list(source.pk)
        reads = run_reads(numbered[name], [r for r in runs if r.collection == name and r.chunks], length)
        if done is not None:
            finished = done.where(F.col("collection") == name).select("run_no", "chunk_id").distinct()
            reads = reads.join(finished, ["run_no", "chunk_id"], "left_anti")
        if source.live is not None:
            live = source.live.select(*keys, F.col(position).alias("__pos"))
            touched = reads.select(*keys, "run_no", "open_pos", "close_pos").join(live.select(*keys).distinct(), keys, "left_semi")
            # A key may hold a large share of the changes.
            met = hot_key_join(live, touched, keys, "inner").where(F.col("__pos").between(F.col("open_pos"), F.col("close_pos")))
            reads = reads.join(met.select(*keys, "run_no").distinct(), [*keys, "run_no"], "left_anti")
        found[name] = reads.select(
            *source.rows.columns, "run_no", "chunk_id", F.lit("r").alias("op"), F.col("close_pos").alias(position)
        )
    return found

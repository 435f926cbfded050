"""Newest row per key as keyed state from which deleted keys go again.

State holds one position per live key.  A delete leaves a tombstone, so that an older event that comes after it does not
bring the row back; the tombstone goes once the watermark has passed the delete, because older events are then dropped as
late before they reach the state.  So the state grows with the live keys and with the deletes of one delay, not with all
keys ever seen.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.decode import LIVE_OPS
from ..operators.state import settling
from ..sources.tables import deliver

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _rank(position: Iterable) -> tuple:
    """Positions compare column by column; null comes first."""
    return tuple((x is not None, x) for x in position)


class _Newest(StatefulProcessor):
    """Emits a key's newest event when it is newer than the one held."""

    def __init__(self, order: Sequence[str], held: T.StructType, op: str, ts: str) -> None:
        self.order, self.held, self.op, self.ts = list(order), held, op, ts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", self.held)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest = max(rows, key=lambda r: _rank(r[c] for c in self.order))
        at = tuple(newest[c] for c in self.order)
        known = self.latest.get() if self.latest.exists() else None
        if known is not None and _rank(at) <= _rank(known[:-1]):
            return
        until = 0
        if newest[self.op] not in LIVE_OPS:
            # A tombstone for as long as an older event may come.
            until = int(newest[self.ts].timestamp() * 1000) + 1
            self.handle.registerTimer(until)
        self.latest.update((*at, until))
        yield newest

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # Only the timer of the tombstone that is held: the key may live again, or be deleted again later.
        if self.latest.exists() and self.latest.get()[-1] == expiredTimerInfo.getExpiryTimeInMs():
            self.latest.clear()
        return iter(())

    def close(self) -> None:
        pass


def newest_in_task(change: DataFrame, pk: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of the rows that a task reads together, the newest of each key: a hot key sends few rows to its state."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            table = pa.Table.from_batches([batch])
            ranked = table.take(pc.sort_indices(table, [(c, "ascending") for c in order], null_placement="at_start"))
            numbered = ranked.select(list(pk)).append_column("__row", pa.array(range(ranked.num_rows), pa.int64()))
            last = numbered.group_by(list(pk)).aggregate([("__row", "max")])["__row_max"]
            yield from ranked.take(last).combine_chunks().to_batches()

    return change.mapInArrow(batches, change.schema)


def latest_updates(
    change: DataFrame, pk: Sequence[str], order: Sequence[str], ts: str, delay: str = "1 minute", op: str = "op"
) -> DataFrame:
    """Events of a stream that are newer than all before them of their key, deletes too; for update mode.

    Events say nothing about a row where ``settling`` leaves them out.  Events older than ``delay`` before the newest
    ``ts`` are dropped (``StreamTotals`` counts them); rows without a key share one, rows without a position are older than
    others and rows without a time are left out.  Of equal positions the first stays.  ``order`` columns are plain values.
    """
    rows = (settling(change) if op == "op" else change).where(F.col(ts).isNotNull())
    timed = newest_in_task(rows, pk, order).withWatermark(ts, delay)
    held = T.StructType([*[rows.schema[c] for c in order], T.StructField("__until", T.LongType())])
    held = T.StructType([T.StructField(f.name, f.dataType, True) for f in held])
    return timed.groupBy(*pk).transformWithState(
        statefulProcessor=_Newest(order, held, op, ts), outputStructType=rows.schema, outputMode="Update", timeMode="EventTime"
    )


def latest_stream(
    change: DataFrame, target: str, pk: Sequence[str], order: Sequence[str], ts: str, checkpoint: str, delay: str = "1 minute", op: str = "op"
):
    """Deliver the events of :func:`latest_updates` batch by batch; returns the query.  ``live_rows`` reads the table.

    State of this kind needs the RocksDB store; other streams of the session keep the store they have.
    """
    spark = change.sparkSession
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        return (
            latest_updates(change, pk, order, ts, delay, op)
            .writeStream.foreachBatch(lambda batch, number: deliver(batch, number, target))
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(_PROVIDER, before)


def held_keys(spark, checkpoint: str) -> DataFrame:
    """What the state of :func:`latest_stream` holds: key, position, and until when (0: a live row)."""
    found = spark.read.format("statestore").option("stateVarName", "latest").load(checkpoint)
    return found.select("key.*", "value.*")

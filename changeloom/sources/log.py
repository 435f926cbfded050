"""Topic logs: read, select, position, take and publish.

A log is either a Kafka cluster, when the connector is on the class path, or a
directory of parquet files in the same columns.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.blocks import Key, row_index
from ..operators.state import assign_partition
from ..schema import LOG_SCHEMA


def read_log(
    spark: SparkSession,
    path: str | None = None,
    bootstrap: str | None = None,
    topics: Sequence[str] = (),
    stream: bool = False,
    position: str | dict = "earliest",
    **options: str,
) -> DataFrame:
    """Topic records, in batch or as a stream; key and value are bytes.

    A parquet log lies in one folder per topic, so only the folders of ``topics`` are read.
    """
    reader = spark.readStream if stream else spark.read
    if bootstrap:
        starting = position if isinstance(position, str) else json.dumps(position)
        return (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", starting)
            .options(**options)
            .load()
            .drop("timestampType")
        )
    log = reader.schema(LOG_SCHEMA).options(**options).parquet(path).select(*LOG_SCHEMA.names)
    log = log.where(F.col("topic").isin(*topics)) if topics else log
    return from_position(log, position)


def select_topics(log: DataFrame, names: Sequence[str], topics: dict[str, str]) -> DataFrame:
    """Records of the tables in ``names``, given the topic of each short name."""
    missing = [n for n in names if n not in topics]
    if missing:
        raise ValueError(f"unknown tables: {missing}")
    return log.where(F.col("topic").isin(*[topics[n] for n in names]))


def from_position(log: DataFrame, position: str | dict = "earliest", rest: str = "earliest") -> DataFrame:
    """Records from ``earliest``, ``latest`` or ``{topic: {partition: offset}}`` on.

    Partitions of a named topic for which no offset is given are read from their start, or, with ``rest='drop'``,
    left out.  Topics not named are left out.

    ``latest`` starts after the last record that exists, so a batch gives none; on
    Kafka, pass it to :func:`read_log`, which hands it to the connector.
    """
    if position == "earliest":
        return log
    if position == "latest":
        if log.isStreaming:
            raise ValueError("a file stream cannot start at its end; give offsets")
        return log.where(F.lit(False))
    keep: Column = F.lit(False)
    if rest not in ("earliest", "drop"):
        raise ValueError("rest is 'earliest' or 'drop'")
    for topic, partitions in position.items():
        unnamed = ~F.col("partition").isin(*[int(p) for p in partitions])
        reached = unnamed if rest == "earliest" else F.lit(False)
        for partition, offset in partitions.items():
            reached = reached | ((F.col("partition") == int(partition)) & (F.col("offset") >= int(offset)))
        keep = keep | ((F.col("topic") == topic) & reached)
    return log.where(keep)


def take_messages(log: DataFrame, n: int) -> DataFrame:
    """The first ``n`` messages that have a value, in arrival order."""
    return (
        log.where(F.col("value").isNotNull())
        .orderBy("timestamp", "topic", "partition", "offset")
        .limit(n)
    )


def to_record(change: DataFrame, pk: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Add key and value text; a tombstone has no value."""
    key = F.to_json(F.struct(*pk))
    value = F.to_json(F.struct(*fields))
    if "is_tombstone" in change.columns:
        value = F.when(~F.col("is_tombstone"), value)
    return change.select("*", key.alias("key"), value.alias("value"))


def publish(
    change: DataFrame,
    pk: Sequence[str],
    partitions: int,
    order: Sequence[Key],
    block: Sequence[Key],
    topic: str = "topic",
    timestamp: str = "timestamp",
    by_value: bool = False,
) -> DataFrame:
    """Log records with partition and gapless offsets.

    ``change`` needs topic, timestamp, key and value.  Offsets follow ``order``
    within each partition and are numbered in blocks, because a log has few
    partitions and each may hold any number of records.
    """
    placed = assign_partition(change, pk, partitions, by_value=by_value)
    numbered = row_index(placed, [topic, "partition"], order, block, "offset")
    return numbered.select(
        F.col(topic).alias("topic"),
        "partition",
        "offset",
        F.col(timestamp).alias("timestamp"),
        "key",
        "value",
    )


def write_log(
    log: DataFrame, path: str | None = None, bootstrap: str | None = None, batch: str | None = None
) -> None:
    """Add records to a parquet log, one folder per topic, or send them to Kafka.

    A ``batch`` has a folder of its own in each topic, which a retry replaces; without one, records are appended and a
    retry repeats them.
    """
    if bootstrap:
        (
            log.select("topic", "partition", "key", "value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .save()
        )
        return
    names = [f.name for f in LOG_SCHEMA]
    stored = log.select(
        *[F.col(f.name).cast(f.dataType) for f in LOG_SCHEMA],
        *[c for c in log.columns if c not in names],
        F.lit(batch or "").alias("batch"),
    )
    writer = stored.write.partitionBy("topic", "batch")
    if batch is None:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)

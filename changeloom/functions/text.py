"""Names, times and text forms shown to people."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation codes and the names shown for them.
OPERATION_NAMES = {"r": "SNAPSHOT", "c": "INSERT", "u": "UPDATE", "d": "DELETE"}


def op_name(op: Column) -> Column:
    """Name of an operation code; ``UNKNOWN(x)`` for others, ``?`` for a missing one."""
    code = F.coalesce(op, F.lit("?"))
    named = None
    for key, text in OPERATION_NAMES.items():
        hit = code == key
        named = F.when(hit, text) if named is None else named.when(hit, text)
    return named.otherwise(F.concat(F.lit("UNKNOWN("), code, F.lit(")")))


def table_short_name(topic: Column) -> Column:
    """Last part of a topic of four parts or more, otherwise the whole topic."""
    parts = F.split(topic, r"\.")
    return F.when(F.size(parts) >= 4, F.element_at(parts, -1)).otherwise(topic)


def topic_parts(topic: Column) -> Column:
    """Struct of prefix, db, schema and table for three- and four-part topics."""
    parts = F.split(topic, r"\.")
    deep = F.size(parts) >= 4
    return F.struct(
        F.get(parts, F.lit(0)).alias("prefix"),
        F.when(deep, F.get(parts, F.lit(1))).alias("db"),
        F.when(F.size(parts) >= 3, F.get(parts, F.size(parts) - 2)).alias("schema"),
        F.element_at(parts, -1).alias("table"),
    )


def format_ts_ms(ts_ms: Column) -> Column:
    """Epoch milliseconds as ``yyyy-MM-dd HH:mm:ss``; ``N/A`` when missing."""
    text = F.date_format(F.timestamp_millis(ts_ms), "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(text, F.lit("N/A"))


def duration_text(seconds: Column) -> Column:
    """``Ns``, ``Nm Ns`` or ``Nh Nm``; ``--`` when the duration is unknown."""
    whole = seconds.cast("long")
    minutes = F.floor(whole / 60).cast("string")
    hours = F.floor(whole / 3600).cast("string")
    return (
        F.when(whole.isNull(), "--")
        .when(whole < 60, F.concat(whole.cast("string"), F.lit("s")))
        .when(
            whole < 3600,
            F.concat(minutes, F.lit("m "), (whole % 60).cast("string"), F.lit("s")),
        )
        .otherwise(
            F.concat(
                hours, F.lit("h "), F.floor((whole % 3600) / 60).cast("string"), F.lit("m")
            )
        )
    )

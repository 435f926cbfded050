"""From log records to change rows, and from change rows to what people read.

Everything is a projection of built-in expressions, so all functions also work on
streaming frames and fuse into the scan stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    decode_decimal,
    format_ts_ms,
    op_name,
    table_short_name,
    wire_body,
    wire_is_framed,
    wire_schema_id,
)
from ..schema import CAPTURED_TABLES, MONEY_SCALES, USER_EVENT_SCHEMA, TableSpec, envelope_schema

KNOWN_OPS = ("r", "c", "u", "d")
LIVE_OPS = ("r", "c", "u")

# Fixed value: the line shown for a tombstone.
TOMBSTONE_TEXT = "Tombstone message (null value) — used for log compaction"


def _ddl(schema: T.StructType) -> str:
    return schema.simpleString()


def decode_json(
    log: DataFrame,
    row_schema: T.StructType,
    wrapped: bool = True,
    pk: Sequence[str] = (),
) -> DataFrame:
    """Decode envelope text into canonical change rows.

    ``wrapped`` messages are ``{"schema": ..., "payload": {...}}``; only the payload
    is parsed.  With ``pk``, a struct column of that name is added, taken from the
    row images and, for tombstones, from the record key.
    """
    envelope = envelope_schema(row_schema)
    shape = T.StructType([T.StructField("payload", envelope)]) if wrapped else envelope
    parsed = F.from_json(F.col("value").cast("string"), _ddl(shape))
    event = parsed.getField("payload") if wrapped else parsed
    columns = [c for c in log.columns if c != "value"]
    decoded = log.select(*columns, event.alias("__e"), F.col("value").isNull().alias("is_tombstone"))
    change = decoded.select(
        *columns,
        F.coalesce(F.col("__e.source.table"), table_short_name(F.col("topic"))).alias("table"),
        F.col("__e.op").alias("op"),
        F.when(~F.col("is_tombstone"), op_name(F.col("__e.op"))).alias("op_name"),
        F.col("__e.ts_ms").alias("ts_ms"),
        F.timestamp_millis(F.col("__e.ts_ms")).alias("ts"),
        F.col("__e.source.commit_lsn").alias("lsn"),
        F.col("__e.source").alias("source"),
        F.col("__e.before").alias("before"),
        F.col("__e.after").alias("after"),
        "is_tombstone",
    )
    return with_pk(change, row_schema, pk, wrapped) if pk else change


def with_pk(change, row_schema, pk, wrapped=True):
    """Add the ``pk`` struct from ``after``, else ``before``, else the record key."""
    key_type = T.StructType([row_schema[name] for name in pk])
    key_shape = T.StructType([T.StructField("payload", key_type)]) if wrapped else key_type
    from_key = F.from_json(F.col("key").cast("string"), _ddl(key_shape))
    from_key = from_key.getField("payload") if wrapped else from_key

    def image(side):
        return F.when(
            F.col(side).isNotNull(), F.struct(*[F.col(f"{side}.{n}").alias(n) for n in pk])
        )

    return change.withColumn("pk", F.coalesce(image("after"), image("before"), from_key))


def split_wire_header(log: DataFrame, column: str = "value") -> DataFrame:
    """Add ``magic_ok``, ``schema_id``, ``body`` and ``body_size`` of framed bytes."""
    raw = F.col(column)
    framed = F.coalesce(wire_is_framed(raw), F.lit(False))
    return log.select(
        "*",
        framed.alias("magic_ok"),
        F.when(framed, wire_schema_id(raw)).alias("schema_id"),
        F.when(framed, wire_body(raw)).alias("body"),
        F.when(framed, F.octet_length(raw) - 5).cast("long").alias("body_size"),
    )


def envelope_meta(change: DataFrame) -> DataFrame:
    """Add source db, schema, table, log position (``?`` if missing) and shown time."""
    return change.select(
        "*",
        F.col("source.db").alias("source_db"),
        F.col("source.schema").alias("source_schema"),
        F.col("source.table").alias("source_table"),
        F.coalesce(F.col("source.commit_lsn"), F.lit("?")).alias("commit_lsn"),
        format_ts_ms(F.col("ts_ms")).alias("shown_ts"),
    )


def classify(log: DataFrame, op: str = "op", value: str = "value") -> DataFrame:
    """Flag tombstones, events and events with an unknown operation."""
    empty = F.col(value).isNull()
    known = F.coalesce(F.col(op).isin(*KNOWN_OPS), F.lit(False))
    return log.select(
        "*",
        empty.alias("is_tombstone"),
        (~empty).alias("is_event"),
        (~empty & ~known).alias("is_unknown_op"),
    )


def _row_type(change: DataFrame, image: str) -> T.StructType:
    return change.schema[image].dataType


def _shown_fields(row: T.StructType, spec: TableSpec | None) -> list[str]:
    wanted = spec.display if spec and spec.display else row.fieldNames()
    return [name for name in wanted if name in row.fieldNames()]


def _shown_value(image: str, row: T.StructType, name: str, spec: TableSpec | None) -> Column:
    value = F.col(f"{image}.`{name}`")
    scales = spec.decimal_scales if spec else MONEY_SCALES
    if name in scales:
        value = decode_decimal(value, row[name].dataType, scales[name])
    return value


def key_fields(
    change: DataFrame, table: str, image: str = "after", specs: dict | None = None
) -> DataFrame:
    """Add a struct of the columns shown for ``table``, decimals decoded.

    A table without settings shows all its columns; money columns are known by name.
    """
    spec = (specs or CAPTURED_TABLES).get(table)
    row = _row_type(change, image)
    fields = [
        _shown_value(image, row, name, spec).alias(name) for name in _shown_fields(row, spec)
    ]
    return change.withColumn(
        f"{image}_shown", F.when(F.col(image).isNotNull(), F.struct(*fields))
    )


def changed_fields(
    change: DataFrame,
    cols: Sequence[str] | None = None,
    before: str = "before",
    after: str = "after",
    out: str = "changed",
) -> DataFrame:
    """Add a map of field to ``old -> new`` for fields that differ, null-safe.

    An empty map means no visible change.  Rows that are not updates get null.
    """
    names = list(cols) if cols else _row_type(change, after).fieldNames()
    entries = [
        F.when(
            ~F.col(f"{before}.`{n}`").eqNullSafe(F.col(f"{after}.`{n}`")),
            F.struct(
                F.lit(n).alias("key"),
                F.concat(
                    F.coalesce(F.col(f"{before}.`{n}`").cast("string"), F.lit("None")),
                    F.lit(" -> "),
                    F.coalesce(F.col(f"{after}.`{n}`").cast("string"), F.lit("None")),
                ).alias("value"),
            ),
        )
        for n in names
    ]
    differing = F.map_from_entries(F.filter(F.array(*entries), lambda e: e.isNotNull()))
    return change.withColumn(out, F.when(F.col("op") == "u", differing))


def render_summary(
    change: DataFrame,
    table: str | None = None,
    specs: dict | None = None,
    out: str = "summary",
) -> DataFrame:
    """Add the line a person reads for each event.

    ``change`` needs table, op, ts_ms, lsn, before, after and is_tombstone.
    """
    spec = (specs or CAPTURED_TABLES).get(table) if table else None
    shown = key_fields(key_fields(change, table or "", "before", specs), table or "", "after", specs)
    names = _shown_fields(_row_type(change, "after"), spec)
    shown = changed_fields(shown, names, "before_shown", "after_shown", "__diff")
    head = F.concat(F.lit("["), F.col("table"), F.lit("] "))
    title = F.concat_ws(
        " | ",
        F.concat(head, op_name(F.col("op"))),
        format_ts_ms(F.col("ts_ms")),
        F.concat(F.lit("LSN: "), F.coalesce(F.col("lsn"), F.lit("?"))),
    )

    def text(column):
        return F.coalesce(F.to_json(F.col(column)), F.lit("{}"))

    def labelled(label, column):
        return F.concat(F.lit(label), text(column))

    detail = (
        F.when(F.col("op").isin("c", "r"), labelled("NEW: ", "after_shown"))
        .when(
            (F.col("op") == "u") & (F.size("__diff") > 0),
            F.concat(F.lit("CHANGED: "), F.to_json("__diff")),
        )
        .when(
            F.col("op") == "u",
            F.concat(
                labelled("AFTER: ", "after_shown"),
                F.lit(" (no visible changes in display fields)"),
            ),
        )
        .when(F.col("op") == "d", labelled("DELETED: ", "before_shown"))
        .otherwise(
            F.concat(labelled("BEFORE: ", "before"), F.lit(" "), labelled("AFTER: ", "after"))
        )
    )
    line = F.when(
        F.col("is_tombstone"),
        F.concat(head, F.lit(TOMBSTONE_TEXT)),
    ).otherwise(F.concat_ws(" | ", title, detail))
    return shown.withColumn(out, line).drop("__diff", "before_shown", "after_shown")


def unwrap(
    change: DataFrame,
    drop_tombstones: bool = True,
    deletes: str = "rewrite",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Flatten to the new row.

    ``deletes='rewrite'`` keeps the before image of deletes and adds ``__deleted``;
    ``'drop'`` removes deletes; ``'none'`` leaves them as rows of nulls.
    ``keep`` names envelope columns to carry along.
    """
    if deletes not in ("rewrite", "drop", "none"):
        raise ValueError(f"unknown delete handling {deletes!r}")
    rows = change
    if drop_tombstones:
        rows = rows.where(~F.col("is_tombstone"))
    if deletes == "drop":
        rows = rows.where(F.coalesce(F.col("op") != "d", F.lit(True)))
    image = F.col("after")
    if deletes == "rewrite":
        image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    names = _row_type(change, "after").fieldNames()
    staged = rows.withColumn("__image", image)
    columns = [*keep, *[F.col(f"__image.`{n}`").alias(n) for n in names]]
    if deletes == "rewrite":
        gone = F.coalesce(F.col("op") == "d", F.lit(False))
        columns.append(F.when(gone, "true").otherwise("false").alias("__deleted"))
    return staged.select(*columns)


def flatten_user_event(log: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Decode the flat event of five text fields."""
    event = F.from_json(F.col("value").cast("string"), _ddl(USER_EVENT_SCHEMA))
    return log.select(*keep, event.alias("__e")).select(*keep, "__e.*")

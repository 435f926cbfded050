"""Checks of logs and copies against their source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .blocks import Key, long_block, previous
from .decode import split_wire_header


def wire_format_audit(log: DataFrame) -> DataFrame:
    """Per topic: framed and unframed messages, and messages per schema id."""
    return (
        split_wire_header(log)
        .groupBy("topic", "magic_ok", "schema_id")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


def reconcile_counts(
    source: DataFrame, log: DataFrame, target: DataFrame, table: str = "table"
) -> DataFrame:
    """Per table: source rows, log messages, target rows, deltas and whether they match.

    The three sides are counted in one aggregation of their union.
    """

    def side(df, name):
        return df.select(
            F.col(table),
            *[
                F.lit(1 if name == s else 0).cast("long").alias(s)
                for s in ("source_rows", "log_messages", "target_rows")
            ],
        )

    stacked = (
        side(source, "source_rows")
        .unionByName(side(log, "log_messages"))
        .unionByName(side(target, "target_rows"))
    )
    counted = stacked.groupBy(table).agg(
        *[F.sum(c).alias(c) for c in ("source_rows", "log_messages", "target_rows")]
    )
    return counted.select(
        "*",
        (F.col("log_messages") - F.col("source_rows")).alias("log_delta"),
        (F.col("target_rows") - F.col("source_rows")).alias("target_delta"),
        (F.col("target_rows") == F.col("source_rows")).alias("matches"),
    )


def log_inflation(counts: DataFrame) -> DataFrame:
    """Add log messages per source row to the result of :func:`reconcile_counts`."""
    return counts.withColumn(
        "inflation",
        F.when(F.col("source_rows") > 0, F.col("log_messages") / F.col("source_rows")),
    )


def row_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that differ between two copies, as a multiset, in one shuffle.

    ``surplus`` above 0 counts copies only on the left, below 0 only on the right.
    """
    names = left.columns
    stacked = left.select(*names, F.lit(1).cast("long").alias("__side")).unionByName(
        right.select(*names, F.lit(-1).cast("long").alias("__side"))
    )
    summed = stacked.groupBy(*names).agg(F.sum("__side").alias("surplus"))
    return summed.where(F.col("surplus") != 0)


# Leaves of the first and, inside one that differs, of the second level of :func:`digest_difference`.
LEAVES = 4_096
TWIGS = 4_096


def digests(df: DataFrame, names: Sequence[str], by: Sequence[Key]) -> DataFrame:
    """Row count and two order-free 64-bit sums per group: equal multisets of rows have equal digests.

    Sums are exact (as decimals), of two independent hashes of the row, so that sets of rows that differ agree in both
    with a chance of about 2**-128 at the same count.
    """
    spread = [F.xxhash64(F.lit(seed), F.struct(*names)).cast("decimal(20,0)") for seed in (1, 2)]
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(h).alias(f"digest{i}") for i, h in enumerate(spread, 1)]
    )


def digest_difference(left: DataFrame, right: DataFrame, key: Sequence[str], leaves: int = LEAVES, twigs: int = TWIGS) -> DataFrame:
    """:func:`row_difference` of two large copies that are mostly equal, without shuffling the rows on which they agree.

    Two levels of digests over hash ranges of the key, opened only where the sides differ: one row per leaf and task is shuffled,
    then one per twig of the leaves that differ, then the rows of twigs that differ.  The two narrow levels run when the plan is
    built; what reaches the driver is at most ``leaves`` numbers, and ``leaves * twigs`` pairs stay a table.  Rows may repeat, and
    key and other columns may be null.
    """
    names = left.columns
    code = F.xxhash64(*key)
    leaf = F.pmod(code, F.lit(leaves)).cast("int")
    twig = F.pmod(F.shiftright(code, 32), F.lit(twigs)).cast("int")
    sides = [d.select(*names).withColumn("__leaf", leaf).withColumn("__twig", twig) for d in (left, right)]

    def differing(found: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
        facts = ["rows", "digest1", "digest2"]
        signed = [digests(d, names, by).select(*by, *[(F.col(c) * sign).alias(c) for c in facts]) for d, sign in zip(found, (1, -1))]
        net = signed[0].unionByName(signed[1]).groupBy(*by).agg(*[F.sum(c).alias(c) for c in facts])
        return net.where((F.col("rows") != 0) | (F.col("digest1") != 0) | (F.col("digest2") != 0)).select(*by)

    opened = [r["__leaf"] for r in differing(sides, ["__leaf"]).collect()]
    # As literals, the leaves are tested inside the scan's stage, before any exchange.
    inside = [d.where(F.col("__leaf").isin(opened) if opened else F.lit(False)) for d in sides]
    if len(opened) * twigs <= _MOST_OPENED:
        # At most that many pairs of whole numbers: small enough to be copied to every task.
        near = F.broadcast(differing(inside, ["__leaf", "__twig"]))
    else:
        near = differing(inside, ["__leaf", "__twig"])
    met = [d.join(near, ["__leaf", "__twig"], "left_semi").select(*names) for d in inside]
    return row_difference(*met)


# Pairs of leaf and twig that may be broadcast: 2**21 pairs of 4-byte numbers.
_MOST_OPENED = 1 << 21


def offset_gaps(
    log: DataFrame, by: Sequence[str] = ("topic", "partition"), offset: str = "offset", bits: int = 20
) -> DataFrame:
    """Ranges of missing offsets per partition."""
    seen = previous(
        log.select(*by, offset).distinct(), by, [offset], [long_block(offset, bits)], {"__before": offset}
    )
    first = F.col("__before") + 1
    return seen.where(F.col(offset) > first).select(
        *by,
        first.alias("gap_from"),
        (F.col(offset) - 1).alias("gap_to"),
        (F.col(offset) - first).alias("missing"),
    )


def order_audit(
    change: DataFrame,
    pk: Sequence[str],
    arrival: Sequence[Key],
    block: Sequence[Key],
    lsn: str = "lsn",
    partition: str = "partition",
) -> DataFrame:
    """Keys seen in more than one partition, or whose position goes backwards.

    ``arrival`` is the order in which events were received.
    """
    seen = previous(
        change.select(*change.columns), pk, arrival, block, {"__lsn": lsn}
    )
    found = seen.groupBy(*pk).agg(
        F.count_if(F.col(lsn) < F.col("__lsn")).alias("steps_back"),
        F.min(partition).alias("first_partition"),
        F.max(partition).alias("last_partition"),
    )
    moved = F.col("first_partition") != F.col("last_partition")
    return found.where((F.col("steps_back") > 0) | moved).select(
        *pk, "steps_back", moved.alias("moved_partition")
    )


def _top_level(shape: Column) -> Column:
    """The ``name: type`` parts of an object's schema text, cut at the commas between its own fields."""
    inner = F.regexp_replace(shape, r"^OBJECT<|>$", "")
    empty = F.struct(
        F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.lit("").alias("part"), F.array().cast("array<string>").alias("parts")
    )

    def step(state: Column, c: Column) -> Column:
        quoted = F.when(c == "`", ~state["quoted"]).otherwise(state["quoted"])
        change = F.when(state["quoted"], 0).when(c.isin("<", "("), 1).when(c.isin(">", ")"), -1).otherwise(0)
        cut = (c == ",") & (state["depth"] == 0) & ~state["quoted"]
        return F.struct(
            (state["depth"] + change).alias("depth"),
            quoted.alias("quoted"),
            F.when(cut, "").otherwise(F.concat(state["part"], c)).alias("part"),
            F.when(cut, F.array_append(state["parts"], state["part"])).otherwise(state["parts"]).alias("parts"),
        )

    def finish(state: Column) -> Column:
        return F.filter(F.array_append(state["parts"], state["part"]), lambda p: F.trim(p) != "")

    return F.aggregate(F.split(inner, ""), empty, step, finish)


def schema_fields(log: DataFrame, version: str, value: str = "value", by: Sequence[str] = ("topic",)) -> DataFrame:
    """Distinct top-level JSON fields with their types, per topic and version.

    Each message is reduced to its schema text; texts are counted before the shuffle, and only the few distinct
    ones are taken apart.  ``messages`` counts those with the field, ``all_messages`` those of the topic and version, with or without
    readable JSON.
    """
    # The digits of a decimal differ from message to message; its kind does not.
    shape = F.regexp_replace(F.schema_of_variant(F.try_parse_json(value)), r"DECIMAL\(\d+,\d+\)", "DECIMAL")
    shapes = log.groupBy(*by, version, shape.alias("__shape")).agg(F.count(F.lit(1)).alias("__n"))
    shapes = shapes.withColumn("all_messages", F.sum("__n").over(W.partitionBy(*by, version)))
    objects = shapes.where(F.col("__shape").startswith("OBJECT<"))
    parts = objects.withColumn("__part", F.explode(_top_level(F.col("__shape"))))
    named = r"^\s*(`(?:[^`]|``)*`|[^:]*): (.*)$"
    name = F.regexp_extract("__part", named, 1)
    return (
        parts.select(
            *by,
            version,
            "all_messages",
            "__n",
            F.regexp_replace(F.regexp_replace(name, "^`|`$", ""), "``", "`").alias("field"),
            F.regexp_extract("__part", named, 2).alias("type"),
        )
        .groupBy(*by, version, "field", "type")
        .agg(F.sum("__n").alias("messages"), F.max("all_messages").alias("all_messages"))
    )


def schema_drift(
    log: DataFrame,
    version: str,
    old,
    new,
    value: str = "value",
    by: Sequence[str] = ("topic",),
) -> DataFrame:
    """Fields added, removed or changed in type between two versions.

    A change breaks backward reading when readers of the new version meet old
    data they cannot fill: a field added without being optional (seen in every new
    message) or a changed type, unless a whole number became a wider number.
    Removing a field does not break it.
    """
    fields = schema_fields(log.where(F.col(version).isin(old, new)), version, value, by)
    typed = F.when(F.col("type") != "VOID", F.col("type"))
    sides = fields.groupBy(*by, "field").agg(
        F.array_join(
            F.array_sort(F.collect_set(F.when(F.col(version) == F.lit(old), typed))), "|"
        ).alias("old_type"),
        F.array_join(
            F.array_sort(F.collect_set(F.when(F.col(version) == F.lit(new), typed))), "|"
        ).alias("new_type"),
        F.sum(
            F.when((F.col(version) == F.lit(new)) & typed.isNotNull(), F.col("messages")).otherwise(0)
        ).alias("__filled"),
        F.max(F.when(F.col(version) == F.lit(new), F.col("all_messages"))).alias("__all"),
        F.count_if(F.col(version) == F.lit(old)).alias("__in_old"),
        F.count_if(F.col(version) == F.lit(new)).alias("__in_new"),
    )
    change = (
        F.when(F.col("__in_old") == 0, "added")
        .when(F.col("__in_new") == 0, "removed")
        .when(F.col("old_type") != F.col("new_type"), "type_changed")
    )
    joined = sides.withColumn("change", change)
    required = F.col("__filled") >= F.coalesce(F.col("__all"), F.lit(0))
    widened = (F.col("old_type") == "BIGINT") & F.col("new_type").isin(
        "DECIMAL", "DOUBLE", "BIGINT|DECIMAL", "BIGINT|DOUBLE"
    )
    breaks = ((F.col("change") == "type_changed") & ~widened) | (
        (F.col("change") == "added") & required
    )
    return joined.where(F.col("change").isNotNull()).select(
        *by, "field", "change", "old_type", "new_type", breaks.alias("breaks_backward")
    )

"""Sharding by balanced label propagation.

Documents with equal texts are linked.  In each round every linked document looks at the shards its neighbours
are in and asks to move to the one that holds most of them and has room for the others, or else to any shard with room for all.  Moves
are granted while the linked rows of a shard stay within its quota.  Groups that are together leave the rounds, which end when no
move is granted.  At the end unlinked rows level the shards out exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import hot_key_join
from .common import stored, text_of

BUCKETS = 512
# Room that a group larger than a shard asks for, so that others need not leave its shards.
ROOM = 1.1


def quotas(total: int, shards: int) -> list[int]:
    """Rows of each shard: equal, the first ones hold one more where rows are left over."""
    return [total // shards + (t < total % shards) for t in range(shards)]


def _numbers(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _targets(held: DataFrame, room: list[int], quota: int, number: int) -> DataFrame:
    """``group, targets, need, settled`` from the rows ``n`` that each ``group`` has in each ``shard``.

    A group has at most one entry per shard.  One that fits a shard has one target, or null where no shard has room for it.
    """
    places = F.reverse(F.array_sort(F.collect_list(F.struct("n", F.xxhash64("group", "shard").alias("tie"), "shard"))))
    found = held.groupBy("group").agg(F.sum("n").alias("size"), places.alias("places"))
    found = found.withColumn("need", F.ceil(F.col("size") * ROOM / F.lit(max(1, quota))))
    free = _numbers(room)
    near = F.filter("places", lambda p: F.get(free, p["shard"]) >= F.col("size") - p["n"])
    open_ = F.filter(F.sequence(F.lit(0), F.lit(len(room) - 1)), lambda t: F.get(free, t) >= F.col("size"))
    other = F.get(open_, F.pmod(F.xxhash64("group", F.lit(number)), F.greatest(F.size(open_), F.lit(1))).cast("int"))
    one = F.when(F.size("places") == 1, F.col("places")[0]["shard"]).when(F.size(near) > 0, near[0]["shard"]).otherwise(other)
    many = F.transform(F.slice("places", F.lit(1), F.col("need").cast("int")), lambda p: p["shard"])
    targets = F.when(F.col("need") > 1, many).otherwise(F.array(one))
    settled = F.size("places") <= F.greatest(F.col("need"), F.lit(1))
    return found.select("group", targets.alias("targets"), "need", settled.alias("settled"))


def _cutoffs(asks: list, room: list[int]) -> dict[int, int]:
    """Per target the first draw that is not granted, so that what is granted fits the room.  ``asks`` has target, draw and rows."""
    cut, left, full = {}, list(room), set()
    for r in sorted(asks, key=lambda r: (r["target"], r["draw"])):
        t = r["target"]
        if t not in full and r["n"] <= left[t]:
            left[t] -= r["n"]
            cut[t] = r["draw"] + 1
        else:
            full.add(t)
    return cut


def propagate(nodes: DataFrame, shards: int) -> DataFrame:
    """``nodes`` (id, group, shard, ...) with column ``linked`` and shards moved towards their groups.

    A group larger than a shard aims at as many shards as it needs, those which hold most of it already, and its rows move one by one;
    a smaller one moves as a whole, after which it leaves the rounds.  Every granted round puts rows where they stay, so rounds come to an
    end.  Only sums per shard and draw reach the driver: ``shards`` times ``BUCKETS`` numbers a round.
    """
    total = nodes.count()
    quota = quotas(total, shards)
    sizes = nodes.groupBy("group").agg(F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    nodes = hot_key_join(nodes, sizes, ["group"], "left").withColumn("linked", F.col("group_size").isNotNull()).drop("group_size")
    nodes = stored(nodes, "shards-0")
    done, rows, number = nodes.where("NOT linked"), nodes.where("linked"), 0
    still = [0] * shards
    while True:
        number += 1
        held = stored(rows.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n")), "shards-held")
        load = {r["shard"]: r["n"] for r in held.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        if not load:
            return done
        room = [quota[t] - still[t] - load.get(t, 0) for t in range(shards)]
        wanted = _targets(held, room, total // shards, number)
        target = F.when(F.array_contains("targets", F.col("shard")), F.col("shard")).otherwise(
            F.get("targets", F.pmod(F.xxhash64("id", F.lit(number)), F.size("targets")).cast("int"))
        )
        # Groups within one shard move as a whole, larger ones row by row.
        own = F.when(F.col("need") > 1, F.xxhash64(F.lit(number), "group", "id")).otherwise(F.xxhash64(F.lit(number), "group"))
        asked = hot_key_join(rows, wanted, ["group"], "left").select(
            *rows.columns, target.alias("target"), F.pmod(own, F.lit(BUCKETS)).cast("int").alias("draw"), "settled"
        )
        asked = stored(asked, f"shards-asked-{number}")
        for r in asked.where("settled").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect():
            still[r["shard"]] += r["n"]
        done = done.union(asked.where("settled").select(*rows.columns))
        moving = asked.where("NOT settled AND target <> shard").groupBy("target", "draw").agg(F.count(F.lit(1)).alias("n"))
        cut = _cutoffs(moving.collect(), room)
        granted = F.col("draw") < F.get(_numbers([cut.get(t, 0) for t in range(shards)]), F.col("target"))
        rows = asked.where("NOT settled").withColumn("shard", F.when(granted, F.col("target")).otherwise(F.col("shard"))).select(*rows.columns)
        if not cut:
            return done.union(rows)


def level(nodes: DataFrame, shards: int) -> DataFrame:
    """Give each row a ``shard`` and a gapless ``slot`` so that shard counts differ by at most one.

    Rows past a shard's quota fill the gaps of the others, unlinked rows first.  Ranks are taken in
    ``2 * BUCKETS`` parts per shard, whose sizes (a table bounded by the parameters) give the offsets.
    """
    part = F.when(F.col("linked"), F.lit(0)).otherwise(F.lit(BUCKETS)) + F.pmod(F.xxhash64("id", "group"), F.lit(BUCKETS))
    parted = nodes.withColumn("part", part.cast("int"))
    counts = parted.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "group")) - 1
    ranked = parted.withColumn("inside", inside).join(F.broadcast(offsets), ["shard", "part"])
    ranked = ranked.withColumn("rank", F.col("inside") + F.col("offset"))

    held = dict.fromkeys(range(shards), 0) | {r["shard"]: r["n"] for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    total = sum(held.values())
    quota = quotas(total, shards)
    over_before, hole_end, seen, holes = [], [], 0, 0
    for t in range(shards):
        over_before.append(seen)
        seen += max(0, held[t] - quota[t])
        holes += max(0, quota[t] - held[t])
        hole_end.append(holes)
    hole_start = [e - max(0, quota[t] - held[t]) for t, e in enumerate(hole_end)]

    def pick(values: list[int], at: Column) -> Column:
        return F.get(_numbers(values), at)

    spare = F.col("rank") - pick(quota, F.col("shard"))
    place = spare + pick(over_before, F.col("shard"))
    ends = _numbers(hole_end)
    ranked = ranked.withColumn("nth", F.when(spare >= 0, place))
    to = F.size(F.filter(ends, lambda e: e <= F.col("nth")))
    slot = pick(held.values(), to) + F.col("nth") - pick(hole_start, to)
    return ranked.select(
        *[c for c in nodes.columns if c != "shard"],
        F.when(F.col("nth").isNull(), F.col("shard")).otherwise(to).cast("int").alias("shard"),
        F.when(F.col("nth").isNull(), F.col("rank")).otherwise(slot).cast("long").alias("slot"),
    )


def balanced_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: identifier, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``, ``linked``.

    Law ``rows``: shard counts differ by at most one, slots are 0, 1, 2, ... in each shard.  A null text has no bytes and
    counts as equal to the empty text; null identifiers and repeated rows get slots like any other row.  With
    fewer rows than shards some shards stay empty; an empty table gives no rows; other columns are ignored.
    """
    text = text_of(text_col)
    nodes = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
    )
    start = F.pmod(F.xxhash64("id", "group"), F.lit(shards)).cast("int")
    nodes = stored(nodes.withColumn("shard", start), "shards-start")
    final = level(propagate(nodes, shards), shards)
    return final.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "linked",
    )

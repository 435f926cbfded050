"""Comparing runs.

Values of the whole frame (a baseline, a smallest and largest value) are scalar
subqueries: one aggregate each, no cross join and no window over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import bounds_of, place_among, running_sum
from .joins import salted_join

MISSING_LATENCY = 9999.0


def head_to_head(
    left: DataFrame, right: DataFrame, case: str, metrics: Sequence[str]
) -> DataFrame:
    """Two sources side by side per case, with how many percent the left is above."""
    a = left.select(case, *[F.col(m).alias(f"{m}_a") for m in metrics])
    b = right.select(case, *[F.col(m).alias(f"{m}_b") for m in metrics])
    joined = a.join(b, on=case, how="inner")
    return joined.select(
        "*",
        *[
            F.when(F.col(f"{m}_b") != 0, (F.col(f"{m}_a") / F.col(f"{m}_b") - 1) * 100.0).alias(
                f"{m}_diff_pct"
            )
            for m in metrics
        ],
    )


def speedup_per_table(slow: DataFrame, fast: DataFrame, table: str, duration: str) -> DataFrame:
    """How many times faster each table was; null where one side has no time."""
    a = slow.select(table, F.col(duration).alias("slow_sec"))
    b = fast.select(table, F.col(duration).alias("fast_sec"))
    joined = a.join(b, on=table, how="full")
    return joined.withColumn(
        "speedup", F.when(F.col("fast_sec") > 0, F.col("slow_sec") / F.col("fast_sec"))
    )


def vs_baseline(
    runs: DataFrame, label: str, baseline: str, ratios: dict[str, str]
) -> DataFrame:
    """Ratios of metrics to those of one run, as ``{new name: metric}``."""
    metrics = sorted(set(ratios.values()))
    base = (
        runs.where(F.col(label) == baseline)
        .select(F.struct(*[F.max(m).alias(m) for m in metrics]))
        .scalar()
    )
    based = runs.withColumn("__base", base)
    columns = []
    for name, metric in ratios.items():
        reference = F.col(f"__base.{metric}")
        columns.append(F.when(reference > 0, F.col(metric) / reference).alias(name))
    return based.select(*runs.columns, *columns)


def _bounds(frame: DataFrame, metrics: Sequence[str]) -> Column:
    """Smallest and largest value of each metric, in one scalar subquery."""
    fields = []
    for m in metrics:
        value = F.col(m).cast("double")
        fields += [F.min(value).alias(f"{m}_lo"), F.max(value).alias(f"{m}_hi")]
    return frame.select(F.struct(*fields)).scalar()


def min_max_score(
    runs: DataFrame, metrics: dict[str, bool], keep: Sequence[str] = (), suffix: str = "_score"
) -> DataFrame:
    """Scale metrics to 0..1; ``True`` inverts one where lower is better.

    All values equal gives 0.5.
    """
    kept = list(keep) or [c for c in runs.columns if c not in metrics]
    bounded = runs.withColumn("__b", _bounds(runs, list(metrics)))

    def scaled(m, lower_is_better):
        low, high = F.col(f"__b.{m}_lo"), F.col(f"__b.{m}_hi")
        share = (F.col(m).cast("double") - low) / (high - low)
        if lower_is_better:
            share = F.lit(1.0) - share
        return F.when(high > low, share).otherwise(F.lit(0.5)).alias(f"{m}{suffix}")

    return bounded.select(*kept, *[scaled(m, lower) for m, lower in metrics.items()])


def radar_scores(
    runs: DataFrame, series: DataFrame, run: str = "run", p50: str = "p50"
) -> DataFrame:
    """Five scores per run: msg_s, mb_s, inverted time, size and mean P50 latency."""
    latency = series.groupBy(run).agg(F.avg(p50).alias("mean_p50"))
    joined = runs.join(latency, on=run, how="left").withColumn(
        "mean_p50", F.coalesce("mean_p50", F.lit(MISSING_LATENCY))
    )
    return min_max_score(
        joined,
        {"msg_s": False, "mb_s": False, "total_sec": True, "total_mb": True, "mean_p50": True},
        keep=[run],
    )


def best_case(
    runs: DataFrame,
    metric: str,
    lower_is_better: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Add rank, a mark for the best, and percent slower than the best.

    Runs with the same value share a rank.  Ranks are counted over the distinct values, in parts that hold about equal
    numbers of them whatever their spread, so no task sees all values of a group.
    """
    by = list(by)
    keys = [*by, metric]
    counts = runs.groupBy(*keys).agg(F.count(F.lit(1)).alias("__c"))
    value = F.col(metric).cast("double")
    best = F.min(metric) if lower_is_better else F.max(metric)
    facts = F.struct(bounds_of(value).alias("bounds"), best.alias("best")).alias("__facts")
    if by:
        bounded = salted_join(counts, counts.groupBy(*by).agg(facts), by, "inner")
    else:
        bounded = counts.withColumn("__facts", counts.select(facts).scalar())
    sign = 1 if lower_is_better else -1
    bounded = bounded.select(
        *counts.columns,
        F.col("__facts.best").alias("__best"),
        (place_among(F.col("__facts.bounds"), value).cast("long") * sign).alias("__place"),
    )
    counted = running_sum(bounded, by, [F.col(metric) * sign], ["__place"], F.col("__c"), "__upto")
    ranked = counted.select(*keys, (F.col("__upto") - F.col("__c") + 1).alias("rank"), "__best")
    joined = salted_join(runs, ranked, keys, "left")
    mine, top = F.col(metric).cast("double"), F.col("__best").cast("double")
    ratio, divisor = (mine / top, top) if lower_is_better else (top / mine, mine)
    return joined.select(
        *runs.columns,
        "rank",
        (F.col("rank") == 1).alias("is_best"),
        F.when(divisor != 0, (ratio - 1) * 100.0).alias("pct_slower"),
    )


def time_at_scale(
    runs: DataFrame, row_counts: Sequence[int], rate: str = "msg_s"
) -> DataFrame:
    """Seconds each run would need for each number of rows."""
    sizes = F.explode(F.array(*[F.lit(n).cast("long") for n in row_counts]))
    return runs.withColumn("row_count", sizes).withColumn(
        "seconds", F.when(F.col(rate) > 0, F.col("row_count") / F.col(rate))
    )


def case_matrix(
    runs: DataFrame, case: str, metrics: Sequence[str], cases: Sequence[str]
) -> DataFrame:
    """One row per metric, one column for each of ``cases``."""
    long = runs.select(
        case,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                    for m in metrics
                ]
            )
        ).alias("__m"),
    ).select(case, "__m.metric", "__m.value")
    return long.groupBy("metric").pivot(case, list(cases)).agg(F.max("value"))


def system_matrix(
    samples: DataFrame,
    metrics: Sequence[str],
    containers: Sequence[str],
    run: str = "run",
    container: str = "container",
) -> DataFrame:
    """Mean of values above 0 per run, container and metric, each scaled to 0..1.

    One column per container and metric; higher is always nearer 1.
    """
    columns = [
        F.coalesce(
            F.avg(F.when((F.col(container) == c) & (F.col(m) > 0), F.col(m))), F.lit(0.0)
        ).alias(f"{c}_{m}")
        for c in containers
        for m in metrics
    ]
    wide = samples.groupBy(run).agg(*columns)
    names = {f"{c}_{m}": False for c in containers for m in metrics}
    return min_max_score(wide, names, keep=[run], suffix="")

"""Comparing runs: event types are the benchmark cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scoring as R
from .registry import query, rounded, rounded_sql, runs_of, runs_sql, table

CASES = ["click", "error", "purchase", "signup", "view"]
METRICS = {"total_sec": True, "msg_s": False, "mb_s": False, "total_mb": True, "avg_b": True}


def _score_sql(metric, lower, table_name="runs"):
    share = f"({metric} - min({metric}) OVER ()) / (max({metric}) OVER () - min({metric}) OVER ())"
    if lower:
        share = f"1.0 - {share}"
    return (
        f"round(CASE WHEN max({metric}) OVER () > min({metric}) OVER () THEN {share} ELSE 0.5 END::DOUBLE, 6)"
        f" AS {metric}_score"
    )


@query(f"""WITH {runs_sql()}
SELECT run, {", ".join(_score_sql(m, lower) for m, lower in METRICS.items())} FROM runs""")
def min_max_score(spark, sf):
    scores = R.min_max_score(runs_of(spark, sf), METRICS, ["run"])
    return scores.select("run", *rounded(*[f"{m}_score" for m in METRICS]))


@query(f"""WITH {runs_sql("user_id")}
SELECT run, {", ".join(_score_sql(m, lower) for m, lower in METRICS.items())} FROM runs""")
def min_max_score_by_user(spark, sf):
    scores = R.min_max_score(runs_of(spark, sf, "user_id"), METRICS, ["run"])
    return scores.select("run", *rounded(*[f"{m}_score" for m in METRICS]))


_RADAR = {"msg_s": False, "mb_s": False, "total_sec": True, "total_mb": True, "mean_p50": True}


@query(f"""WITH {runs_sql("user_id", "base")}, series AS (
  SELECT CAST(user_id AS VARCHAR) AS run, avg(CAST(value AS DECIMAL(18,2))) AS mean_p50 FROM events WHERE value < 20 GROUP BY 1),
runs AS (SELECT b.*, coalesce(s.mean_p50, 9999.0) AS mean_p50 FROM base b LEFT JOIN series s USING (run))
SELECT run, {", ".join(_score_sql(m, lower) for m, lower in _RADAR.items())} FROM runs""")
def radar_scores(spark, sf):
    series = table(spark, sf, "events").where("value < 20").select(
        F.col("user_id").cast("string").alias("run"), F.col("value").alias("p50")
    )
    scores = R.radar_scores(runs_of(spark, sf, "user_id"), series)
    return scores.select("run", *rounded(*[f"{m}_score" for m in _RADAR]))


@query(f"""WITH {runs_sql("user_id")}
SELECT run, messages, rank() OVER (ORDER BY messages DESC) AS rank, messages = max(messages) OVER () AS is_best,
  round((max(messages) OVER () / messages::DOUBLE - 1) * 100, 6) AS pct_slower FROM runs""")
def best_case(spark, sf):
    return R.best_case(runs_of(spark, sf, "user_id"), "messages").select(
        "run", "messages", "rank", "is_best", *rounded("pct_slower")
    )


@query(f"""WITH {runs_sql()}
SELECT run, rank() OVER (ORDER BY total_sec) AS rank, total_sec = min(total_sec) OVER () AS is_best,
  round((total_sec / min(total_sec) OVER () - 1) * 100, 6) AS pct_slower FROM runs""")
def best_case_lower(spark, sf):
    return R.best_case(runs_of(spark, sf), "total_sec", lower_is_better=True).select(
        "run", "rank", "is_best", *rounded("pct_slower")
    )


@query(f"""WITH {runs_sql()}, base AS (SELECT * FROM runs WHERE run = 'view')
SELECT r.run, round(r.total_mb / b.total_mb, 6) AS size_ratio, round(r.msg_s / b.msg_s, 6) AS speed_ratio
FROM runs r, base b""")
def vs_baseline(spark, sf):
    found = R.vs_baseline(
        runs_of(spark, sf), "run", "view", {"size_ratio": "total_mb", "speed_ratio": "msg_s"}
    )
    return found.select("run", *rounded("size_ratio", "speed_ratio"))


def _two_sources(spark, sf):
    def side(status):
        return (
            table(spark, sf, "orders")
            .where(F.col("o_orderstatus") == status)
            .groupBy(F.col("o_orderpriority").alias("case"))
            .agg(
                F.count(F.lit(1)).alias("messages"),
                F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
            )
        )

    return side("F"), side("O")


_TWO_SQL = """side AS (
  SELECT o_orderstatus AS s, o_orderpriority AS "case", count(*) AS messages, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM orders GROUP BY 1, 2)"""


@query(f"""WITH {_TWO_SQL}
SELECT a."case", a.messages AS messages_a, b.messages AS messages_b, round((a.messages / b.messages::DOUBLE - 1) * 100, 6) AS messages_diff_pct,
  round((a.total / b.total - 1) * 100, 6) AS total_diff_pct
FROM side a JOIN side b ON a."case" = b."case" WHERE a.s = 'F' AND b.s = 'O'""")
def head_to_head(spark, sf):
    a, b = _two_sources(spark, sf)
    return R.head_to_head(a, b, "case", ["messages", "total"]).select(
        "case", "messages_a", "messages_b", *rounded("messages_diff_pct", "total_diff_pct")
    )


@query(f"""WITH {_TWO_SQL}
SELECT a."case", round(a.total / b.total, 6) AS speedup
FROM side a FULL JOIN side b ON a."case" = b."case" WHERE a.s = 'F' AND b.s = 'O'""")
def speedup_per_table(spark, sf):
    a, b = _two_sources(spark, sf)
    return R.speedup_per_table(a, b, "case", "total").select("case", *rounded("speedup"))


@query(f"""WITH {runs_sql()}, sizes AS (SELECT CAST(unnest([1000000, 100000000, 1000000000]) AS BIGINT) AS row_count)
SELECT run, row_count, round(row_count / msg_s, 3) AS seconds FROM runs, sizes""")
def time_at_scale(spark, sf):
    return R.time_at_scale(runs_of(spark, sf), [1_000_000, 100_000_000, 1_000_000_000]).select(
        "run", "row_count", *rounded("seconds", digits=3)
    )


@query(f"""WITH {runs_sql()}, long AS (
  SELECT run, unnest(['messages', 'total_mb', 'avg_b']) AS metric,
         unnest([messages::DOUBLE, total_mb, avg_b]) AS value FROM runs)
SELECT metric, {", ".join(f"round(max(value) FILTER (run = '{c}'), 6) AS {c}" for c in CASES)} FROM long GROUP BY 1""")
def case_matrix(spark, sf):
    wide = R.case_matrix(runs_of(spark, sf), "run", ["messages", "total_mb", "avg_b"], CASES)
    return wide.select("metric", *rounded(*CASES))


_CELLS = [f"{c}_{m}" for c in CASES for m in ("cpu_pct", "mem_mb")]


def _cell_sql(c, m):
    positive = "AND user_id % 2 <> 0" if m == "cpu_pct" else ""
    return (
        f"coalesce(avg(CAST(round(value * 100) AS BIGINT)) FILTER (event_type = '{c}' AND value > 0 {positive}), 0) AS {c}_{m}"
    )


@query(f"""WITH wide AS (
  SELECT CAST(user_id AS VARCHAR) AS run, {", ".join(_cell_sql(c, m) for c in CASES for m in ("cpu_pct", "mem_mb"))}
  FROM events GROUP BY 1)
SELECT run, {", ".join(_score_sql(n, False).replace("_score", "") for n in _CELLS)} FROM wide""")
def system_matrix(spark, sf):
    cents = F.round(F.col("value") * 100).cast("long")
    samples = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("run"),
        F.col("event_type").alias("container"),
        F.when(F.col("user_id") % 2 == 0, 0).otherwise(cents).alias("cpu_pct"),
        cents.alias("mem_mb"),
    )
    return R.system_matrix(samples, ["cpu_pct", "mem_mb"], CASES).select("run", *rounded(*_CELLS))

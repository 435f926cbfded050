"""Quality rules: plain limits, then robust multivariate outliers per language and source.

Counts of each text become a vector of transformed statistics.  For each cell (language and source, or a pool of small
ones) location and scatter come from the minimum-covariance-determinant method: concentration steps move to the rows with
the smallest Mahalanobis distances, four times (``STEPS``), from two starting points, and the smaller determinant wins.
All steps are built-in expressions.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import hot_key_join
from .common import WORD_GAPS, stored, text_of

SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

# Share of a cell's rows that the estimate rests on, and how many rows a cell needs.
COVER = 0.75
LEAST_ROWS = 64
# The rows of a large cell are spread over so many tasks.
CELL_SALTS = 256
STEPS = 4
# Distances are counted in so many steps per factor e; statistics in so many per unit.
DISTANCE_STEPS = 32
VALUE_STEPS = 32
# Median of the chi-squared law with 5 degrees of freedom, and its point of probability 1 - 1e-7.
CHI_MEDIAN = 4.351
CHI_CUTOFF = 40.86
# Smallest standard deviation of a statistic: differences below it are no ground for rejection.
LEAST_SPREAD = 0.15
DIM = 5
PAIRS = [(i, j) for i in range(DIM) for j in range(i + 1)]


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated_words(words: Column, window: int) -> Column:
    """Words in windows that occur twice or more; windows are told apart by 64-bit hashes within one text."""

    def covered(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twins(s: Column) -> Column:
            def twin(x: Column, k: Column) -> Column:
                before, after = F.get(s, k - 1)["h"], F.get(s, k + 1)["h"]
                return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

            return F.array_sort(F.transform(F.filter(s, twin), lambda x: x["i"]))

        def total(p: Column) -> Column:
            steps = F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda a, b: F.least(F.coalesce(b - a, F.lit(window)), F.lit(window)))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda t, x: t + x)

        return _bind(_bind(pairs, twins), total)

    def count(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - F.lit(window - 1))
        windows = F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, window)))
        some = _bind(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w)))
        return F.when(F.size(hashes) > window, some).otherwise(F.lit(0).cast("long"))

    return _bind(F.transform(words, lambda w: F.xxhash64(w)), count)


def text_counts(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed of each whole text."""
    text = text_of(text_col)
    trimmed = F.btrim(text, F.lit(WORD_GAPS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WORD_GAPS)) != "")
    found = docs.select(
        *keep,
        _bind(
            words,
            lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated_words(w, WINDOW_WORDS).alias("n_repeat_words")),
        ).alias("of_words"),
        F.char_length(F.translate(text, WORD_GAPS, "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
    )
    found = found.select(
        *keep, "of_words.n_words", "word_chars", "n_symbols", "n_dup_lines", "of_words.n_repeat_words"
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT)
    return found.withColumn("base_failed", failed)


def _vector() -> list[Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return [
        F.log1p(F.col("n_words").cast("double")) / 2,
        2 * F.log(chars / words),
        F.log1p(F.lit(100.0) * F.col("n_symbols") / chars),
        F.log1p(F.lit(30.0) * F.col("n_dup_lines") / words),
        F.log1p(F.lit(4.0) * F.col("n_repeat_words") / words),
    ]


def _with_cells(rows: DataFrame) -> DataFrame:
    """Add ``cell``: language and source, or a pool by language, or one pool, so that cells are not too small."""

    def part(name: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null"))

    names = {"fine": F.to_json(F.array(part("lang"), part("source"))), "mid": F.to_json(F.array(part("lang"))), "all": F.lit("[]")}
    sizes = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")).withColumns(names)
    enough = F.col("n") >= LEAST_ROWS
    left = F.sum(F.when(~enough, F.col("n")).otherwise(0)).over(Window.partitionBy("lang"))
    cell = F.when(enough, F.col("fine")).when(left >= LEAST_ROWS, F.col("mid")).otherwise(F.col("all"))
    cells = sizes.select("fine", cell.alias("cell"))
    return hot_key_join(rows.withColumn("fine", names["fine"]), cells, ["fine"], "inner").drop("fine")


def _first_guess(rows: DataFrame) -> DataFrame:
    """Median and quartile spread of each statistic per cell, from counts of narrow steps."""
    parts = F.posexplode(F.transform(F.array(*[f"x{i}" for i in range(DIM)]), lambda v: F.floor(v * VALUE_STEPS)))
    counts = rows.select("cell", parts.alias("i", "at")).groupBy("cell", "i", "at").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("cell", "i")
    ranked = counts.withColumn("total", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(w.orderBy("at")))

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("total") * q, (F.col("at") + 0.5) / VALUE_STEPS))

    spread = ranked.groupBy("cell", "i").agg(quantile(0.5).alias("m"), ((quantile(0.75) - quantile(0.25)) / 1.349).alias("s"))
    wide = []
    for i in range(DIM):
        wide.append(F.max(F.when(F.col("i") == i, F.col("m"))).alias(f"m{i}"))
    for i, j in PAIRS:
        value = F.col("s") * F.col("s") + LEAST_SPREAD**2 if i == j else F.lit(0.0)
        wide.append(F.max(F.when(F.col("i") == i, value)).alias(f"c{i}{j}"))
    return spread.groupBy("cell").agg(*wide).withColumn("start", F.lit(0))


def _moments(sums: DataFrame, keys: list[str]) -> DataFrame:
    """Mean ``m`` and covariance ``c`` from n, sums ``s`` and sums of products ``p``."""
    n = F.col("n")
    return sums.select(
        *keys,
        *[(F.col(f"s{i}") / n).alias(f"m{i}") for i in range(DIM)],
        *[
            (
                F.greatest(F.col(f"p{i}{j}") / n - F.col(f"s{i}") * F.col(f"s{j}") / n / n, F.lit(0.0)) + LEAST_SPREAD**2
                if i == j
                else F.col(f"p{i}{j}") / n - F.col(f"s{i}") * F.col(f"s{j}") / n / n
            ).alias(f"c{i}{j}")
            for i, j in PAIRS
        ],
    )


def _sums(rows, keys: list[str], again: bool = False) -> DataFrame:
    """Add up n, ``s`` and ``p``, of rows or (``again``) of sums."""
    if again:
        return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ["n", *[f"s{i}" for i in range(DIM)], *[f"p{i}{j}" for i, j in PAIRS]]])
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(f"x{i}").alias(f"s{i}") for i in range(DIM)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in PAIRS],
    )


def _whitened(guess: DataFrame) -> DataFrame:
    """Add the inverse ``w`` of the Cholesky factor of the covariance, and ``logdet``."""
    for i in range(DIM):
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            value = F.sqrt(F.greatest(rest, F.lit(LEAST_SPREAD**2 / 100))) if i == j else rest / F.col(f"l{j}{j}")
            guess = guess.withColumn(f"l{i}{j}", value)
    for j in range(DIM):
        guess = guess.withColumn(f"w{j}{j}", 1 / F.col(f"l{j}{j}"))
        for i in range(j + 1, DIM):
            rest = sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0))
            guess = guess.withColumn(f"w{i}{j}", -rest / F.col(f"l{i}{i}"))
    logdet = 2 * sum((F.log(f"l{i}{i}") for i in range(DIM)), F.lit(0.0))
    return guess.withColumn("logdet", logdet).drop(*[f"l{i}{j}" for i, j in PAIRS], *[f"c{i}{j}" for i, j in PAIRS])


def _distance() -> Column:
    z = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(DIM)]
    y = [sum((F.col(f"w{i}{j}") * z[j] for j in range(i + 1)), F.lit(0.0)) for i in range(DIM)]
    return list(accumulate(v * v for v in y))[-1]


def _concentrate(rows: DataFrame, guess: DataFrame) -> DataFrame:
    """One step: sums over the rows nearest to the guess, taken from counts and sums per narrow range of distances."""
    met = hot_key_join(rows, _whitened(guess).hint("merge"), ["cell"], "inner", CELL_SALTS)
    met = met.withColumn("at", F.floor(F.log(_distance() + 1e-6) * DISTANCE_STEPS))
    ranges = _sums(met, ["cell", "start", "at"])
    w = Window.partitionBy("cell", "start")
    ranges = ranges.withColumn("total", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(w.orderBy("at")))
    near = ranges.where(F.col("upto") - F.col("n") < F.col("total") * COVER)
    return _moments(_sums(near, ["cell", "start"], again=True), ["cell", "start"])


def outlier_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", steps: int = STEPS) -> DataFrame:
    """One row per input row: identifier, the counts, ``base_failed``, ``distance`` and ``kept``.

    ``lang`` and ``source`` name the cells; null is a value of its own.  Cells with fewer than ``LEAST_ROWS`` rows are
    pooled by language, then together; a pool that is still small rejects nothing.  Null and empty texts have no words and
    fail the base rule, as do all texts with under 20 words.  Repeated rows count as often as they occur; an empty table
    gives no rows; other columns are ignored.
    """
    keep = [F.col(id_col).alias("id"), F.col("lang").alias("lang"), F.col("source").alias("source")]
    named = docs.select(*keep, F.col(text_col).alias("text"))
    counted = text_counts(named, ["id", "lang", "source"])
    counted = stored(counted.withColumns({f"x{i}": v for i, v in enumerate(_vector())}), "quality-counts")
    passed = stored(_with_cells(counted.where("NOT base_failed")), "quality-cells")
    rows = passed.select("cell", *[f"x{i}" for i in range(DIM)])

    everything = _moments(_sums(rows, ["cell"]), ["cell"]).withColumn("start", F.lit(1))
    guess = stored(_first_guess(rows).unionByName(everything), "quality-guess")
    for number in range(steps):
        guess = stored(_concentrate(rows, guess), f"quality-step-{number}")
    best = _whitened(guess).groupBy("cell").agg(F.min_by(F.struct("*"), F.struct("logdet", "start")).alias("best")).select("best.*")
    best = stored(best.drop("start", "logdet"), "quality-best")

    at = F.floor(F.log(_distance() + 1e-6) * DISTANCE_STEPS)
    counts = hot_key_join(rows, best.hint("merge"), ["cell"], "inner", CELL_SALTS).groupBy("cell", at.alias("at")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("cell")
    ranked = counts.withColumn("total", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(w.orderBy("at")))
    median = ranked.groupBy("cell").agg(
        F.min(F.when(F.col("upto") * 2 >= F.col("total"), F.exp((F.col("at") + 1) / DISTANCE_STEPS))).alias("median"),
        F.max("total").alias("cell_rows"),
    )
    final = stored(best.join(median, "cell"), "quality-limits")
    judged = hot_key_join(passed, final, ["cell"], "inner", CELL_SALTS).withColumn("distance", _distance())
    limit = F.greatest(F.col("median") / CHI_MEDIAN, F.lit(1.0)) * CHI_CUTOFF
    judged = judged.withColumn("kept", (F.col("distance") <= limit) | (F.col("cell_rows") < LEAST_ROWS))
    columns = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    failed = counted.where("base_failed").select(*columns, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return judged.select(*columns, "distance", "kept").union(failed).withColumnRenamed("id", id_col)

"""Spelling variants of the words of a corpus, by permuterm rotations.

A word with a terminator behind it is turned at every place.  Turned so that a character comes last, everything before it is what
words share that differ in this character only; turned whole, it is what a longer word shares that has one character more at that
place.  Sorted, the rotations with equal text before the skipped character stand together: such a group is scanned once and each of
its words gets the number and the best of its neighbours there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored

# Letters of words, and every how many-th occurrence is drawn for a deletion.
LETTERS = r"[A-Za-zÀ-ÿ]+"
DELETE_ONE_IN = 31
# Sorts before every letter and is none.
END = "\t"


def count_words(
    docs: DataFrame, least_length: int = 7, least_count: int = 2, delete_one_in: int = DELETE_ONE_IN, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``word, n``: words of at least so many characters and occurrences, over whole texts.

    Words are runs of letters with A to Z in lower case.  With ``h`` the crc32 of identifier, colon and word, a word of which
    ``delete_one_in`` divides ``h`` loses its character number ``h`` modulo its length.  A null identifier counts as empty text, a null text has no
    words.  Words are counted inside tasks before the shuffle, so a frequent word is one row per task.
    """
    runs = F.regexp_extract_all(F.col(text_col), F.lit(LETTERS), F.lit(0))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    found = docs.select(name.alias("name"), F.explode(F.filter(runs, lambda r: F.char_length(r) >= least_length)).alias("run"))
    found = found.select("name", lower_ascii(F.col("run")).alias("run"))
    h = F.crc32(F.concat_ws(":", "name", "run"))
    at = F.pmod(F.col("h"), F.char_length("run")).cast("int")
    without = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = found.withColumn("h", h).select(F.when(F.pmod("h", F.lit(delete_one_in)) == 0, without).otherwise(F.col("run")).alias("word"))
    words = words.where(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """``shared, skipped, first, word, n``: every rotation of every word, with the last character skipped and whole.

    ``skipped`` is that character, null where the rotation is whole; ``first`` tells that the character before it is another one.  A
    word with equal neighbouring letters gives the same word whichever of them is left out; only the first counts.
    """
    length = F.char_length("word")
    places = F.sequence(F.lit(1), length + 1)
    turned = words.select("word", "n", F.explode(places).alias("at"))
    back, front = F.substr("word", F.col("at") + 1), F.substr("word", F.lit(1), F.col("at") - 1)
    skipped = F.when(F.col("at") <= length, F.substr("word", F.col("at"), F.lit(1)))
    turned = turned.withColumn("skipped", skipped).withColumn("first", skipped != F.substr("word", F.col("at") - 1, F.lit(1)))
    # A substring that starts at 0 begins with the first character.
    turned = turned.withColumn("first", F.col("first") | (F.col("at") == 1))
    longer = turned.where("skipped IS NOT NULL").select(F.concat(back, F.lit(END), front).alias("shared"), "skipped", "first", "word", "n")
    whole = F.concat(F.substr("word", F.col("at")), F.lit(END), front)
    return longer.union(turned.select(whole.alias("shared"), F.lit(None).alias("skipped"), F.lit(True).alias("first"), "word", "n"))


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n_near, best``: the number of near words, and of these the one of largest ``n`` (``best.minus`` is its negative).

    The rotations are sorted into ranges of ``shared``.  A group holds at most one word per letter and one shorter
    word, so it never grows with the data, and each of its words leaves it as one row, not as pairs.
    """
    ordered = rotations(words).repartitionByRange("shared").sortWithinPartitions("shared")
    member = F.struct((-F.col("n")).alias("minus"), "word", F.col("skipped").isNull().alias("whole"), "first")
    groups = ordered.groupBy("shared").agg(F.array_sort(F.collect_list(member)).alias("members")).where(F.size("members") > 1)
    each = groups.select(F.explode("members").alias("own"), "members")

    def near(m: Column) -> Column:
        own = F.col("own")
        replaced = ~m["whole"] & ~own["whole"] & (m["word"] != own["word"])
        return replaced | ((m["whole"] != own["whole"]) & m["first"] & own["first"])

    met = each.select("own.word", F.filter("members", near).alias("near")).where(F.size("near") > 0)
    best = F.struct(F.col("near")[0]["minus"].alias("minus"), F.col("near")[0]["word"].alias("word"))
    met = met.select("word", F.size("near").cast("long").alias("n_near"), best.alias("best"))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame, most: int, ratio: int) -> DataFrame:
    """``word, root`` for rows ``word, form``: the last word that forms lead to.

    Each form has ``ratio`` times the count of its word, so chains are no longer than the logarithm of the largest count
    ``most``; the length of the known part doubles each round.
    """
    known = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    steps = math.log(max(most, 2), ratio) + 1
    for _ in range(math.ceil(math.log2(steps))):
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        known = stored(known.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return known


def variants(
    docs: DataFrame,
    least_length: int = 7,
    least_count: int = 2,
    ratio: int = 10,
    delete_one_in: int = DELETE_ONE_IN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per word: ``word, n, n_near, form, form_n, root``.

    Words (see ``count_words``) are near if they differ by one inserted, deleted or replaced character.  A word's ``form`` is its near
    word of largest ``n`` (ties: the smallest in code-point order) if that has at least ``ratio`` times its ``n``, else null.  ``root``
    follows forms to the last word, and is the word itself where it has none.  Repeated rows count as often as they
    occur; an empty table, or one without words, gives no rows; other columns are ignored.
    """
    if ratio < 2:
        raise ValueError("a form has at least twice the count of its word")
    words = stored(count_words(docs, least_length, least_count, delete_one_in, id_col, text_col), "spelling-words")
    found = words.join(neighbours(words), "word", "left")
    is_form = -F.col("best.minus") >= F.col("n") * ratio
    found = stored(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.minus")).alias("form_n"),
        ),
        "spelling-forms",
    )
    most = words.agg(F.max("n")).first()[0] or 0
    ends = roots(found.where("form IS NOT NULL"), most, ratio)
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))

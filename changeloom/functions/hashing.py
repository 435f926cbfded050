"""Repeatable pseudo-random values: the same row and seed give the same value.

MD5 is used because other engines compute the same digits, which makes the
generated values testable outside Spark.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_int(key: Column, seed: str) -> Column:
    """A whole number in [0, 2^32) from ``seed`` and ``key``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def seeded_unit(key: Column, seed: str, steps: int = 10_000) -> Column:
    """A multiple of ``1/steps`` in [0, 1), as an exact decimal."""
    return ((seeded_int(key, seed) % steps).cast("decimal(12,0)") / F.lit(steps)).cast(
        "decimal(12,6)"
    )

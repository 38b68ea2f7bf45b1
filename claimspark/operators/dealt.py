"""Equi-join whose hot keys are spread over several tasks on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key and side above which they are dealt over several tasks.
SHARE = 1 << 12


def _hot(df: DataFrame, keys: list[str], share: int, left: bool) -> DataFrame:
    """(keys, _a, _b) of the keys with more than ``share`` rows: lots to deal the left and the right side into."""
    lots = F.ceil(F.col("count") / share).cast("int")
    one = F.lit(1)
    counted = df.groupBy(*keys).count().filter(F.col("count") > share)
    return counted.select(*keys, (lots if left else one).alias("_a"), (one if left else lots).alias("_b"))


def _dealt(df: DataFrame, hot: DataFrame, keys: list[str], own: str, other: str) -> DataFrame:
    """Rows with the lot each is in, and a copy for every lot of the other side."""
    marked = df.join(hot, keys, "left")
    one = F.lit(1)
    lot = F.pmod(F.xxhash64(*df.columns), F.coalesce(own, one)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(other, one) - 1))
    return marked.select(*df.columns, lot.alias(f"_lot{own}"), copies.alias(f"_lot{other}"))


def dealt_join(left: DataFrame, right: DataFrame, keys: list[str], share: int = SHARE) -> DataFrame:
    """Inner join on ``keys``, none of them NULL, with the rows of a hot key dealt over its lots.

    Hot keys are found by an exact count of both sides. A key with m and n rows is cut into m/share times n/share
    pairs of lots, each joined by itself; the rows of either side are copied once per lot of the other, which is what
    their product costs anyway. Keys below the share, nearly all, are neither cut nor copied. Rows of a side should
    differ: equal ones fall into one lot. There are at most rows/share hot keys; whether their list is broadcast is
    left to its size.
    """
    hot = _hot(left, keys, share, True).unionByName(_hot(right, keys, share, False))
    hot = hot.groupBy(*keys).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    one, other = _dealt(left, hot, keys, "_a", "_b"), _dealt(right, hot, keys, "_b", "_a")
    return one.join(other, [*keys, "_lot_a", "_lot_b"]).drop("_lot_a", "_lot_b")

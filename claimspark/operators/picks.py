"""Choosing one row per key, and matching a probe against several keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[Column], cols: list[str]) -> DataFrame:
    """One row per key: the one that comes first by ``order``."""
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in cols])


def extremes(df: DataFrame, keys: list[Column], row: Column, tag: str) -> DataFrame:
    """Smallest and largest row per key; rows with a NULL in the key match nothing.

    One row per key whatever its size, so a key shared by very many rows costs a
    partial aggregate and never multiplies a later join.
    """
    named = [k.alias(f"_{tag}{i}") for i, k in enumerate(keys)]
    keyed = df.select(*named, row.alias("_row"))
    present = reduce(lambda a, b: a & b, [F.col(f"_{tag}{i}").isNotNull() for i in range(len(keys))])
    return (
        keyed.filter(present)
        .groupBy(*[f"_{tag}{i}" for i in range(len(keys))])
        .agg(F.min("_row").alias(f"_{tag}_lo"), F.max("_row").alias(f"_{tag}_hi"))
    )


def look_up(probe: DataFrame, table: DataFrame, rules: list[tuple[list[Column], list[Column]]], row: Column,
            lo: str, hi: str) -> DataFrame:
    """Smallest and largest row of ``table`` that any rule matches, as structs.

    Each rule is (probe key, table key). The rules are alternatives; every one is a
    separate equi-join against one row per key, so an OR never becomes a nested loop
    and each probe row stays one row.
    """
    out = probe
    for i, (probe_key, table_key) in enumerate(rules):
        tag = f"r{i}_"
        side = extremes(table, table_key, row, tag)
        cond = reduce(lambda a, b: a & b, [p == F.col(f"_{tag}{j}") for j, p in enumerate(probe_key)])
        out = out.join(side, cond, "left").drop(*[f"_{tag}{j}" for j in range(len(table_key))])
    lows = [F.col(f"_r{i}__lo") for i in range(len(rules))]
    highs = [F.col(f"_r{i}__hi") for i in range(len(rules))]
    low = F.least(*lows) if len(lows) > 1 else lows[0]
    high = F.greatest(*highs) if len(highs) > 1 else highs[0]
    used = [f"_r{i}__{side}" for i in range(len(rules)) for side in ("lo", "hi")]
    return out.withColumn(lo, low).withColumn(hi, high).drop(*used)


def both_large(side: DataFrame) -> DataFrame:
    """One side of a join whose sides grow together, with the requests, payments or providers: neither is broadcast.

    Spark's size check goes by the bytes of a file and the share of its columns. Numbers in a row and repeated texts
    take a byte or two there, so millions of rows would pass for a small side and meet in the driver.
    """
    return side.hint("merge")


def match_count(lo: str, hi: str, key: str) -> Column:
    """0, 1 or 2 (two or more) distinct rows behind a ``look_up``."""
    return F.when(F.col(lo).isNull(), 0).when(F.col(f"{lo}.{key}") == F.col(f"{hi}.{key}"), 1).otherwise(2)

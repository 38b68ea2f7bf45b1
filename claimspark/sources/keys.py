"""Surrogate ids without a global sort on one task."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.session import shared_dir

_POSITION_BITS = 33  # Spark packs (partition, row in partition) into one id like this


def assign_ids(df: DataFrame, order_cols: list[str], start: int | Callable[[int], int] = 1, id_col: str = "id",
               keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Number the rows start, start+1, ... in the order of ``order_cols``.

    ``order_cols`` should identify a row; rows equal in them get their numbers in an order that is fixed once they are
    kept. Rows are range-partitioned and sorted inside their partition, then written, to the shared checkpoint
    folder or by ``keep``: the ids depend on the partition bounds, so a lost executor must not be able to redraw them.
    Only one count per partition is summed up in a single place. ``start`` may be asked for with the number of rows.
    """
    ranged = df.drop(id_col).repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    place = F.monotonically_increasing_id()
    if keep:
        fixed = keep(ranged.withColumn("_seq", place))
    else:
        shared_dir(df.sparkSession)
        fixed = ranged.checkpoint().withColumn("_seq", place)
    part = F.shiftright("_seq", _POSITION_BITS)
    # one row per partition of the frame: bounded by the number of tasks
    counts = dict(fixed.groupBy(part.alias("part")).count().collect())
    offsets = list(accumulate((counts.get(i, 0) for i in range(max(counts, default=-1) + 1)), initial=0))
    if callable(start):
        start = start(offsets[-1]) if offsets[-1] else 0
    before = F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>")
    position = F.col("_seq").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    number = F.element_at(before, (part + 1).cast("int")) + position + F.lit(start)
    return fixed.select(*[F.col(c) for c in ranged.columns], number.alias(id_col))

"""Running totals that do not put a whole group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_WIDTH = 1 << 16


def running_totals(df: DataFrame, keys: list[str], order: list[str], cols: list[str],
                   width: int = BUCKET_WIDTH) -> DataFrame:
    """Replace ``cols`` by their running sum inside ``keys``, in the order of ``order``.

    ``order`` starts with a whole-number id and identifies a row inside its keys. The
    id cuts every group into ordered buckets of at most ``width`` ids; a window runs
    inside a bucket and the sums of the earlier buckets are added. A group of any size
    is therefore spread over many tasks, and the result is the plain running sum.
    """
    tagged = df.withColumn("_bucket", F.floor(F.col(order[0]) / F.lit(width)))
    sums = tagged.groupBy(*keys, "_bucket").agg(*[F.sum(c).alias(f"_in_{c}") for c in cols])
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(
        *keys, "_bucket", *[F.coalesce(F.sum(f"_in_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in cols]
    )
    inside = (
        Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    types = dict(df.dtypes)
    totals = {c: (F.col(f"_before_{c}") + F.sum(c).over(inside)).cast(types[c]) for c in cols}
    return tagged.join(before, [*keys, "_bucket"]).select(*[totals[c].alias(c) if c in totals else F.col(c) for c in df.columns])

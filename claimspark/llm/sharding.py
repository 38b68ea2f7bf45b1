"""Contiguous shards of near equal size from global prefix sums of byte sizes. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.common import keep, partitions, utf8_size


def byte_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row: law of near equal bytes.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 1. Rows in order of doc_id, then
    size and checksum, are cut where the running size passes equal targets, so shards are
    contiguous and no shard is further from the mean than the largest row. ``slot`` counts
    from 0 in each shard. Null ids come first; equal rows take neighbouring places in any
    order; a null text has the checksum of an empty one. No rows: no rows. Fewer rows than
    shards leave shards empty.

    Only id, size and checksum are moved. Partition totals (one row per partition) give each
    range partition its start; the order inside a partition gives the rest.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (utf8_size(F.col("text")) + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    order = ["doc_id", "size", "text_crc32"]
    ranged = rows.repartitionByRange(partitions(docs.sparkSession), *order)
    ranged = keep(ranged.withColumn("part", F.spark_partition_id()))

    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = keep(
        totals.select(
            "part",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte0"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("row0"),
            F.sum("bytes").over(every).alias("total"),
        )
    )
    inside = Window.partitionBy("part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumn("n", F.row_number().over(inside)).withColumn("end", F.sum("size").over(upto))
    # one row per partition: bounded by the number of partitions
    placed = placed.join(F.broadcast(starts), "part")
    middle = (2 * (F.col("byte0") + F.col("end")) - F.col("size")).cast("decimal(38,0)")
    shard = F.floor(middle * shards / (2 * F.col("total"))).cast("int")
    placed = placed.select(*order, (F.col("row0") + F.col("n") - 1).alias("at"), F.least(shard, F.lit(shards - 1)).alias("shard"))
    placed = keep(placed)
    first = placed.groupBy("shard").agg(F.min("at").alias("first"))  # one row per shard
    out = placed.join(F.broadcast(first), "shard")
    return out.select(*order, "shard", (F.col("at") - F.col("first")).alias("slot"))

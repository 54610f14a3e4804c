"""Running sums over numbered blocks, in two levels: no window without a key holds more than a row for 4,096 blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDE = 4096


def starts(sums: DataFrame, block: str, value: str, out: str) -> DataFrame:
    """(block, out): the sum of `value` over all blocks before each; `sums` has a row a block, blocks are whole numbers."""
    dealt = sums.withColumn("_wide", F.floor(F.col(block) / WIDE))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    wide = dealt.groupBy("_wide").agg(F.sum(value).alias("_w"))
    wide = wide.select("_wide", zero(F.sum("_w").over(before(Window.orderBy("_wide")))).alias("_w0"))
    inside = dealt.select(block, "_wide", zero(F.sum(value).over(before(Window.partitionBy("_wide").orderBy(block)))).alias("_in"))
    return inside.join(wide, "_wide").select(block, (F.col("_w0") + F.col("_in")).alias(out))


def previous(ends: DataFrame, block: str, value: Column, out: str) -> DataFrame:
    """(block, out): `value` of the nearest block before each, null for the first."""
    dealt = ends.select(block, value.alias("_v"), F.floor(F.col(block) / WIDE).alias("_wide"))
    wide = dealt.groupBy("_wide").agg(F.max_by("_v", block).alias("_last"))
    wide = wide.select("_wide", F.lag("_last").over(Window.orderBy("_wide")).alias("_before"))
    own = Window.partitionBy("_wide").orderBy(block)
    inside = dealt.select(block, "_wide", F.lag("_v").over(own).alias("_p"), F.row_number().over(own).alias("_k"))
    return inside.join(wide, "_wide").select(block, F.when(F.col("_k") > 1, F.col("_p")).otherwise(F.col("_before")).alias(out))

"""Group splits: whole entities go to one side."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def group_split(pairs: DataFrame, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """(source1_entity_id, split): the ids, sorted, permuted by numpy's legacy generator; the first ceil(fraction) validate.

    Places of sorted ids come from a range sort; the driver holds one permutation of whole numbers, not the ids.
    """
    if not 0 < fraction < 1:
        raise ValueError("validation_fraction must be between 0 and 1.")
    ids = pairs.select("source1_entity_id").distinct()
    n = ids.count()
    if n < 2:
        raise ValueError("At least two Source 1 entities are required.")
    chosen = np.random.RandomState(seed).permutation(n)[: math.ceil(fraction * n)]
    places = sorted_places(ids)
    picked = pairs.sparkSession.createDataFrame([(int(i),) for i in chosen], "place long")
    return places.join(picked.withColumn("_v", F.lit(True)), "place", "left").select("source1_entity_id", F.when(F.col("_v"), "validation").otherwise("train").alias("split"))


def sorted_places(ids: DataFrame) -> DataFrame:
    """(source1_entity_id, place): the rank from 0 in code point order, numbered within ranges of the ids.

    Any ranges give the same places; a window holds one range, and the keyless one a row a range.
    """
    ranged = ids.repartitionByRange(int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source1_entity_id").withColumn("_b", F.spark_partition_id())
    ranged = ranged.persist()  # both readers must see the same ranges
    counts = ranged.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("source1_entity_id")) - 1
    return ranged.withColumn("_in", inside).join(starts, "_b").select("source1_entity_id", (F.col("_start") + F.col("_in")).alias("place"))


def hashed_split(pairs: DataFrame, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """(source1_entity_id, split) by a digest of the id alone: no sort, no driver state, stable as entities come and go."""
    share = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), "source1_entity_id")), 1, 8), 16, 10).cast("double") / float(1 << 32)
    return pairs.select("source1_entity_id").distinct().withColumn("split", F.when(share < fraction, "validation").otherwise("train"))

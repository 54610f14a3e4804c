"""Sampling of negatives by entity run. Validation and positives always stay."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import blocks

DEFAULT_RATIO, DEFAULT_ZERO_MATCH, DEFAULT_SEED = 10, 10, 42


def _check(ratio: int | None, zero_match: int) -> None:
    for what, value, least in (("ratio of negatives", 1 if ratio is None else ratio, 1), ("negatives of an entity without matches", zero_match, 0)):
        if isinstance(value, bool) or not isinstance(value, int) or value < least:
            raise ValueError(f"The {what} is a whole number from {least} on, not {value!r}.")


def entity_runs(pairs: DataFrame, lists: DataFrame | None = None) -> DataFrame:
    """Add run: pairs of an entity that follow each other without another entity's pair between.

    Runs are found over lists, one row a (source1_row_index, entity), not over pairs; lists without pairs don't break
    a run. Blocks of lists are numbered first by their last entity, so no window holds all lists.
    """
    lines = (lists if lists is not None else pairs).select("source1_row_index", "source1_entity_id").distinct().withColumn("_block", F.floor(F.col("source1_row_index") / 4096))
    ends = lines.groupBy("_block").agg(F.max_by("source1_entity_id", "source1_row_index").alias("_last"), F.min("source1_row_index").alias("_first"))
    edges = blocks.previous(ends, "_block", F.col("_last"), "_before")
    inside = Window.partitionBy("_block").orderBy("source1_row_index")
    changed = lines.join(edges, "_block").withColumn("_new", (~F.coalesce(F.lag("source1_entity_id").over(inside), F.col("_before")).eqNullSafe(F.col("source1_entity_id"))).cast("long"))
    totals = changed.groupBy("_block").agg(F.sum("_new").alias("_n"))
    starts = blocks.starts(totals, "_block", "_n", "_start")
    runs = changed.withColumn("_run", F.sum("_new").over(inside)).join(starts, "_block").select("source1_row_index", (F.col("_start") + F.col("_run")).alias("run"))
    return pairs.join(runs, "source1_row_index")


#: A run has one entity; named first, it lets pairs that lie by entity stay where they are.
RUN = ("source1_entity_id", "run")


def _checked(pairs: DataFrame) -> DataFrame:
    bad = F.raise_error(F.concat(F.lit("Unlabeled candidate for training entity "), F.col("source1_entity_id"))).cast("int")
    return pairs.withColumn("label", F.when((F.col("split") == "train") & F.col("label").isNull(), bad).otherwise(F.col("label")))


def _target(positives, ratio: int | None, zero_match: int):
    """Negatives that a run may keep."""
    return F.when(positives > 0, positives * (ratio or 0)).otherwise(F.lit(zero_match))


def sample_hashed(pairs: DataFrame, ratio: int | None = DEFAULT_RATIO, zero_match: int = DEFAULT_ZERO_MATCH, seed: int = DEFAULT_SEED) -> DataFrame:
    """Keep the negatives of each run with the smallest md5 of seed, entity and pair; all inside code generation.

    `pairs` has run, row_index, source1_entity_id, pair_id, label, split. One sort ranks and counts; only negatives of
    the training side have a digest, as no other pair is ranked out.
    """
    _check(ratio, zero_match)
    if ratio is None:
        return _checked(pairs).select(*pairs.columns)
    key = F.when((F.col("split") == "train") & (F.col("label") == 0), F.md5(F.concat_ws("-", F.lit(str(seed)), "source1_entity_id", "pair_id")))
    ranked = pairs.withColumn("_rank", F.row_number().over(Window.partitionBy(*RUN, "label").orderBy(key, "pair_id")))
    ranked = _checked(ranked.withColumn("_positives", F.count_if(F.col("label") == 1).over(Window.partitionBy(*RUN))))
    return ranked.filter(F.col("split").eqNullSafe("validation") | (F.col("label") == 1) | (F.col("_rank") <= _target(F.col("_positives"), ratio, zero_match))).select(*pairs.columns)


def sample_exact(pairs: DataFrame, ratio: int | None = DEFAULT_RATIO, zero_match: int = DEFAULT_ZERO_MATCH, seed: int = DEFAULT_SEED) -> DataFrame:
    """Keep the negatives that Python's generator, seeded with "seed-entity", draws for each run.

    Counts come from an aggregation. One row a run crosses to Python; its draw returns as an array of places.
    """
    _check(ratio, zero_match)
    if ratio is None:
        return _checked(pairs).select(*pairs.columns)

    @F.pandas_udf("array<int>")
    def draw(entity: pd.Series, negatives: pd.Series, target: pd.Series) -> pd.Series:
        return pd.Series([sorted(random.Random(f"{seed}-{e}").sample(range(int(n)), int(t))) for e, n, t in zip(entity, negatives, target, strict=True)])

    counted = pairs.groupBy(*RUN).agg(F.count_if(F.col("label") == 0).alias("_negatives"), F.count_if(F.col("label") == 1).alias("_positives"), F.max(F.col("split") == "train").alias("_train"))
    runs = counted.withColumn("_target", _target(F.col("_positives"), ratio, zero_match)).filter("_negatives > _target")
    drawn = draw("source1_entity_id", "_negatives", F.when(F.col("_train"), F.col("_target")).otherwise(F.lit(0)))
    chosen = runs.select(F.col("source1_entity_id").alias("_entity"), F.col("run").alias("_own"), drawn.alias("_chosen"))
    place = F.count_if(F.col("label") == 0).over(Window.partitionBy(*RUN).orderBy("row_index")) - 1
    # The difference keeps the run out of the join's key, which is what pairs lie by.
    own = (F.col("source1_entity_id") == F.col("_entity")) & (F.col("run") - F.col("_own") == 0)
    kept = _checked(pairs).withColumn("_place", place).join(chosen, own, "left")
    return kept.filter((F.col("split") == "validation") | (F.col("label") == 1) | F.col("_chosen").isNull() | ((F.col("label") == 0) & F.array_contains("_chosen", F.col("_place").cast("int")))).select(*pairs.columns)


def sampling_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: entities, pairs kept and dropped, by side."""
    train, valid = F.col("split") == "train", F.col("split") == "validation"
    entity = lambda c: F.count_distinct(F.when(c, F.col("source1_entity_id")))
    then = before.agg(F.count_distinct("source1_entity_id").alias("total_entities"), entity(train).alias("train_entities"), entity(valid).alias("validation_entities"), F.count_if(train & (F.col("label") == 0)).alias("_negatives"))
    now = after.agg(F.count_if(train & (F.col("label") == 1)).alias("train_positives"), F.count_if(train & (F.col("label") == 0)).alias("train_negatives_retained"), F.count_if(valid).alias("validation_pairs"), F.count(F.lit(1)).alias("total_retained_pairs"))
    both = then.crossJoin(now)  # one row by one row
    return both.select("total_entities", "train_entities", "validation_entities", "train_positives", "train_negatives_retained", (F.col("_negatives") - F.col("train_negatives_retained")).alias("train_negatives_dropped"), "validation_pairs", "total_retained_pairs")

"""Joins of candidates with records, ground truth and splits. Every candidate must match on every side, or all fail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.checks import enforce, unless, violations

RECORD = ("entity_id", "original_source", "name", "address", "country", "postal_codes", "original_postal_codes")


def join_records(pairs: DataFrame, records: DataFrame, most: int = 0) -> DataFrame:
    """Add structs source1 and target by two left equi-joins; null where a record is missing.

    Sources 2 and 3 are one target side, keyed by source and id. The plan leaves broadcast or shuffle to the
    statistics, and skewed ids to adaptive execution; up to `most` targets, of about 250 bytes each, are broadcast.
    """
    return join_targets(join_firsts(pairs, records), records, most)


def join_firsts(rows: DataFrame, records: DataFrame) -> DataFrame:
    """Add the struct source1; `rows` may be lists before their pairs are made."""
    left = records.filter("original_source = 'source1'").select(F.col("entity_id").alias("source1_entity_id"), F.struct(*RECORD).alias("source1"))
    return rows.join(left, "source1_entity_id", "left")


def join_targets(pairs: DataFrame, records: DataFrame, most: int = 0) -> DataFrame:
    """Add the struct target; up to `most` targets are broadcast."""
    right = records.filter("original_source <> 'source1'").select(F.col("original_source").alias("candidate_source"), F.col("entity_id").alias("candidate_entity_id"), F.struct(*RECORD).alias("target"))
    right = F.broadcast(right) if most and right.count() <= most else right
    return pairs.join(right, ["candidate_source", "candidate_entity_id"], "left")


def join_known(pairs: DataFrame, records: DataFrame, most: int = 5_000_000) -> DataFrame:
    """Add source1 and target, true where the record is there, else null; ids are broadcast as long as there are up to `most`."""
    left = records.filter("original_source = 'source1'").select(F.col("entity_id").alias("source1_entity_id"), F.lit(True).alias("source1")).distinct()
    right = records.filter("original_source <> 'source1'").select(F.col("original_source").alias("candidate_source"), F.col("entity_id").alias("candidate_entity_id"), F.lit(True).alias("target")).distinct()
    few = F.broadcast if records.count() <= most else lambda side: side
    return pairs.join(few(left), "source1_entity_id", "left").join(few(right), ["candidate_source", "candidate_entity_id"], "left")


def derive_labels(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Add _covered and the label the truth gives: 1 where the candidate is a match of its entity, else 0.

    Entities the truth doesn't have stay uncovered; `join_violations` makes them fail.
    """
    return label_covered(cover(pairs, truth))


def cover(rows: DataFrame, truth: DataFrame) -> DataFrame:
    """Add _matched, the entity's matches; null where the truth doesn't have it. `rows` may be lists before their pairs are made."""
    return rows.join(truth.select("source1_entity_id", F.col("matched").alias("_matched")), "source1_entity_id", "left")


def label_covered(pairs: DataFrame) -> DataFrame:
    """The labels of pairs that `cover` has seen."""
    given = pairs.withColumn("_given", F.col("label") if "label" in pairs.columns else F.lit(None).cast("int")).drop("label")
    return given.withColumn("_covered", F.col("_matched").isNotNull()).withColumn("label", F.array_contains("_matched", F.col("candidate_entity_id")).cast("int")).drop("_matched")


def assign_split(pairs: DataFrame, split: DataFrame) -> DataFrame:
    """Add the saved side of each pair's entity as split, and the one the pair came with as _given_split."""
    given = pairs.withColumn("_given_split", F.col("split") if "split" in pairs.columns else F.lit(None).cast("string")).drop("split")
    return given.join(split.select("source1_entity_id", "split"), "source1_entity_id", "left")


def join_violations(joined: DataFrame, require_labels: bool = False) -> DataFrame:
    """Broken rules of joined candidates, by row_index."""
    has = set(joined.columns)
    rules = {}
    if "split" in has:
        rules["split_unknown"] = unless(F.col("split").isNotNull(), F.concat(F.lit("No saved split assignment for "), F.col("source1_entity_id")))
    if "_given_split" in has:
        rules["split_conflict"] = unless(F.col("_given_split").isNull() | (F.col("_given_split") == F.col("split")), "Candidate split assignment conflicts with saved split.")
    if "source1" in has:
        rules["source1"] = unless(F.col("source1").isNotNull(), F.concat(F.lit("Missing record join: "), F.col("source1_entity_id")))
        rules["target"] = unless(F.col("target").isNotNull(), F.concat(F.lit("Missing record join: "), F.col("candidate_entity_id")))
    if "_covered" in has:
        rules["coverage"] = unless(F.col("_covered"), F.concat(F.lit("Missing ground-truth coverage for "), F.col("source1_entity_id"), F.lit(".")))
        rules["label_conflict"] = unless(F.col("_given").isNull() | ~F.col("_covered") | (F.col("_given") == F.col("label")), "Supplied label conflicts with ground truth.")
    if require_labels:
        rules["unlabelled"] = unless(F.col("label").isNotNull(), "Labeled candidates or complete ground-truth coverage required.")
    return violations(joined, rules, ["row_index"])


def join_candidates(pairs: DataFrame, records: DataFrame, split: DataFrame, truth: DataFrame | None = None, require_labels: bool = False, check: bool = True) -> DataFrame:
    """Candidates with both records, label and split, one row each; `pairs` has row_index.

    With `check` one action proves that nothing is missing or in conflict before the result is used.
    """
    if "label" not in pairs.columns:
        pairs = pairs.withColumn("label", F.lit(None).cast("int"))
    joined = assign_split(join_records(pairs, records), split)
    if truth is not None:
        joined = derive_labels(joined, truth)
    if check:
        enforce(join_violations(joined, require_labels), ["row_index"])
    return joined.drop("_covered", "_given", "_given_split")


def partition_candidates(joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The training and the validation side; any other split fails."""
    split = F.col("split")
    checked = joined.withColumn("split", F.when(split.isin("train", "validation"), split).otherwise(F.raise_error(F.lit("Invalid split assignment.")).cast("string")))
    return checked.filter("split = 'train'"), checked.filter("split = 'validation'")

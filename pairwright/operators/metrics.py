"""Threshold-free metrics of probabilities, as aggregates over distinct scores."""

from __future__ import annotations

import sys

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.checks import InputError

EPSILON = sys.float_info.epsilon


def check_scores(scores: DataFrame) -> None:
    """Labels 0 or 1, finite probabilities from 0 to 1, at least one row; one action."""
    p, y = F.col("probability"), F.col("label")
    state = scores.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(y.isin(0, 1), F.lit(False))).alias("labels"), F.count_if(F.coalesce(F.isnan(p), F.lit(True)) | (F.abs(p) == float("inf"))).alias("finite"), F.count_if((p < 0) | (p > 1)).alias("range")).first()
    broken = {"A table of scores must be nonempty.": not state["n"], "Invalid values: labels are 0 or 1, scores are finite numbers.": state["labels"] or state["finite"], "A score lies outside [0, 1].": state["range"]}
    for message, fails in broken.items():
        if fails:
            raise InputError(message)


def by_score(scores: DataFrame) -> DataFrame:
    """(probability, p, n): positives and negatives of each distinct score, ties together."""
    found = scores.groupBy("probability").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n"))
    return found.persist(StorageLevel.MEMORY_AND_DISK)  # cuts, block sums and running sums read it; scores are made once


def running(counts: DataFrame, blocks: int = 256) -> DataFrame:
    """Add cp and cn, positives and negatives with this score or a higher one.

    Scores are dealt over blocks of about equal numbers of them, cut at approximate quantiles; any cuts give the same
    sums. Block sums are added up over few rows, so no window holds all scores.
    """
    cuts = counts.approxQuantile("probability", [i / blocks for i in range(1, blocks)], 1 / (4 * blocks))
    cuts = F.array(*[F.lit(float(c)) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<double>")
    dealt = counts.withColumn("_b", F.size(F.filter(cuts, lambda c: c <= F.col("probability"))))
    above = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("_b").agg(F.sum("p").alias("sp"), F.sum("n").alias("sn"))
    starts = sums.select("_b", F.coalesce(F.sum("sp").over(above), F.lit(0)).alias("p0"), F.coalesce(F.sum("sn").over(above), F.lit(0)).alias("n0"))
    inside = Window.partitionBy("_b").orderBy(F.desc("probability"))
    return dealt.withColumn("p1", F.sum("p").over(inside)).withColumn("n1", F.sum("n").over(inside)).join(starts, "_b").select("probability", "p", "n", (F.col("p0") + F.col("p1")).alias("cp"), (F.col("n0") + F.col("n1")).alias("cn"))


def log_loss(scores: DataFrame) -> DataFrame:
    q = F.greatest(F.lit(EPSILON), F.least(F.lit(1 - EPSILON), F.col("probability")))
    return scores.agg(F.avg(-(F.col("label") * F.log(q) + (1 - F.col("label")) * F.log(1 - q))).alias("log_loss"))


def brier(scores: DataFrame) -> DataFrame:
    return scores.agg(F.avg((F.col("probability") - F.col("label")) * (F.col("probability") - F.col("label"))).alias("brier_score"))


def roc_auc(scores: DataFrame) -> DataFrame:
    """Share of positive and negative pairs in right order, ties as half; null for one class."""
    ranked = running(by_score(scores))
    pairs = F.sum(F.col("n") * (F.col("cp") - F.col("p") / 2.0))
    return ranked.agg((pairs / F.nullif(F.sum("p") * F.sum("n"), F.lit(0))).alias("roc_auc"))


def average_precision(scores: DataFrame) -> DataFrame:
    """Precision at each distinct score, weighed by the recall it adds; null for one class."""
    ranked = running(by_score(scores))
    steps = F.sum(F.col("p") * F.col("cp") / (F.col("cp") + F.col("cn")))
    return ranked.agg(F.when(F.sum("n") > 0, steps / F.nullif(F.sum("p"), F.lit(0))).alias("average_precision"))


def evaluate(scores: DataFrame) -> dict:
    """All metrics of a table (label, probability) as one report."""
    kept = scores.select("label", "probability").persist(StorageLevel.MEMORY_AND_DISK)  # every metric reads it; scores are made once
    check_scores(kept)
    parts = kept.agg(F.count(F.lit(1)).alias("count"), F.sum("label").alias("positives"))
    for metric in (log_loss, brier, roc_auc, average_precision):
        parts = parts.crossJoin(metric(kept))  # one row by one row
    found = parts.first().asDict()
    kept.unpersist()
    return found

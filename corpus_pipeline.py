"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

Quality: documents that the classifier rejects go. Near duplicates: one document of each component of the n-gram
Jaccard join stays, the one with the smallest id; texts are linked from a similarity of 0.8 of their five-word shingles
on (op5 itself has its own values). Decontamination: documents with a verified test item go. Mixing:
documents repeat, or go, as their source's target asks. Sharding: every row gets its shard and slot.

Defined results: null and empty texts are scored like any other, are no near duplicates and hold no test item; rows
without doc_id stay in the stages that drop by id; null sources are one source, weighed last; of documents that are
linked the smallest id stays, and rows that share it stay together; an empty table gives an empty result with the
columns of the last stage; further columns pass through all stages, whatever their names but those that start with an
underscore; where documents have a column shard or slot, the last stage's own gets an underscore at its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairwright.llm.decontam import drop_leaks
from pairwright.llm.jaccard import keep_first
from pairwright.llm.mixing import mix
from pairwright.llm.quality import keep_good
from pairwright.llm.shards import assign, number
from pairwright.llm.util import forget, materialize, scratch, table

#: What the near-duplicate stage links by: words of a shingle and percent of similarity.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs, percent=NEAR_PERCENT, k=NEAR_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return number(materialize(assign(docs), "pipeline-shards"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix_sources", mix_sources), ("shard", shard)]

#: SQL can't express the classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the whole table of documents; a stage's table is deleted once the next one is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if name != STAGES[0][0]:
            forget(docs)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Audits over whole inputs: duplicates, coverage, summaries, record consistency, recall, fingerprints."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.postal import record_codes


def later_occurrences(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Every row whose key an earlier row has. Rows are moved and sorted once, and not moved where they lie by part of the key."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_k > 1").select(*rows.columns)


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """(key, occurrences) of keys that occur more than once."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def coverage(lists: DataFrame) -> DataFrame:
    """(source1_entity_id, candidate_count, first_row_index): every entity of the lists, also those without candidates.

    `lists` has source1_entity_id, candidates (the comma list) and source1_row_index, one row a line.
    """
    from ..functions.text import is_blank

    n = F.when(is_blank(F.col("candidates")), F.lit(0)).otherwise(F.size(F.split("candidates", ",")))
    return lists.groupBy("source1_entity_id").agg(F.sum(n).cast("long").alias("candidate_count"), F.min("source1_row_index").alias("first_row_index"))


def coverage_totals(covered: DataFrame) -> DataFrame:
    empty = F.col("candidate_count") == 0
    return covered.agg(F.count(F.lit(1)).alias("total_source1_entities"), F.count_if(~empty).alias("non_empty_entities"), F.count_if(empty).alias("empty_entities"), F.coalesce(F.sum("candidate_count"), F.lit(0)).alias("total_candidate_pairs"))


def empty_entries(covered: DataFrame) -> DataFrame:
    """What a result says of an entity without candidates."""
    return covered.filter("candidate_count = 0").select(F.col("source1_entity_id").alias("source1_id"), F.array().cast("array<string>").alias("matches"), F.lit(0).alias("num_candidates"))


def batch_summary(pairs: DataFrame) -> DataFrame:
    """One row: totals, entities, sources, labelled and unlabelled pairs, pairs by split ("unassigned" without one)."""
    label = F.col("label") if "label" in pairs.columns else F.lit(None).cast("int")
    split = F.coalesce(F.col("split"), F.lit("unassigned")) if "split" in pairs.columns else F.lit("unassigned")
    by_entity = pairs.groupBy("source1_entity_id", "candidate_source", split.alias("split")).agg(F.count(F.lit(1)).alias("n"), F.count(label).alias("labels"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return by_entity.agg(
        total("n").alias("total_candidates"), F.count_distinct("source1_entity_id").alias("unique_source1_entities"),
        F.array_sort(F.collect_set("candidate_source")).alias("candidate_sources"), total("labels").alias("labeled_count"),
        (total("n") - total("labels")).alias("unlabeled_count"),
        *[total(F.when(F.col("split") == s, F.col("n"))).alias(f"{s}_count") for s in ("train", "validation", "unassigned")],
    )


def record_fields(record: str) -> Column:
    """What must be equal wherever a record occurs, as one text; null differs from every value."""
    field = lambda f: F.col(f"{record}.{f}")
    return F.to_json(F.struct(field("name").alias("n"), field("address").alias("a"), field("postal_code").alias("p"), field("country").alias("c"), record_codes(field("postal_code"), field("postal_codes")).alias("s")), {"ignoreNullFields": "false"})


def pair_records(pairs: DataFrame) -> DataFrame:
    """(side, entity_id, row_index, record, fields): both records of every pair."""
    side = lambda n: pairs.select(F.lit(n).alias("side"), F.col(f"source{n}_id").alias("entity_id"), "row_index", "split", F.col(f"source{n}").alias("record"), record_fields(f"source{n}").alias("fields"))
    return side(1).unionByName(side(2))


def inconsistent_records(pairs: DataFrame) -> DataFrame:
    """(side, entity_id, versions) of records that differ between pairs."""
    return pair_records(pairs).groupBy("side", "entity_id").agg(F.count_distinct("fields").alias("versions")).filter("versions > 1")


def unique_records(pairs: DataFrame) -> DataFrame:
    """(side, entity_id, record): the first record of each entity in pair order, by id and not by text."""
    first = F.min_by("record", "row_index").alias("record")
    return pair_records(pairs).groupBy("side", "entity_id").agg(first)


def missed_matches(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """Edges of the truth that no candidate covers."""
    return truth.join(pairs.select("source1_entity_id", "candidate_entity_id"), ["source1_entity_id", "candidate_entity_id"], "left_anti")


def recall(truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: matches of the truth, those covered, and their share."""
    found = truth.join(pairs.select("source1_entity_id", "candidate_entity_id").distinct(), ["source1_entity_id", "candidate_entity_id"], "left_semi")
    return truth.agg(F.count(F.lit(1)).alias("matches")).crossJoin(found.agg(F.count(F.lit(1)).alias("covered"))).withColumn("recall", F.when(F.col("matches") > 0, F.col("covered") / F.col("matches")))  # one row by one row


def input_fingerprint(pairs: DataFrame, keys: tuple[str, ...] = ("name", "address", "postal_code", "country", "postal_codes")) -> str:
    """SHA-256 of the JSON of all pairs in order, keys sorted, as Python writes it.

    Rows stream through the driver one partition at a time; it holds none of them.
    """
    ordered = pairs.orderBy("row_index")
    total = hashlib.sha256()
    total.update(b"[")
    for i, r in enumerate(ordered.toLocalIterator()):
        row = r.asDict(recursive=True)
        facts = {k: row[k] for k in ("pair_id", "source1_id", "source2_id", "label")} | {s: {k: row[s].get(k) for k in keys} for s in ("source1", "source2")}
        total.update((", " if i else "").encode() + json.dumps(facts, sort_keys=True).encode())
    total.update(b"]")
    return total.hexdigest()


def distributed_fingerprint(rows: DataFrame) -> DataFrame:
    """One row: count and an order-free digest of a table, made by the executors alone."""
    digest = F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256)
    part = lambda k: F.conv(F.substring(digest, 1 + 12 * k, 12), 16, 10).cast("decimal(38,0)")
    return rows.select(*[part(k).alias(f"p{k}") for k in range(4)]).agg(F.count(F.lit(1)).alias("rows"), F.sha2(F.concat_ws(":", *[F.coalesce(F.sum(f"p{k}"), F.lit(0)).cast("string") for k in range(4)]), 256).alias("digest"))


def split_fingerprint(ids: DataFrame) -> DataFrame:
    """(split, entities, sha256) of each side's sorted ids; a running order by id keeps the digest reproducible."""
    return ids.groupBy("split").agg(F.count(F.lit(1)).alias("entities"), F.sha2(F.to_json(F.array_sort(F.collect_set("source1_entity_id"))), 256).alias("sha256"))

"""Scoring: candidates to one probability each, with their provenance, in order."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.checks import enforce, unless, violations
from ..functions.features import FEATURE_NAMES, feature_columns, record_features, with_vectors
from ..functions.kernel import features_of, held_packs, record_packs
from ..functions.storage import in_order, write_lines
from ..functions.tfidf import TfIdf
from ..operators.candidates import with_row_index
from ..operators.joins import join_candidates
from ..sources.candidates import read_candidates
from .ensemble import Ensemble

#: Targets whose ids are broadcast, of about 100 bytes each, and contents of targets, of about 2 kB each.
MOST_IDS, MOST_TEXTS = 5_000_000, 100_000
#: Packs of entities and of contents of targets that every worker holds, of about 400 bytes each there.
MOST_PACKS = 200_000


def same_texts(records: DataFrame) -> DataFrame:
    """(_text, name, address, country, postal_codes): each distinct content of records once, by its digest; two contents of one digest fail."""
    content = F.struct("name", "address", "country", "postal_codes")
    plain = F.to_json(content)
    found = records.select("_text", content.alias("r"), plain.alias("j")).groupBy("_text").agg(F.first("r").alias("r"), F.min("j").alias("a"), F.max("j").alias("b"))
    known = F.when(F.col("a") == F.col("b"), F.col("r")).otherwise(F.raise_error(F.lit("Two records have the same digest.")))
    return found.select("_text", known.alias("r")).select("_text", "r.*")


def near(side: DataFrame, rows: int, most: int) -> DataFrame:
    return F.broadcast(side) if rows <= most else side


def shared(*vocabularies: TfIdf | None) -> bool:
    return all(v is None or v.shared() is not None for v in vocabularies)


def sizes(records: DataFrame) -> dict:
    """Numbers of entities of source 1, of targets, and of contents of targets, about."""
    first = F.col("entity_id").startswith("S1-")
    text = F.xxhash64(F.to_json(F.struct("name", "address", "country", "postal_codes")))
    return records.agg(F.count_if(first).alias("firsts"), F.count_if(~first).alias("ids"), F.approx_count_distinct(F.when(~first, text)).alias("texts")).first().asDict()


def stays(records: DataFrame, name: TfIdf | None = None, address: TfIdf | None = None, size: dict | None = None) -> bool:
    """Whether `featurize` leaves pairs in the partitions where they lie: workers hold the packs of all records."""
    size = size or sizes(records)
    return shared(name, address) and size["ids"] <= MOST_IDS and size["firsts"] + size["texts"] <= MOST_PACKS


def sides(name: TfIdf | None, address: TfIdf | None, mask_multiple_codes: bool = False) -> tuple[Callable, Callable]:
    """How records become a side of pairs, (entity_id, side), and how pairs with both sides get the features as columns.

    Where workers can hold the vocabularies, sides are packs and batches are compared; else they have vectors.
    """
    if shared(name, address):
        side = lambda records, out: record_packs(records, mask_multiple_codes).withColumnRenamed("pack", out)
        return side, lambda rows: rows.withColumn("_f", features_of(F.col("left"), F.col("right"), name, address)).select("*", "_f.*")
    pack = F.struct("f", "name_vector", "address_vector")
    side = lambda records, out: with_vectors(record_features(records, mask_multiple_codes), name, address).select("entity_id", pack.alias(out))
    return side, lambda rows: rows.select("*", *feature_columns())


def featurize(pairs: DataFrame, records: DataFrame, name: TfIdf | None = None, address: TfIdf | None = None, mask_multiple_codes: bool = False) -> DataFrame:
    """The pairs with the twelve features as columns.

    Each distinct content of a target is packed once, and each entity of source 1. Pairs that lie by their entity stay
    there: entities come to them, and targets are broadcast, ids with a digest and contents by digest, as long as there
    are up to MOST_IDS and MOST_TEXTS of them. Where `stays` holds, workers have all packs, and only places of packs
    come to the pairs, which lie as they did. A pair without one of its records fails the query; none is dropped.
    """
    first = F.col("entity_id").startswith("S1-")
    side, compared = sides(name, address, mask_multiple_codes)
    left = side(records.filter(first), "left").withColumnRenamed("entity_id", "source1_entity_id")
    targets = records.filter(~first).withColumn("_text", F.xxhash64(F.to_json(F.struct("name", "address", "country", "postal_codes"))))
    right = side(same_texts(targets).withColumn("entity_id", F.col("_text")), "right").withColumnRenamed("entity_id", "_text")
    ids = targets.select(F.col("entity_id").alias("candidate_entity_id"), "_text")
    size = sizes(records)
    if stays(records, name, address, size):
        (left, right), packs = held_packs(left.withColumnRenamed("left", "pack"), right.withColumnRenamed("right", "pack"))
        left, ids = left.withColumnRenamed("place", "left"), ids.join(F.broadcast(right.withColumnRenamed("place", "right")), "_text").drop("_text")
        joined = pairs.join(F.broadcast(left), "source1_entity_id", "left").join(F.broadcast(ids), "candidate_entity_id", "left")
        compared = lambda rows: rows.withColumn("_f", features_of(F.col("left"), F.col("right"), name, address, packs)).select("*", "_f.*")
    else:
        joined = pairs.join(left.hint("shuffle_hash"), "source1_entity_id", "left")
        joined = joined.join(near(ids, size["ids"], MOST_IDS), "candidate_entity_id", "left").join(near(right, size["texts"], MOST_TEXTS), "_text", "left")
    found = lambda side, key: F.coalesce(side, F.raise_error(F.concat(F.lit("Missing record join: "), F.col(key))).cast(joined.schema[side].dataType)).alias(side)
    return compared(joined.select(*pairs.columns, found("left", "source1_entity_id"), found("right", "candidate_entity_id"))).select(*pairs.columns, *FEATURE_NAMES)


def guarded(probability: Column) -> Column:
    """The probability; a value that isn't finite or not from 0 to 1 fails the query."""
    return F.when((probability >= 0) & (probability <= 1) & ~F.isnan(probability), probability).otherwise(F.raise_error(F.lit("Model returned an invalid probability.")).cast("double"))


def score(pairs: DataFrame, records: DataFrame, ensemble: Ensemble, name: TfIdf | None = None, address: TfIdf | None = None, mask_multiple_codes: bool = True) -> DataFrame:
    """(pair_id, source1_id, target_source, target_id, probability) with the provenance columns of the pairs."""
    if tuple(ensemble.feature_names) != FEATURE_NAMES:
        raise ValueError("Saved model feature names/order do not match the training schema.")
    rows = featurize(pairs, records, name, address, mask_multiple_codes)
    provenance = [c for c in ("source1_row_index", "candidate_rank", "row_index", "label") if c in pairs.columns]
    return rows.select("pair_id", F.col("source1_entity_id").alias("source1_id"), F.when(F.col("candidate_source") == "source2", "S2").otherwise("S3").alias("target_source"), F.col("candidate_entity_id").alias("target_id"), guarded(ensemble.probability()).alias("probability"), *provenance)


def write_scores(scores: DataFrame, path: str | Path, provenance: bool = True, dealt: bool = False, packed: bool = False) -> int:
    """One JSON object a line in candidate order; an existing path fails. A score that fails leaves no file.

    Partitions are in order, so the order is that of the files' names and lines. `dealt` says that those of the scores
    are, by list; they are then not moved. `packed` writes gzip files.
    """
    columns = ["pair_id", "source1_id", "target_source", "target_id", "probability", *(["source1_row_index", "candidate_rank"] if provenance else [])]
    order = ("source1_row_index", "candidate_rank")
    ordered = scores.sortWithinPartitions(*order) if dealt else in_order(scores, *order)
    return write_lines(ordered.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")), path, packed)


def write_score_table(scores: DataFrame, path: str | Path, dealt: bool = False, packed: bool = False) -> None:
    """Tab-separated scores, six decimals; `dealt` and `packed` are those of `write_scores`."""
    order = ("source1_row_index", "candidate_rank")
    ordered = scores.sortWithinPartitions(*order) if dealt else in_order(scores, *order)
    rows = ordered.select("pair_id", "source1_id", "target_source", "target_id", F.format_string("%.6f", "probability").alias("probability"))
    writer = rows.write.mode("errorifexists")
    if packed:
        writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.csv(str(path), sep="\t", header=True)


def score_file(spark: SparkSession, candidates: str | Path | Iterable[str], records: DataFrame, split: DataFrame, ensemble: Ensemble, out: str | Path, name: TfIdf | None = None, address: TfIdf | None = None) -> int:
    """A candidate file to a file of scores: checked, joined, scored, written in order."""
    pairs = with_row_index(read_candidates(spark, candidates))
    join_candidates(pairs, records, split)
    return write_scores(score(pairs, records, ensemble, name, address), out)


def pairs_score(pairs: DataFrame, ensemble: Ensemble, name: TfIdf, address: TfIdf) -> DataFrame:
    """Scores of labelled pairs that carry their records (row_index, pair_id, ids, source1, source2)."""
    from ..functions.postal import record_codes

    def content(n: int) -> Column:
        r = lambda f: F.col(f"source{n}.{f}")
        return F.struct(r("name").alias("name"), r("address").alias("address"), r("country").alias("country"), record_codes(r("postal_code"), r("postal_codes")).alias("postal_codes"))

    fields = ("name", "address", "country", "postal_codes")
    digest = lambda c: F.xxhash64(*[c[f] for f in fields], *[c[f].isNull() for f in fields])
    contents = pairs.select(F.explode(F.array(content(1), content(2))).alias("c")).select("c.*").distinct().persist(StorageLevel.MEMORY_AND_DISK)
    texts = same_texts(contents.withColumn("_text", digest({f: F.col(f) for f in fields}))).withColumn("entity_id", F.col("_text"))
    side, compared = sides(name, address)
    rows, size = pairs.withColumn("_left", digest(content(1))).withColumn("_right", digest(content(2))), contents.count()
    held = shared(name, address) and size <= MOST_PACKS  # then only places of packs come to the pairs
    if held:
        (places,), packs = held_packs(side(texts, "pack"))
        compared = lambda rows: rows.withColumn("_f", features_of(F.col("left"), F.col("right"), name, address, packs)).select("*", "_f.*")
    for out in ("left", "right"):
        known = F.broadcast(places.withColumnRenamed("place", out)) if held else near(side(texts, out), size, MOST_TEXTS)
        rows = rows.join(known.withColumnRenamed("entity_id", f"_{out}"), f"_{out}")
    return compared(rows).select(*pairs.columns, *FEATURE_NAMES).withColumn("probability", guarded(ensemble.probability()))


def score_violations(scores: DataFrame) -> DataFrame:
    good = (F.col("probability") >= 0) & (F.col("probability") <= 1) & ~F.isnan("probability")
    return violations(scores, {"probability": unless(good, "Model returned an invalid probability.")}, ["pair_id"])


def check_scored(scores: DataFrame, pairs: DataFrame) -> None:
    """Every pair exactly once, every probability valid."""
    enforce(score_violations(scores), ["pair_id"])
    off = pairs.select("pair_id", F.lit(1).alias("k")).unionByName(scores.select("pair_id", F.lit(-1).alias("k"))).groupBy("pair_id").agg(F.sum("k").alias("k")).filter("k <> 0")
    if not off.isEmpty():
        raise ValueError("Model scoring changed candidate alignment.")

"""Records from normalised source rows, and the projections that models and inference read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.checks import enforce, unless, violations
from ..functions.text import blank_to_null, is_blank, pieces, strip
from .audits import later_occurrences

#: The sources and how their ids begin.
PREFIXES = {"source1": "S1-", "source2": "S2-", "source3": "S3-"}
SOURCES = tuple(PREFIXES)


def good_id(c: Column, prefix: str) -> Column:
    """A prefixed id with a body and no white space around it."""
    return (c == strip(c)) & c.startswith(prefix) & ~is_blank(F.substring(c, len(prefix) + 1, 1 << 30))


def adapt_records(rows: DataFrame, source: str) -> DataFrame:
    """Records of one source: five of its columns, blanks as null, postal codes split at white space."""
    code = F.col("postal_codes")
    return rows.select(
        "entity_id", F.lit(source).alias("original_source"),
        blank_to_null(F.col("business_name_normalized")).alias("name"), blank_to_null(F.col("business_address_normalized")).alias("address"),
        blank_to_null(F.col("country_normalized")).alias("country"), pieces(F.coalesce(code, F.lit(""))).alias("postal_codes"), code.alias("original_postal_codes"),
    )


def record_violations(records: DataFrame) -> DataFrame:
    """Ids that don't fit their source, and ids that stand twice in it."""
    fits = F.lit(False)
    for source, prefix in PREFIXES.items():
        fits = fits | ((F.col("original_source") == source) & good_id(F.col("entity_id"), prefix))
    bad = violations(records, {"id": unless(fits, F.concat(F.lit("Invalid ID for "), F.col("original_source"), F.lit(": "), F.coalesce("entity_id", F.lit("null"))))}, ["entity_id"])
    again = later_occurrences(records.select("original_source", "entity_id"), ["original_source", "entity_id"], ["entity_id"])
    return bad.unionByName(again.select("entity_id", F.lit(9).alias("rank"), F.lit("duplicate").alias("rule"), F.concat(F.lit("Ambiguous record join: duplicate "), F.col("entity_id")).alias("message")))


def all_records(source1: DataFrame, source2: DataFrame, source3: DataFrame, check: bool = True) -> DataFrame:
    """The adapted records of the three sources as one table."""
    found = adapt_records(source1, "source1").unionByName(adapt_records(source2, "source2")).unionByName(adapt_records(source3, "source3"))
    if check:
        enforce(record_violations(found), ["entity_id"])
    return found


def ml_record(record: str | None = None, mask_multiple_codes: bool = False, collection_aware: bool = False) -> Column:
    """The struct that features read: name, address, postal_code, country, postal_codes.

    Scalar form: one postal code; a record with several fails, or has none where they are masked. Collection form: the
    list of codes and no scalar.
    """
    if mask_multiple_codes and collection_aware:
        raise ValueError("Multiple postal codes can't both be masked and kept.")
    at = lambda f: F.col(f"{record}.{f}" if record else f)
    codes = at("postal_codes")
    none = F.lit(None).cast("string")
    if collection_aware:
        code, kept = none, codes
    else:
        several = none if mask_multiple_codes else F.raise_error(F.concat(F.lit("Record "), at("entity_id"), F.lit(" has multiple postal codes."))).cast("string")
        code, kept = F.when(F.size(codes) > 1, several).otherwise(F.try_element_at(codes, F.lit(1))), F.lit(None).cast("array<string>")
    return F.struct(at("name").alias("name"), at("address").alias("address"), code.alias("postal_code"), at("country").alias("country"), kept.alias("postal_codes"))


def ml_pairs(joined: DataFrame, mask_multiple_codes: bool = False, collection_aware: bool = False) -> DataFrame:
    """Joined candidates as pairs: row_index, pair_id, source1_id, source2_id, source1, source2, label, split."""
    return joined.select(*_pair(mask_multiple_codes, collection_aware), "label", "split")


def _pair(mask_multiple_codes: bool, collection_aware: bool, target: str = "source2") -> list:
    one = lambda side: ml_record(side, mask_multiple_codes, collection_aware)
    return ["row_index", "pair_id", F.col("source1.entity_id").alias("source1_id"), F.col("target.entity_id").alias(f"{target}_id"), one("source1").alias("source1"), one("target").alias(target)]


def inference_rows(joined: DataFrame, mask_multiple_codes: bool = False, collection_aware: bool = False) -> DataFrame:
    """Joined candidates as nested rows for a configurable mapping: both records, S2 or S3, all postal codes, label, split."""
    row_index, pair_id, source1_id, target_id, source1, target = _pair(mask_multiple_codes, collection_aware, "target")
    source = F.when(F.col("candidate_source") == "source2", "S2").otherwise("S3").alias("target_source")
    codes = [F.col(f"{side}.postal_codes").alias(f"{side}_postal_codes") for side in ("source1", "target")]
    return joined.select(row_index, pair_id, source1_id, target_id, source, source1, target, *codes, "label", "split")

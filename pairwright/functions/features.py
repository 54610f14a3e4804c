"""The twelve features of a pair, in their contractual order.

All that depends on one record alone (folding, tokens, code sets) is made once for each record by `record_features`,
before any join; `pair_features` compares two such records. Missing values give 0 and an availability flag, never null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .postal import code_set, codes_available, codes_match
from .text import fold, has_digit, is_blank, number_tokens, pieces, squeeze, strip, word_tokens
from .tfidf import TfIdf, cosine

FEATURE_NAMES = (
    "name_token_jaccard", "name_levenshtein_similarity", "name_char_tfidf_similarity", "address_token_jaccard",
    "address_levenshtein_similarity", "address_char_tfidf_similarity", "address_numeric_overlap",
    "address_numeric_available", "postal_code_match", "postal_code_available", "country_match", "country_available",
)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays without duplicates; 0 where either is empty."""
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), common / (F.size(a) + F.size(b) - common)).otherwise(F.lit(0.0))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """1 less the distance over the longer length, in code points; 0 where either is empty."""
    return F.when((a != "") & (b != ""), 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))).otherwise(F.lit(0.0))


def record_features(records: DataFrame, mask_multiple_codes: bool = False, folded=fold) -> DataFrame:
    """(entity_id, f): what the features need of each record, in one struct.

    With `mask_multiple_codes` a record with more than one postal code counts as one without.
    """
    name, address = folded(F.col("name")), folded(F.col("address"))
    codes = F.coalesce(F.col("postal_codes"), F.array().cast("array<string>"))
    if mask_multiple_codes:
        codes = F.when(F.size(codes) > 1, F.array().cast("array<string>")).otherwise(codes)
    facts = F.struct(
        strip(name).alias("name"), F.array_distinct(pieces(name)).alias("name_tokens"),
        strip(address).alias("address"), word_tokens(address).alias("address_tokens"), number_tokens(address).alias("numbers"),
        has_digit(F.col("address")).alias("numeric"), code_set(codes).alias("codes"),
        F.when(~is_blank(F.col("country")), squeeze(folded(F.col("country")))).alias("country"),
    )
    return records.select("entity_id", facts.alias("f"))


def with_vectors(records: DataFrame, name: TfIdf | None, address: TfIdf | None) -> DataFrame:
    """Add the TF-IDF vectors of name and address to the records' features, made once for each distinct text."""
    found = records.select("entity_id", "f", F.col("f.name").alias("_name"), F.col("f.address").alias("_address"))
    none = F.lit(None).cast("binary")
    found = found.join(name.vectors(found, "_name", "name_vector"), "_name", "left") if name else found.withColumn("name_vector", none)
    found = found.join(address.vectors(found, "_address", "address_vector"), "_address", "left") if address else found.withColumn("address_vector", none)
    return found.select("entity_id", "f", "name_vector", "address_vector")


def pair_features(left: str = "left", right: str = "right") -> dict[str, Column]:
    """The features by name, for structs `left` and `right` of (f, name_vector, address_vector)."""
    a = lambda field: F.col(f"{left}.f.{field}")
    b = lambda field: F.col(f"{right}.f.{field}")
    both = a("country").isNotNull() & b("country").isNotNull()
    return {
        "name_token_jaccard": jaccard(a("name_tokens"), b("name_tokens")),
        "name_levenshtein_similarity": levenshtein_similarity(a("name"), b("name")),
        "name_char_tfidf_similarity": cosine(F.col(f"{left}.name_vector"), F.col(f"{right}.name_vector")),
        "address_token_jaccard": jaccard(a("address_tokens"), b("address_tokens")),
        "address_levenshtein_similarity": levenshtein_similarity(a("address"), b("address")),
        "address_char_tfidf_similarity": cosine(F.col(f"{left}.address_vector"), F.col(f"{right}.address_vector")),
        "address_numeric_overlap": jaccard(a("numbers"), b("numbers")),
        "address_numeric_available": (a("numeric") & b("numeric")).cast("int"),
        "postal_code_match": codes_match(a("codes"), b("codes")),
        "postal_code_available": codes_available(a("codes"), b("codes")),
        "country_match": F.when(both & (a("country") == b("country")), 1).otherwise(0),
        "country_available": both.cast("int"),
    }


def feature_columns(left: str = "left", right: str = "right") -> list[Column]:
    return [c.cast("double").alias(n) for n, c in pair_features(left, right).items()]

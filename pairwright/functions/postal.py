"""Postal codes: normal form, collections, and the two feature contracts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACES, fold

SCALAR_CONTRACT, COLLECTION_CONTRACT = "postal-scalar-v1", "postal-collection-v2"


def normal_code(c: Column) -> Column:
    """Folded, without white space and hyphens; nothing is split or cut."""
    return F.regexp_replace(fold(c), f"[{SPACES}-]+", "")


def code_set(codes: Column) -> Column:
    """Distinct normal codes of an array, sorted; empty ones go, a null array is an empty set."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce(codes, F.array().cast("array<string>")), normal_code), lambda c: c != "")))


def record_codes(scalar: Column, codes: Column) -> Column:
    """The code set of a record with a scalar and a collection: the collection wins where there is one.

    A scalar beside a collection must be its only member, else the row fails.
    """
    one = F.filter(F.array(normal_code(scalar)), lambda c: c != "")
    many = code_set(codes)
    conflict = codes.isNotNull() & (F.size(one) > 0) & (one != many)
    return F.when(conflict, F.raise_error(F.lit("Postal code conflicts with postal code collection.")).cast("array<string>")).when(codes.isNotNull(), many).otherwise(one)


def codes_match(a: Column, b: Column) -> Column:
    return F.arrays_overlap(a, b).cast("int")


def codes_available(a: Column, b: Column) -> Column:
    return ((F.size(a) > 0) & (F.size(b) > 0)).cast("int")

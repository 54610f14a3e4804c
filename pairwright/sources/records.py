"""Normalised entity tables and the check that their files are the ones an index or model was made from."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("entity_id", "business_name", "business_address", "country", "business_name_normalized", "business_name_tokens", "business_address_normalized", "address_tokens", "address_numbers", "postal_codes", "country_normalized")


def read_source(spark: SparkSession, path: str | Path) -> DataFrame:
    """One normalised entity table: tab-separated text with a header, all columns text. A row of another width fails the read."""
    read = spark.read.option("columnPruning", False)
    return read.csv(str(path), sep="\t", header=True, quote='"', escape='"', mode="FAILFAST", schema=", ".join(f"{c} string" for c in COLUMNS), enforceSchema=False, nullValue="\0")


class IntegrityError(ValueError):
    """A source file that isn't the one on record."""


def fingerprints(spark: SparkSession, path: str | Path) -> DataFrame:
    """(path, length, sha256) of each file of a source; made by the executors."""
    return spark.read.format("binaryFile").load(str(path)).select("path", "length", F.sha2("content", 256).alias("sha256"))


def check_fingerprints(spark: SparkSession, path: str | Path, manifest: DataFrame) -> None:
    """Raise where a file is missing, new, or differs from the manifest (path, length, sha256)."""
    now, then = fingerprints(spark, path).alias("n"), manifest.alias("t")
    off = now.join(then, "path", "full").filter(~F.col("n.sha256").eqNullSafe(F.col("t.sha256")) | ~F.col("n.length").eqNullSafe(F.col("t.length")))
    if (bad := off.select("path").orderBy("path").first()) is not None:
        raise IntegrityError(f"{bad['path']} differs from the file on record.")

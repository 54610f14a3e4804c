"""Ground truth and saved splits: delimited text with a header, checked line by line."""

from __future__ import annotations

import csv
import json
from collections.abc import Iterable, Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.checks import enforce, unless, violations
from ..functions.text import SPACES, is_blank, strip
from ..operators.audits import later_occurrences
from .lines import numbered_lines

#: The shape of a match id, and what may stand between two.
MATCH_ID = "S[23]-[A-Za-z0-9_]+"
BETWEEN = rf"[^{SPACES},;\[\](){{}}'\"|]"


def matches(cell: Column) -> Column:
    """The ids in a cell of matches; a blank, [], null or None has none."""
    text = strip(cell)
    return F.when(text.isin("", "[]", "null", "None"), F.array().cast("array<string>")).otherwise(F.regexp_extract_all(text, F.lit(f"({MATCH_ID})"), 1))


def unparsed(cell: Column) -> Column:
    """True where a cell holds what is neither an id nor a separator."""
    text = strip(cell)
    return ~text.isin("", "[]", "null", "None") & F.regexp_replace(text, MATCH_ID, "").rlike(BETWEEN)


def quoted_fields(value: Column) -> Column:
    """The fields of a tab-separated line with quotes, as the csv dialect reads them."""
    field = r'(?:^|\t)("(?:[^"]|"")*"[^\t]*|[^\t]*)'
    raw = F.regexp_extract_all(value, F.lit(field), 1)
    return F.transform(raw, lambda f: F.when(f.startswith('"'), F.replace(F.regexp_replace(f, r'^"((?:[^"]|"")*)"', "$1"), F.lit('""'), F.lit('"'))).otherwise(f))


def _table(spark: SparkSession, source, needed: list[str], lower: bool, what: str) -> tuple[DataFrame, int, list[str]]:
    lines = numbered_lines(spark, source)
    first = lines.filter("line_no = 1").first()
    if first is None:
        raise ValueError(f"Empty {what} file.")
    header = next(csv.reader([first["value"].removeprefix("﻿")], delimiter="\t"), [])
    names = [h.strip().lower() for h in header] if lower else header
    if not set(needed) <= set(names):
        raise ValueError(f"Unexpected {what} header: expected {needed}, found {header}.")
    fields = lines.filter("line_no > 1").select("line_no", quoted_fields(F.col("value")).alias("f"))
    return fields.select("line_no", F.size("f").alias("width"), *[F.try_element_at("f", F.lit(names.index(n) + 1)).alias(n) for n in needed]), len(header), names


def read_truth(spark: SparkSession, source: str | Path | Iterable[str]) -> DataFrame:
    """(source1_entity_id, matched): the whole set of matches of each covered entity, an empty array where it has none."""
    rows, width, _ = _table(spark, source, ["source1_entity_id", "matched_entity_ids"], False, "ground-truth")
    rows = rows.withColumn("source1_entity_id", strip(F.col("source1_entity_id")))
    line, s1 = F.concat(F.lit("Ground-truth line "), F.col("line_no"), F.lit(": ")), F.col("source1_entity_id")
    rules = {
        "width": unless(F.col("width") == width, F.concat(line, F.lit(f"expected {width} columns, got "), F.col("width"))),
        "source1_id": unless((F.col("width") != width) | (s1.startswith("S1-") & ~is_blank(F.substring(s1, 4, 1 << 30))), F.concat(line, F.lit("invalid S1 ID "), s1)),
        "matches": unless(~unparsed(F.coalesce("matched_entity_ids", F.lit(""))), F.concat(line, F.lit("Unrecognized characters in matched_entity_ids: "), F.col("matched_entity_ids"))),
    }
    again = later_occurrences(rows, ["source1_entity_id"], ["line_no"]).select("line_no", F.lit(9).alias("rank"), F.lit("duplicate").alias("rule"), F.concat(F.lit("Duplicate Source 1 row in ground truth: "), s1).alias("message"))
    enforce(violations(rows, rules, ["line_no"]).unionByName(again), ["line_no"])
    return rows.select("source1_entity_id", F.array_distinct(matches(F.col("matched_entity_ids"))).alias("matched"))


def truth_edges(truth: DataFrame) -> DataFrame:
    return truth.select("source1_entity_id", F.explode("matched").alias("candidate_entity_id"))


def truth_frame(spark: SparkSession, truth: Mapping[str, Iterable[str]] | DataFrame) -> DataFrame:
    if isinstance(truth, DataFrame):
        return truth
    return spark.createDataFrame([(k, sorted(v)) for k, v in truth.items()], "source1_entity_id string, matched array<string>")


def read_split(spark: SparkSession, source: Mapping | str | Path | Iterable[str] | DataFrame) -> DataFrame:
    """(source1_entity_id, split) of a saved split: a mapping of two id lists, a .json file of one, or a delimited table."""
    if isinstance(source, DataFrame):
        found = source
    elif isinstance(source, str | Path) and str(source).lower().endswith(".json"):
        whole = "\n".join(r["value"] for r in spark.read.text(str(source), wholetext=True).collect())  # one small file
        data = json.loads(whole)
        if not isinstance(data, Mapping):
            raise TypeError("Expected a JSON object in the split file.")
        return read_split(spark, data)
    elif isinstance(source, Mapping):
        ids = [(i, s) for s in ("train", "validation") for i in source[f"{s}_source1_entity_ids"]]
        if bad := [i for i, _ in ids if not isinstance(i, str) or i != i.strip() or not i.startswith("S1-") or not i[3:].strip()]:
            raise ValueError(f"Invalid S1 ID in the saved split: {bad[0]!r}.")
        found = spark.createDataFrame(ids, "source1_entity_id string, split string")
    else:
        rows, width, _ = _table(spark, source, ["source1_entity_id", "split"], True, "split")
        rows = rows.select("line_no", "width", strip(F.col("source1_entity_id")).alias("source1_entity_id"), F.lower(strip(F.col("split"))).alias("split"))
        line = F.concat(F.lit("Split line "), F.col("line_no"), F.lit(": "))
        rules = {
            "width": unless(F.col("width") == width, F.concat(line, F.lit(f"expected {width} columns, got "), F.col("width"))),
            "split": unless((F.col("width") != width) | F.col("split").isin("train", "validation"), F.concat(line, F.lit("invalid split value "), F.col("split"))),
        }
        enforce(violations(rows, rules, ["line_no"]), ["line_no"])
        found = rows.select("source1_entity_id", "split")
    sides = found.groupBy("source1_entity_id").agg(F.count_distinct("split").alias("k"), F.count(F.lit(1)).alias("n"))
    if (bad := sides.filter("k > 1 OR n > 1").orderBy("source1_entity_id").first()) is not None:
        raise ValueError(f"{bad['source1_entity_id']} stands twice in the saved split.")
    return found

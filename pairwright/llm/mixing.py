"""Mixing sources to target weights by systematic sampling. Native: DataFrame functions only.

Every source gets a target number of words. Each of its documents is expected target / source size times; the
expected copies are prefix-summed within the source, one random offset is added, and a document is emitted once for
each integer boundary that its interval crosses. Documents are ordered by size within blocks, so that the words taken
stay within about one document of the target for each block.

No window holds all sources: they are ranked by range, and the level at which targets stop is found by rounds of one
aggregation each, which end when no further source stops. Prefix sums are kept modulo one copy, so they can't overflow.

Defined results: null text has size 0; null source is a source of its own, weighed last; documents without words are
expected as often as others of their source and take 0 words; a source without words gets target 0 and no copies;
repeated rows and repeated ids are documents of their own; an empty table gives an empty result; further columns pass
through `mix`, whatever their names (those that start with an underscore are reserved). `mix` tells rows apart by id
and a digest of all their columns; of rows that are equal throughout, one is emitted as often as all of them are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .util import WORD, few, join_same, materialize, running_total, table, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Expected copies are counted in units of 2 ** -28, so that prefix sums are whole numbers and reruns agree.
UNIT = 1 << 28


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, docs, source_size, target, _rate): one row per source.

    Sources by code point, null last, weigh `weights` in turn and share `share` times all sizes. A target stops at
    `most` times its source's size; what is above goes to the others by weight, until none is above.
    """
    parts = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("source").asc_nulls_last()
    sums = sized.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    ranged = materialize(sums.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id()), "mix-sources")
    starts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row a partition
    starts = starts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first"))
    rank = F.col("_first") + F.row_number().over(Window.partitionBy("_part").orderBy(order))
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("_k") - 1) % len(weights) + 1).cast("int")).cast("long")
    ranked = ranged.join(F.broadcast(starts), "_part").withColumn("_k", rank).withColumn("_w", cycle).withColumn("_cap", F.col("source_size") * most)  # a row a partition
    ranked = materialize(ranked.select("source", "docs", "source_size", "_w", "_cap"), "mix-ranked")
    level, stopped = 0.0, -1
    while True:
        stops = F.col("_cap") / F.col("_w") <= level if stopped >= 0 else F.lit(False)
        now = ranked.agg(F.sum("source_size").alias("all"), F.count_if(stops).alias("n"), F.sum(F.when(stops, F.col("_cap")).otherwise(0)).alias("cap"), F.sum(F.when(stops, 0).otherwise(F.col("_w"))).alias("w")).first()
        if now["n"] == stopped or not now["w"]:  # none stops any more, or there is no other left
            break
        stopped, level = now["n"], (float(now["all"]) * share - float(now["cap"])) / float(now["w"])
    stops = F.col("_cap") / F.col("_w") <= level
    target = F.when(stops, F.col("_cap").cast("double")).otherwise(F.col("_w") * level)
    rate = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size") * UNIT)).otherwise(F.lit(0))
    return ranked.select("source", "docs", "source_size", target.alias("target"), rate.cast("long").alias("_rate"))


def systematic_copies(weighed: DataFrame, seed: str = "mix", ties: tuple[str, ...] = ()) -> DataFrame:
    """Add `copies` to rows with source, doc_id, size and _rate (expected copies in UNITs)."""
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce("source", F.lit("")))), 1, 7), 16, 10).cast("long")
    placed = running_total(weighed, ["source"], "doc_id", [F.col("size"), F.col("doc_id"), *map(F.col, ties)], F.col("_rate"), "_start", wrap=UNIT)
    low, high = F.shiftright(F.col("_start") + offset, 28), F.shiftright(F.col("_start") + F.col("_rate") + offset, 28)
    return placed.withColumn("copies", (high - low).cast("long")).drop("_start")


def weigh(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = "mix", ties: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies): one row per document, without its text; `ties` are kept too."""
    sized = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *ties), "mix-sizes")
    targets = few(source_targets(sized, weights, share, most), "mix-targets")
    rated = join_same(sized, targets, ["source"]).select("doc_id", "source", "size", "source_size", "target", "_rate", *ties)
    return systematic_copies(rated, seed, ties).drop("_rate")


def row_digest(docs: DataFrame) -> Column:
    """A 64-bit digest of all columns of a row."""
    plain = [F.to_json(F.struct(n)) if kind.startswith(("map", "variant", "struct", "array")) else F.col(n) for n, kind in docs.dtypes]
    return F.xxhash64(*plain)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = "mix") -> DataFrame:
    """The mixed corpus: every document as often as it is taken, with the columns of `docs`.

    Texts stay where they are read, unless more than a broadcast's bound of rows is taken; then they move once.
    """
    marked = docs.withColumn("_digest", row_digest(docs))
    counts = weigh(marked, weights, share, most, seed, ("_digest",)).groupBy("doc_id", "_digest").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    taken = few(counts.filter("_copies > 0"), "mix-taken")
    joined = join_same(marked, taken, ["doc_id", "_digest"])
    if not taken.filter("_rows > 1").isEmpty():
        joined = joined.filter("_rows = 1").unionByName(joined.filter("_rows > 1").dropDuplicates(["doc_id", "_digest"]))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*docs.columns)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weigh(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


#: The same rows in DuckDB.
OP7_SQL = f"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
sums AS (SELECT source, count(*) AS docs, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS k FROM sums),
weighed AS (SELECT *, [5, 2, 1][((k - 1) % 3 + 1)::INT] AS w, source_size * 2 AS cap FROM ranked),
levels AS (SELECT *,
    ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(w) OVER (ORDER BY cap / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lvl FROM weighed),
stops AS (SELECT *, cap / w <= lvl AS stops FROM levels),
targets AS (SELECT source, docs, source_size,
    CASE WHEN stops THEN cap::DOUBLE ELSE w::DOUBLE * (min({{'r': cap / w, 'k': k, 'lvl': lvl}}) FILTER (NOT stops) OVER ()).lvl END AS target FROM stops),
rated AS (SELECT s.*, t.docs, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size::DOUBLE * 268435456)::BIGINT ELSE 0 END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(s.source, '')), 1, 7))::BIGINT AS off,
    floor(('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '')), 1, 4))::BIGINT * least(65536, ceil(t.docs / 2000)) / 65536)::BIGINT AS block
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
placed AS (SELECT *, coalesce(sum(rate) OVER (PARTITION BY source ORDER BY block, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + off AS start FROM rated),
counted AS (SELECT *, ((start + rate) >> 28) - (start >> 28) AS copies FROM placed)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::BIGINT AS copies FROM counted
"""

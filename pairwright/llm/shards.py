"""Sharding by k-d tree partitioning: split at distributed weighted medians along the widest metadata dimension.

A node is split until its leaves reach the target bytes: it stands for as many leaves as its share of the table asks
for, and its rows go to two parts in the ratio of their leaves (equal bytes where these are even), along the dimension
whose values spread widest in it relative to the whole table. Dimensions are any whole-number columns; by default the
length of a text, its bytes a character and its share of white space. Where one isn't a function of the text (a source,
a date), equal texts that differ in it may part. A split point is a place in the order of
(dimension, group, row id): it is found by repeated histograms of BUCKETS buckets, one narrow aggregation for all nodes
of a level at a time, so one row per node and pass reaches the driver, which holds the tree, one row per leaf. Every
NEXT_LEVELS levels the rows are written with the node that they have reached, so no pass descends the whole tree.

Rows with equal text form a group. A split point that falls into a group goes to its nearer end, unless the group is
larger than the largest row and than `keep_whole` of a leaf (a parameter); such a group is split by row id, so that a
group holding a third of all bytes still gives near equal shards.

Defined results: null text weighs 1 byte and is a group with the empty text; null dimensions count as 0; repeated rows
with one id that fall into a group to be split stay together; an empty table gives an empty result; fewer groups than
shards leave shards empty; further columns pass through, whatever their names: where `docs` has a column shard (or
slot), the result's own gets an underscore at its end. Names that start with an underscore are reserved.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .util import MOST_BROADCAST, free_name, materialize, running_total, table

BUCKETS = 1024
#: Group and row hashes have 62 bits.
HASH_TOP = (1 << 61) - 1
#: So many levels are descended before rows are written with their nodes.
NEXT_LEVELS = 4
KEEP_WHOLE = 0.02


@dataclass
class Node:
    """Leaves [first, first + leaves) of the tree, or the split of an inner node: rows above `point` go right."""

    first: int
    leaves: int
    weight: int
    dim: int = 0
    point: tuple[int, int, int] | None = None


@dataclass
class Bracket:
    """Where a node's split point lies: keys lo to hi of the next axis, all earlier axes being `at`, and the bytes to go left."""

    node: Node
    lo: int
    hi: int
    goal: float
    at: list[int] = field(default_factory=list)


def dimensions(text: Column) -> dict[str, Column]:
    """Metadata of a text as whole numbers: its length, the bytes a character takes, the share of white space."""
    chars = F.coalesce(F.length(text), F.lit(0))
    return {
        "length": F.floor(F.log1p(chars.cast("double")) * 4096),
        "bytes_per_char": F.coalesce(F.floor(F.octet_length(text) * 4096 / F.nullif(chars, F.lit(0))), F.lit(0)),
        "spaces": F.coalesce(F.floor(F.regexp_count(text, F.lit(r"\s")) * 4096 / F.nullif(chars, F.lit(0))), F.lit(0)),
    }


def leaves_for(total: int, target_bytes: int) -> int:
    """Leaves that a table of so many bytes needs."""
    if target_bytes < 1:
        raise ValueError("target_bytes must be positive")
    return max(1, -(-total // target_bytes))


def plan(rows: DataFrame, dims: list[str], leaves: int | None = None, target_bytes: int | None = None, keep_whole: float = KEEP_WHOLE) -> list[list[Node]]:
    """The tree by level for rows with the dimensions, _group, _id (whole numbers) and size."""
    if leaves is not None and leaves < 1:
        raise ValueError("leaves must be positive")
    whole = rows.agg(F.sum("size").alias("w"), F.max("size").alias("most"), *[F.min(d).alias(f"lo_{d}") for d in dims], *[F.max(d).alias(f"hi_{d}") for d in dims]).first()
    total, largest = whole["w"] or 0, whole["most"] or 0
    leaves = leaves or leaves_for(total, target_bytes)
    span = {d: max(1, (whole[f"hi_{d}"] or 0) - (whole[f"lo_{d}"] or 0)) for d in dims}
    levels, open_nodes = [], [Node(0, leaves, total)]
    base, since = rows.withColumn("_node", F.lit(0)), []
    while any(n.leaves > 1 for n in open_nodes):
        if len(since) == NEXT_LEVELS:
            base, since = materialize(descend(base, since, dims), "shard-nodes"), []
        node_of = descend(base, since, dims)
        edges = {r["_node"]: r for r in node_of.groupBy("_node").agg(F.sum("size").alias("w"), *[F.min(d).alias(f"lo_{d}") for d in dims], *[F.max(d).alias(f"hi_{d}") for d in dims]).collect()}  # at most one row per leaf
        for n in open_nodes:
            if e := edges.get(n.first):
                n.weight = e["w"]
                n.dim = max(range(len(dims)), key=lambda i: ((e[f"hi_{dims[i]}"] - e[f"lo_{dims[i]}"]) / span[dims[i]], -i))
        inner = [n for n in open_nodes if n.leaves > 1 and n.first in edges]
        along = {n.first: (edges[n.first][f"lo_{dims[n.dim]}"], edges[n.first][f"hi_{dims[n.dim]}"]) for n in inner}
        medians(node_of, inner, along, dims, max(largest, total / leaves * keep_whole))
        levels.append(open_nodes)
        since.append(open_nodes)
        open_nodes = [child for n in open_nodes for child in ([n] if n.leaves == 1 else [Node(n.first, n.leaves // 2, 0), Node(n.first + n.leaves // 2, n.leaves - n.leaves // 2, 0)])]
    return levels


def bounded(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of rows of the tree; broadcast up to MOST_BROADCAST of them."""
    made = spark.createDataFrame(rows, schema)
    return F.broadcast(made) if len(rows) <= MOST_BROADCAST else made


def medians(rows: DataFrame, nodes: list[Node], edges: dict[int, tuple[int, int]], dims: list[str], keep: float) -> None:
    """Set the split point of each node: bracket by bracket along its dimension, then group, then row id."""
    spark = rows.sparkSession
    state = {n.first: Bracket(n, *edges[n.first], goal=n.weight * (n.leaves // 2) / n.leaves) for n in nodes}
    on_dim = F.element_at(F.array(*[F.col(d) for d in dims]), F.col("_dim") + 1)
    key = F.when(F.col("_axis") == 0, on_dim).when(F.col("_axis") == 1, F.col("_group")).otherwise(F.col("_id"))
    inside = ((F.col("_axis") < 1) | (on_dim == F.col("_at0"))) & ((F.col("_axis") < 2) | (F.col("_group") == F.col("_at1")))
    while state:
        brackets = [(k, b.node.dim, len(b.at), b.lo, b.hi, (b.hi - b.lo) // BUCKETS + 1, *(b.at + [None, None])[:2], float(b.goal)) for k, b in state.items()]
        now = bounded(spark, brackets, "_node int, _dim int, _axis int, _lo long, _hi long, _width long, _at0 long, _at1 long, _goal double")
        held = rows.join(now, "_node").filter(inside).withColumn("_key", key).filter("_key between _lo and _hi")
        counted = held.groupBy("_node", "_goal", F.expr("(_key - _lo) div _width").alias("_bucket")).agg(F.sum("size").alias("w"), F.min("_key").alias("lo"), F.max("_key").alias("hi"))
        ran = counted.withColumn("upto", F.sum("w").over(Window.partitionBy("_node").orderBy("_bucket")))
        hits = ran.filter("upto >= _goal").groupBy("_node").agg(F.min(F.struct("_bucket", "upto", "w", "lo", "hi")).alias("h")).select("_node", "h.*")
        for h in hits.collect():  # one row a node
            b = state[h["_node"]]
            below = h["upto"] - h["w"]
            if h["lo"] < h["hi"]:
                b.lo, b.hi, b.goal = h["lo"], h["hi"], b.goal - below
            elif len(b.at) == 2 or len(b.at) == 1 and h["w"] <= keep:
                taken = h["upto"] - b.goal <= b.goal - below
                b.node.point = tuple([*b.at, h["lo"] - (not taken), HASH_TOP][:3])
                del state[h["_node"]]
            else:
                b.at, b.lo, b.hi, b.goal = [*b.at, h["lo"]], -HASH_TOP - 1, HASH_TOP, b.goal - below


def descend(rows: DataFrame, levels: list[list[Node]], dims: list[str]) -> DataFrame:
    """Move _node, the first leaf of the node that holds a row, down by the given levels."""
    found = rows
    for nodes in levels:
        if len(nodes) == 1:  # the root: no join
            n, place = nodes[0], (F.element_at(F.array(*[F.col(d) for d in dims]), nodes[0].dim + 1), F.col("_group"), F.col("_id"))
            if n.point is not None:
                point = F.struct(*[F.lit(x).cast("long").alias(a) for x, a in zip(n.point, "abc", strict=True)])
                found = found.withColumn("_node", F.when(F.struct(*[c.alias(a) for c, a in zip(place, "abc", strict=True)]) > point, n.first + n.leaves // 2).otherwise(F.col("_node")))
            continue
        splits = bounded(rows.sparkSession, [(n.first, n.dim, n.first + n.leaves // 2, *(n.point or (0, 0, 0)), n.point is not None) for n in nodes], "_node int, _dim int, _right int, _p0 long, _p1 long, _p2 long, _split boolean")
        key = F.element_at(F.array(*[F.col(d) for d in dims]), F.col("_dim") + 1)
        above = F.struct(key.alias("a"), F.col("_group").alias("b"), F.col("_id").alias("c")) > F.struct(F.col("_p0").alias("a"), F.col("_p1").alias("b"), F.col("_p2").alias("c"))
        found = found.join(splits, "_node").withColumn("_node", F.when(F.col("_split") & above, F.col("_right")).otherwise(F.col("_node"))).select(*rows.columns)
    return found


def assign(docs: DataFrame, shards: int | None = None, dims: dict[str, Column] | None = None, target_bytes: int | None = None, keep_whole: float = KEEP_WHOLE) -> DataFrame:
    """Add shard; `docs` has doc_id and text. Either a number of shards (8 by default) or the bytes of a leaf is given."""
    if shards is not None and target_bytes is not None:
        raise ValueError("give shards or target_bytes")
    shards = 8 if shards is None and target_bytes is None else shards
    dims = dims or dimensions(F.col("text"))
    group = F.shiftright(F.xxhash64(F.coalesce("text", F.lit(""))), 2)
    names = [f"_d_{d}" for d in dims]
    rows = docs.select(*docs.columns, (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("_size"), group.alias("_group"), F.coalesce(F.shiftright(F.xxhash64(F.col("doc_id").cast("string")), 2), F.lit(0)).alias("_id"), *[F.coalesce(c.cast("long"), F.lit(0)).alias(n) for n, c in zip(names, dims.values(), strict=True)])
    narrow = materialize(rows.select(F.col("_size").alias("size"), "_group", "_id", *names), "shard-keys")
    levels = plan(narrow, names, shards, target_bytes, keep_whole)
    placed = descend(rows.withColumn("_node", F.lit(0)), levels, names)
    return placed.select(*docs.columns, F.col("_node").alias(free_name(docs, "shard")))


def number(placed: DataFrame, spread: str = "doc_id") -> DataFrame:
    """Add slot, gapless from 0 within each shard (the last column of `placed`), by many tasks a shard."""
    return running_total(placed, [placed.columns[-1]], spread, [F.col(spread)], F.lit(1), free_name(placed, "slot"))


def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    facts = assign(docs, 8).select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), "shard")
    numbered = number(materialize(facts, "shard-facts"))
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

"""Chat formatting of reply trees. Native: DataFrame functions only.

A reply tree has one row per message: tree, node, parent (null for a root), role, text, score. Self-joins that double
their reach take every message to its root and sum up scores and depth on the way, in rows of constant size; a tree of
depth d takes log2(d) of them. Every leaf is a root-to-leaf path; paths are ranked by the mean score of their messages,
then depth, then leaf. The same jumps, taken from the leaves of the chosen paths, list their messages: each round
doubles what is listed, so no more rows are made than the paths have messages. Each chosen path becomes one formatted
conversation with the spans of its loss mask.

The template writes a message as `<|turn|>role\\ntext<|end|>\\n`. Control strings inside a text, ours and the common
ones of other templates, get one backslash after their first sign; those that have backslashes there get one more, so
unescaping restores every text. In roles %, line feeds and < are written as %25, %0A and %3C.

Defined results: null text and null role are empty; messages of one conversation that share a turn number follow in
order of role and text, null turns first; repeated rows are messages of their own; a message whose parent is missing
starts a path of its own; a tree's messages on a cycle reach no root and form no path; messages that share tree and
node are one place of the tree, with the least of their parents and the largest of their scores, and follow each other
there in order of role and text; a null score counts as 0; an empty table gives an empty result; further columns of
the input are left out. One conversation is one row of the result, so it must fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .util import materialize, table

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
#: The first sign and the rest of each control string.
CONTROL = r"(\||/?s>|<SYS>>|</SYS>>|/?INST\])"
ESCAPE, ESCAPED = rf"([<\[])(\\*){CONTROL}", rf"([<\[])\\(\\*){CONTROL}"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    for a, b in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(a), F.lit(b))
    return role


def unescape_role(role: Column) -> Column:
    for a, b in (("%3C", "<"), ("%0A", "\n"), ("%25", "%")):
        role = F.replace(role, F.lit(a), F.lit(b))
    return role


def jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables (tree, node, up) of the ancestors 1, 2, 4, ... messages above, and (tree, node, total, depth) of every
    message that reaches a root: the sum of scores and the number of messages from there down to it.

    `nodes` has tree, node, parent, score, a row for each place.
    """
    there = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("_there"))
    state = nodes.join(there, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("_there"), F.col("parent")).alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("depth"))
    state = materialize(state, "chat-jumps")
    tables, before = [], None
    while (left := state.filter("up IS NOT NULL").count()) and left != before:  # each round ends some, unless only cycles are left
        tables.append(state.filter("up IS NOT NULL").select("tree", "node", "up"))
        above = state.select("tree", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("total").alias("_total"), F.col("depth").alias("_depth"))
        going = state.filter("up IS NOT NULL").join(above, ["tree", "up"])
        going = going.select("tree", "node", F.col("_up").alias("up"), (F.col("total") + F.col("_total")).alias("total"), (F.col("depth") + F.col("_depth")).alias("depth"))
        state, before = materialize(state.filter("up IS NULL").unionByName(going), "chat-jumps"), left
    return tables, state.filter("up IS NULL").drop("up")


def rank_branches(nodes: DataFrame, reached: DataFrame, best: int | None = None) -> DataFrame:
    """(tree, leaf, rank, depth): the paths of each tree, or the `best` of them, ranked by mean score, then depth and leaf."""
    parents = nodes.select("tree", F.col("parent").alias("node")).filter("node IS NOT NULL").distinct()
    leaves = reached.join(parents, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), (F.col("total") / F.col("depth")).alias("_mean"), "depth")
    if best == 1:  # one aggregation, with partial sums of a tree of any width
        top = leaves.groupBy("tree").agg(F.min(F.struct((-F.col("_mean")).alias("m"), (-F.col("depth")).alias("d"), "leaf")).alias("t"))
        return top.select("tree", "t.leaf", F.lit(1).alias("rank"), (-F.col("t.d")).alias("depth"))
    order = Window.partitionBy("tree").orderBy(F.desc("_mean"), F.desc("depth"), "leaf")
    ranked = leaves.select("tree", "leaf", F.row_number().over(order).alias("rank"), "depth")
    return ranked if best is None else ranked.filter(F.col("rank") <= best)


def list_paths(chosen: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """(tree, leaf, pos, node): the messages of each chosen path (tree, leaf, depth), pos from 0 at the root."""
    found = materialize(chosen.select("tree", "leaf", F.col("leaf").alias("node"), (F.col("depth") - 1).alias("pos")), "chat-paths")
    for k, table_ in enumerate(tables):
        above = found.join(table_, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("pos") - (1 << k)).alias("pos"))
        found = found.unionByName(materialize(above, "chat-paths"))
    return found


def root_paths(nodes: DataFrame, best: int | None = None) -> DataFrame:
    """(tree, leaf, path): the nodes of every path, or of the `best` of each tree, from its root down to its leaf."""
    scored = nodes if "score" in nodes.columns else nodes.withColumn("score", F.lit(0.0))
    places = scored.groupBy("tree", "node").agg(F.min("parent").alias("parent"), F.coalesce(F.max("score"), F.lit(0.0)).alias("score"))
    places = materialize(places, "chat-places")
    tables, reached = jumps(places)
    listed = list_paths(rank_branches(places, reached, best), tables)
    return listed.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(F.struct("pos", "node"))).alias("p")).select("tree", "leaf", F.col("p.node").alias("path"))


def format_paths(steps: DataFrame, learn: str = "assistant") -> DataFrame:
    """(tree, leaf, formatted, loss_spans): one row per path.

    loss_spans holds (start, length) in code points of the escaped text of each message whose role is `learn`.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = steps.select("tree", "leaf", "pos", role.alias("role"), text.alias("text"), F.concat(F.lit(OPEN), escape_role(role), F.lit("\n")).alias("head"), escape(text).alias("body"))
    before = Window.partitionBy("tree", "leaf").orderBy("pos", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(CLOSE)
    turn = turn.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)))
    span = F.when(F.col("role") == learn, F.struct((F.col("at") + F.length("head")).cast("int").alias("start"), F.length("body").alias("length")))
    packed = turn.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(F.struct("at", F.concat("head", "body", F.lit(CLOSE)).alias("whole"), span.alias("span")))).alias("m"))
    spans = F.filter(F.transform("m", lambda t: t["span"]), lambda s: s.isNotNull())
    return packed.select("tree", "leaf", F.array_join(F.transform("m", lambda t: t["whole"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Add turns, an array of (role, text), and loss, the unescaped text under the loss mask, from the formatted string and its spans."""
    parts = F.filter(F.split(F.col("formatted"), r"<\|turn\|>", -1), lambda p: p != "")
    turns = F.transform(parts, lambda p: F.struct(unescape_role(F.substring_index(p, "\n", 1)).alias("role"), unescape(F.substr(p, F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p) - F.length(F.substring_index(p, "\n", 1)) - 1 - len(CLOSE))).alias("text")))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    return formatted.withColumn("turns", turns).withColumn("loss", loss)


def as_trees(conversations: DataFrame) -> DataFrame:
    """Turns of conversations as reply trees: each message answers the one before it."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    node = F.row_number().over(order).cast("long")
    numbered = conversations.select("conv_id", "role", "text", node.alias("node"))
    return numbered.select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def format_trees(messages: DataFrame, best: int | None = None) -> DataFrame:
    """(tree, leaf, formatted, loss_spans) of reply trees: every path, or the `best` of each tree."""
    messages = messages.withColumn("tree", F.coalesce(F.col("tree").cast("string"), F.lit("\0")))
    messages = materialize(messages.select("tree", "node", "parent", "role", "text", "score"), "chat-messages")
    places = messages.groupBy("tree", "node").agg(F.min("parent").alias("parent"), F.coalesce(F.max("score"), F.lit(0.0)).alias("score"))
    places = materialize(places, "chat-places")
    tables, reached = jumps(places)
    listed = list_paths(rank_branches(places, reached, best), tables)
    return format_paths(listed.join(messages.select("tree", "node", "role", "text"), ["tree", "node"]))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(fixed)
    read = read_back(format_trees(as_trees(rows), best=1))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.when(F.col("tree") != "\0", F.col("tree")).cast("long").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: The same rows in DuckDB, straight from the turns.
OP1_SQL = rf"""
WITH rows AS (SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role, text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
plain AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows),
sizes AS (SELECT *, length(regexp_replace(text, '{ESCAPE}', '\1\\\2\3', 'g')) AS body, length(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C')) AS head FROM plain)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(body + head + {len(OPEN) + 1 + len(CLOSE)})::BIGINT AS formatted_chars
FROM sizes GROUP BY conv_id
"""

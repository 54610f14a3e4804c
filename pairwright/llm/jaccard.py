"""N-gram Jaccard join: a grouped prefix join over word shingles, exact for every pair of different texts.

1. Words are counted by document with lossy counting, and the most frequent ones, at most FREQUENT_WORDS of them, make
   a broadcast table of logarithmic frequencies. It fixes one order of all shingles: those whose rarest word is rarest
   come first. Any order is right; this one keeps common passages and phrases out of prefixes.
2. Each document gives its set's size, a digest of the set and its prefix: of n shingles the first n - ceil(0.9 n) + 1.
   Documents with equal digests are one class, named by the digest and not by an id, so that rows that share an id keep
   their own links; documents with identical prefixes and size collapse into one group.
3. Shingles that only one group has in its prefix go. Within the list of each other shingle group pairs are filtered: by size, by the places of the shingle in both prefixes, which bound the overlap,
   and by parity sketches of SKETCH bits. What a task emits is one edge a row at most, to the smallest group that its
   row may be linked with; no list is paired out.
4. Groups are expanded to their classes and each component is filtered by parity bitmaps of about one bit a shingle:
   where more bits differ than two linked sets can differ in, there is no link. What passes forms smaller components.
5. Sets are computed again for the classes that are left, once each, and verified exactly. What leaves a task is one
   edge and one link count a class at most.
6. Components of the verified links are found by large-star and small-star rounds and named by their smallest id.

Steps 3 to 5 deal a key (shingle, component) with more than BLOCK rows over blocks by size and hash: sizes are cut
where a ratio of the threshold is passed, so links are within a band or between neighbours, and only those pairs of
blocks make tasks. In steps 4 and 5 a block also has about BLOCK_SHINGLES shingles at most, so that what a task holds
doesn't grow with the length of texts. Counts come from aggregations alone; no window or task sees a whole key.

Sets are of 64-bit digests of shingles; n_shingles and links are exact up to collisions of those.

Defined results: null and empty texts and texts without words have n_shingles 0, no links and are their own component;
shorter texts than a shingle have one, the whole sequence; equal texts are linked; rows that share a doc_id are linked
as their texts are and each row is returned; rows without doc_id keep their n_shingles, take part in no link and have
no component; an empty table gives an empty result; further columns of the input are left out of `link`. `keep_first`
passes all columns and leaves rows without doc_id or without words as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import util
from .util import forget, lean_batches, materialize, table

WORDS, PERCENT = 3, 90
FREQUENT_WORDS = 1 << 20
#: A word counts as frequent from this many documents on; lossy counting forgets words seen once in so many entries.
LEAST_DF, COUNTED_WORDS = 8, 250_000
BLOCK = 1024
#: Where tasks hold whole sets or bitmaps, a block has so many shingles, whatever the lengths of its texts.
BLOCK_SHINGLES = 1 << 21
#: Bits of the sketch that filters group pairs.
SKETCH = 256
#: Lists of up to so many members are compared without arrays; results leave a worker so many rows at a time.
SHORT, SENT_ROWS = 24, 8192
#: From this level of its rarest word on (log2 of documents) a shingle's list may be too long for one task.
HOT_LEVEL = 17
#: So many narrow rows are broadcast at most; more are joined by a shuffle.
MOST_BROADCAST = util.MOST_BROADCAST
CACHED_WORDS = 150_000


def few(df: DataFrame, label: str) -> DataFrame:
    return util.few(df, label, MOST_BROADCAST)


class WordHashes(dict):
    """64-bit hashes of words; a worker's memory of them is bounded."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHED_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = WordHashes()


def words_of(text: str | None) -> list[bytes]:
    """Words of the text with A-Z in lower case: bytes.split() cuts at exactly the six ASCII white space characters."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def shingle_set(words: list[bytes], k: int = WORDS, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle digests, and for each the position of its first word; texts of fewer words have one."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = hashes_of(words) if hashes is None else hashes
    n = len(words) - k + 1
    if n < 1:
        h, n, width = np.append(h, np.uint64(len(words))), 1, len(words) + 1
    else:
        width = k
    s = np.full(n, width, np.uint64)
    for i in range(width):
        s = _mix(s * np.uint64(0xD6E8FEB86659FD93) + h[i : i + n])
    return np.unique(s, return_index=True)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def frequent_words(docs: DataFrame, most: int = FREQUENT_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and log2 document counts of the most frequent words, at most `most` of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for b in batches:
            for text in b.column(0):
                for w in set(words_of(text.as_py())):
                    counts[w] = counts.get(w, 0) + 1
                if len(counts) > COUNTED_WORDS:
                    counts = {w: n for w, n in counts.items() if n > 1}
                    if len(counts) > COUNTED_WORDS // 2:
                        yield batch(counts)
                        counts = {}
        yield batch({w: n for w, n in counts.items() if n > 1})

    def batch(counts: dict[bytes, int]) -> pa.RecordBatch:
        h = np.fromiter((_hashes[w] for w in counts), np.uint64, len(counts)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.fromiter(counts.values(), np.int64, len(counts)))], names=["word", "n"])

    counted = materialize(docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_DF), "jaccard-words")
    levels = {r["level"]: r["k"] for r in counted.groupBy(F.floor(F.log2(F.col("n"))).cast("int").alias("level")).agg(F.count(F.lit(1)).alias("k")).collect()}  # 64 rows at most
    kept, least = 0, 64
    for level in sorted(levels, reverse=True):  # whole levels, as many as the table holds
        if kept + levels[level] > most:
            break
        kept, least = kept + levels[level], level
    rows = counted.filter(F.floor(F.log2(F.col("n"))) >= least).select("word", F.floor(F.log2(F.col("n"))).cast("int").alias("level")).toArrow()  # at most `most` rows
    forget(counted)
    words = rows["word"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(words)
    return words[order], rows["level"].to_numpy().astype(np.uint8)[order]


def _levels(h: np.ndarray, table_: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The log2 document count of each word, 0 for rare ones."""
    hashes, levels = table_
    if not len(hashes):
        return np.zeros(len(h), np.uint8)
    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    return np.where(hashes[at] == h, levels[at], 0).astype(np.uint8)


def parity_bitmap(s: np.ndarray) -> bytes:
    """One bit for each residue of the digests, set where an odd number of them has it; 64 bits or a power of two from n on."""
    bits = max(64, 1 << (len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def sketch_of(s: np.ndarray) -> bytes:
    """Parity bitmap of SKETCH bits, whatever the size of the set."""
    return np.packbits(np.bincount((s & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH).astype(np.uint8) & 1, bitorder="little").tobytes()


def prefix_of(words: list[bytes], table_: tuple[np.ndarray, np.ndarray], percent: int = PERCENT, k: int = WORDS) -> tuple[int, int, np.ndarray, bytes, bytes, int]:
    """Size of the set, its digest, the prefix's shingles in the one order of all shingles, the set's bitmap and sketch, and how many of the prefix stand before HOT_LEVEL."""
    h = hashes_of(words)
    s, first = shingle_set(words, k, h)
    n = len(s)
    if not n:
        return 0, 0, s, b"", b"", 0
    level = _levels(h, table_)
    rank = level[: len(words) - k + 1] if len(words) >= k else level[:1]
    for i in range(1, k if len(words) >= k else 1):
        rank = np.minimum(rank, level[i : i + len(rank)])
    rank = rank[first]
    order = np.argsort(rank, kind="stable")[: prefix_length(n, percent)]  # by rank, then digest
    return n, digest_of(s), s[order], parity_bitmap(s), sketch_of(s), int((rank[order] < HOT_LEVEL).sum())


def digest_of(s: np.ndarray) -> int:
    """The name of a class: a signed 64-bit digest of the set."""
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s))).view(np.int64))


def signatures(docs: DataFrame, percent: int = PERCENT, k: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, n, class, group, prefix, bitmap, sketch, cold) of every document; n 0 where it has no words."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent_words(docs))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            found = [prefix_of(words_of(t.as_py()), sent.value, percent, k) for t in b.column(2)]
            groups = np.array([xxhash.xxh3_64_intdigest(f[2].tobytes(), seed=f[0]) for f in found], np.uint64).view(np.int64)
            prefixes = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(f[2]) for f in found]), pa.int32()), pa.array(np.concatenate([f[2] for f in found] or [np.zeros(0, np.uint64)]).view(np.int64)))
            columns = [b.column(0), b.column(1), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array(groups), prefixes, pa.array([f[3] for f in found], pa.binary()), pa.array([f[4] for f in found], pa.binary()), pa.array([f[5] for f in found], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n", "class", "group", "prefix", "bitmap", "sketch", "cold"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(sign, "doc_id long, text_hash long, n long, class long, group long, prefix array<long>, bitmap binary, sketch binary, cold int")


def star_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node it is connected with.

    Large-star and small-star rounds until the edges stay the same; each round is written to shared storage.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    state = None
    for _ in range(rounds):
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(low, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = materialize(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = large.join(least, F.col("a") == F.col("u")).select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).filter("a <> b")
        small = materialize(small.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
        forget(now)
        forget(large)
        now = small
        then, state = state, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == then:
            break
    else:
        raise RuntimeError(f"components aren't found after {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def band(n: Column, percent: int = PERCENT) -> Column:
    """Bands of sizes: the sizes of two linked sets lie in one band or in neighbouring ones."""
    if percent >= 100:
        return n.cast("long") * 2  # only equal sizes are linked
    return F.floor(F.log(n.cast("double")) / F.lit(log(100 / percent) * (1 + 1e-9))).cast("long")


def with_tasks(rows: DataFrame, key: str, name: str, percent: int = PERCENT, shingles: int | None = None) -> DataFrame:
    """Add tasks: the pairs of blocks (i, j) of its key where each row is compared, and on which side of them.

    Keys with up to BLOCK rows, and up to `shingles` shingles where it is given, are one block (0, 0). A larger one is
    cut by band and hash of `name`: any two rows whose sizes allow a link meet in exactly one task. `rows` should be a
    materialized table: it is read three times.
    """
    k = F.count(F.lit(1))
    load = F.ceil(k / BLOCK) if shingles is None else F.least(k, F.greatest(F.ceil(k / BLOCK), F.ceil(F.sum("n") / shingles)))
    hot = few(rows.groupBy(key).agg(load.alias("_m")).filter("_m > 1").select(key), "hot-keys")
    banded = rows.join(hot, key, "left_semi").groupBy(key, band(F.col("n"), percent).alias("_band")).agg(load.cast("long").alias("_m"))
    near = Window.partitionBy(key).orderBy("_band")  # a row a band: some hundred at most
    at = lambda f, by: F.when(f("_band").over(near) == F.col("_band") + by, f("_m").over(near))
    blocks = few(banded.select(F.col(key).alias("_key"), "_band", "_m", at(F.lag, -1).alias("_before"), at(F.lead, 1).alias("_after")), "hot-blocks")
    dealt = rows.join(blocks, (F.col(key) == F.col("_key")) & (band(F.col("n"), percent) == F.col("_band")), "left")
    block = lambda q, t: q * F.lit(1 << 24) + t
    q, own = F.col("_band") + 1, F.pmod(F.xxhash64(name), F.col("_m"))
    task = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    upto = lambda m: F.when(F.coalesce(m, F.lit(0)) > 0, F.sequence(F.lit(0).cast("long"), m - 1)).otherwise(F.array().cast("array<long>"))
    inside = F.transform(upto(F.col("_m")), lambda t: task(block(q, F.least(t, own)), block(q, F.greatest(t, own)), t < own))
    above = F.transform(upto(F.col("_after")), lambda t: task(block(q, own), block(q + 1, t), F.lit(False)))
    below = F.transform(upto(F.col("_before")), lambda t: task(block(q - 1, t), block(q, own), F.lit(True)))
    alone = F.array(task(F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(False)))
    return dealt.select(*rows.columns, F.when(F.col("_m").isNull(), alone).otherwise(F.concat(inside, above, below)).alias("tasks"))


def near_groups(left: list[tuple], right: list[tuple] | None, percent: int) -> dict[int, int]:
    """The smallest group that each one may be connected with, for members (group, n, place, sketch) of one shingle's list.

    A group of several sets has no sketch (null), and is told apart by size and place alone.
    """
    if len(left) + len(right or []) <= SHORT:
        return near_few(left, right, percent)
    members = left + (right or [])
    m, cut = len(members), len(left)
    n, place = np.array([x[1] for x in members], np.int64), np.array([x[2] for x in members], np.int64)
    loose, ids = np.array([x[3] is None for x in members]), np.array([x[0] for x in members], np.int64)
    sketch = np.frombuffer(b"".join(x[3] or bytes(SKETCH // 8) for x in members), np.uint64).reshape(m, -1)
    rest, label, hit_any = n - place, np.arange(m), np.zeros(m, bool)
    for x in range(m - 1 if right is None else cut):
        others = np.arange(x + 1, m) if right is None else np.arange(cut, m)
        both = n[x] + n[others]
        fits = ((100 + percent) * np.minimum(rest[x], rest[others]) >= percent * both) & (100 * np.minimum(n[x], n[others]) >= percent * np.maximum(n[x], n[others]))
        others = others[fits]
        differ = np.bitwise_count(sketch[others] ^ sketch[x]).sum(axis=1, dtype=np.int64)
        hits = others[((100 + percent) * differ <= (100 - percent) * (n[x] + n[others])) | loose[x] | loose[others]]
        if len(hits):
            hit_any[x] = hit_any[hits] = True
            labels = np.unique(np.append(label[hits], label[x]))
            if len(labels) > 1:
                label[np.isin(label, labels[1:])] = labels[0]
    low = np.full(m, np.iinfo(np.int64).max)
    np.minimum.at(low, label, ids)
    return {int(ids[x]): int(low[label[x]]) for x in np.flatnonzero(hit_any)}


def near_few(left: list[tuple], right: list[tuple] | None, percent: int) -> dict[int, int]:
    """`near_groups` of a short list, which most are."""
    members, cut = left + (right or []), len(left)
    m = len(members)
    sketch = [None if x[3] is None else int.from_bytes(x[3]) for x in members]
    label: list[int | None] = [None] * m  # of the members with a hit
    for x in range(m - 1 if right is None else cut):
        _, n, place, _ = members[x]
        for y in range(x + 1 if right is None else cut, m):
            _, n2, place2, _ = members[y]
            if (100 + percent) * min(n - place, n2 - place2) >= percent * (n + n2) and 100 * min(n, n2) >= percent * max(n, n2):
                if sketch[x] is None or sketch[y] is None or (100 + percent) * (sketch[x] ^ sketch[y]).bit_count() <= (100 - percent) * (n + n2):
                    a, b = (z if label[z] is None else label[z] for z in (x, y))
                    label[x], label[y] = (a if label[x] is None else label[x]), (b if label[y] is None else label[y])
                    if a != b:
                        label = [min(a, b) if v == max(a, b) else v for v in label]
    low: dict[int, int] = {}
    for x, v in enumerate(label):
        if v is not None:
            low[v] = min(low.get(v, members[x][0]), members[x][0])
    return {members[x][0]: low[v] for x, v in enumerate(label) if v is not None}


def candidate_groups(groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows (shingle, group, n, place, sketch) of the shared prefix shingles, written once; groups: group, n, prefix, sketch, cold.

    A list is of use if it has two rows, one of them where a link's smaller set has its first common shingle. Lists of
    rare shingles are looked at as windows, in one shuffle; those that may be long are counted on the map side first.
    """
    first = (100 + percent) * (F.col("n") - F.col("place")) >= 2 * percent * F.col("n")
    rows = groups.select("group", "n", "cold", F.posexplode("prefix").alias("place", "shingle")).select("shingle", "group", "place", first.alias("first"), (F.col("place") < F.col("cold")).alias("cold"))
    own = Window.partitionBy("shingle")
    rare = rows.filter("cold").drop("cold").withColumn("k", F.count(F.lit(1)).over(own)).withColumn("f", F.max("first").over(own)).filter("k > 1 AND f").select("shingle", "group", "place")
    hot = rows.filter("NOT cold")
    shared = few(hot.groupBy("shingle").agg(F.count(F.lit(1)).alias("k"), F.max("first").alias("f")).filter("k > 1 AND f").select("shingle"), "jaccard-shared")
    kept = rare.unionByName(hot.join(shared, "shingle", "left_semi").select("shingle", "group", "place"))
    return materialize(kept.join(groups.select("group", "n", "sketch"), "group").select("shingle", "group", "n", "place", "sketch"), "jaccard-lists")


def possible_edges(listed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) between groups that may be linked."""
    dealt = with_tasks(listed, "shingle", "group", percent).withColumnRenamed("group", "class")

    def task(left: list, right: list | None) -> list:
        return sorted(near_groups(left, right, percent).items())

    return by_block(dealt, "shingle", ["class", "n", "place", "sketch"], task, ["a", "b"], "a long, b long")


def verify_block(left: list[tuple[int, int, np.ndarray]], right: list[tuple[int, int, np.ndarray]] | None, percent: int) -> tuple[dict[int, int], dict[int, int]]:
    """Exact links among `left`, or between `left` and `right`: (class, smallest class it is linked with here), (class, documents it is linked with).

    Members are (class, documents of the class, sorted set). Overlaps are counted through the lists of shingles that
    more than one member has.
    """
    members = left + (right or [])
    m, cut = len(members), len(left)
    sizes = np.array([len(x[2]) for x in members])
    ids = np.repeat(np.arange(m), sizes)
    tokens = np.concatenate([x[2] for x in members])
    order = np.argsort(tokens, kind="stable")
    ids, tokens = ids[order], tokens[order]
    starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    ends = np.append(starts[1:], len(tokens))
    shared = ends - starts > 1
    lists = [ids[a:b] for a, b in zip(starts[shared], ends[shared], strict=True)]
    of: list[list[np.ndarray]] = [[] for _ in range(m)]
    for one in lists:
        for x in one.tolist():
            of[x].append(one)
    root, links = list(range(m)), np.zeros(m, np.int64)
    weight = np.array([x[1] for x in members], np.int64)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x in range(m if right is None else cut):
        if not of[x]:
            continue
        overlap = np.bincount(np.concatenate(of[x]), minlength=m)
        overlap[: x + 1 if right is None else cut] = 0
        hit = np.flatnonzero((overlap > 0) & (100 * overlap >= percent * (sizes[x] + sizes - overlap)))
        links[x] += weight[hit].sum()
        links[hit] += weight[x]
        for y in hit.tolist():
            a, b = find(x), find(y)
            if a != b:
                root[max(a, b)] = min(a, b)
    low: dict[int, int] = {}
    for x in range(m):
        r = find(x)
        low[r] = min(low.get(r, members[x][0]), members[x][0])
    return {members[x][0]: low[find(x)] for x in range(m) if links[x]}, {members[x][0]: int(links[x]) for x in range(m) if links[x]}


def near_bitmaps(left: list[tuple[int, int, bytes]], right: list[tuple[int, int, bytes]] | None, percent: int) -> dict[int, int]:
    """The smallest class that each one may be connected with, for members (class, n, bitmap) with a possible link.

    A bitmap twice as long as another is folded to its length before they are compared.
    """
    members = left + (right or [])
    m, cut = len(members), len(left)
    n = np.array([x[1] for x in members], np.int64)
    bits = np.array([len(x[2]) * 8 for x in members])
    root = list(range(m))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    hit_any = np.zeros(m, bool)
    for level in np.unique(bits).tolist():
        at = np.flatnonzero((bits == level) | (bits == 2 * level))
        rows = np.zeros((len(at), level // 64), np.uint64)
        for r, x in enumerate(at.tolist()):
            w = np.frombuffer(members[x][2], np.uint64)
            rows[r] = w if bits[x] == level else w[: level // 64] ^ w[level // 64 :]
        own, mine = bits[at] == level, at < cut
        for r in range(len(at) - 1):
            if right is not None and not mine[r]:
                break
            others = np.arange(r + 1, len(at)) if right is None else np.flatnonzero(~mine)
            if not own[r]:
                others = others[own[others]]
            differ = np.bitwise_count(rows[others] ^ rows[r]).sum(axis=1, dtype=np.int64)
            hits = at[others[(100 + percent) * differ <= (100 - percent) * (n[at[r]] + n[at[others]])]]
            if len(hits):
                hit_any[at[r]] = True
                hit_any[hits] = True
                a = find(int(at[r]))
                for y in hits.tolist():
                    b = find(y)
                    if a != b:
                        root[max(a, b)], a = min(a, b), min(a, b)
    low: dict[int, int] = {}
    for x in range(m):
        r = find(x)
        low[r] = min(low.get(r, members[x][0]), members[x][0])
    return {members[x][0]: low[find(x)] for x in np.flatnonzero(hit_any).tolist()}


def by_block(dealt: DataFrame, key: str, fields: list[str], task, names: list[str], schema: str) -> DataFrame:
    """Run `task(left, right)` over the members (`fields`, the first one names them) of each pair of blocks; right is None for one block.

    Rows come sorted by task, so a worker holds two blocks at a time. Repeated rows of a member count once.
    """
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [key, "i", "j", "side", fields[0]]
    rows = dealt.select(key, F.explode("tasks").alias("_t"), *fields).select(key, "_t.i", "_t.j", "_t.side", *fields)
    rows = rows.repartition(parts, key, "i", "j").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides, found = None, ([], []), []

        def close() -> None:
            one = now is not None and now[1] == now[2]
            if len(sides[0]) > one and (one or sides[1]):
                found.extend(task(sides[0], None if one else sides[1]))

        def send() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)] or [pa.array([], pa.int64()) for _ in names], names=names)
            found.clear()
            return batch

        for b in batches:
            for of, i, j, side, *member in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (of, i, j) != now:
                    close()
                    now, sides = (of, i, j), ([], [])
                part = sides[side]
                if not part or part[-1][0] != member[0]:
                    part.append(tuple(member))
            if len(found) >= SENT_ROWS:
                yield send()
        close()
        yield send()

    return rows.mapInArrow(run, schema)


def filtered(classes: DataFrame, signed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): edges of the components that bitmaps leave; classes: class, rep, docs, n, component, a materialized table."""
    bitmaps = signed.select(F.col("class").alias("_c"), F.col("doc_id").alias("_d"), "bitmap")
    whole = with_tasks(classes, "component", "class", percent, BLOCK_SHINGLES).join(bitmaps, (F.col("class") == F.col("_c")) & (F.col("rep") == F.col("_d")))

    def task(left: list, right: list | None) -> list:
        return sorted(near_bitmaps(left, right, percent).items())

    return by_block(whole, "component", ["class", "n", "bitmap"], task, ["a", "b"], "a long, b long")


def verified(classes: DataFrame, docs: DataFrame, percent: int = PERCENT, k: int = WORDS) -> DataFrame:
    """(class, low, links) of every class with a link, a row for each task that finds one; classes: class, rep, docs, n, component."""
    dealt = few(with_tasks(classes, "component", "class", percent, BLOCK_SHINGLES), "jaccard-tasks")
    texts = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("rep"), "text")
    names, kinds = ["component", "class", "docs", "tasks"], "component long, class long, docs long, tasks array<struct<i: long, j: long, side: int>>"

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingle_set(words_of(t.as_py()), k)[0] for t in b.column(len(names))]
            mine = pa.array([digest_of(s) == c for s, c in zip(found, b.column(1).to_pylist(), strict=True)], pa.bool_())  # another row may share the id
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array([s.tobytes() for s in found], pa.binary())], names=[*names, "set"]).filter(mine)

    def task(left: list, right: list | None) -> list:
        whole = lambda part: [(m[0], m[1], np.frombuffer(m[2], np.uint64)) for m in part]
        low, links = verify_block(whole(left), None if right is None else whole(right), percent)
        return [(x, low[x], links[x]) for x in sorted(low)]

    whole = texts.join(dealt, "rep").select(*names, "text").mapInArrow(sets, f"{kinds}, set binary")
    return by_block(whole, "component", ["class", "docs", "set"], task, ["class", "low", "links"], "class long, low long, links long")


def linked_rows(docs: DataFrame, percent: int = PERCENT, k: int = WORDS) -> tuple[DataFrame, list[DataFrame]]:
    """(doc_id, text_hash, n_shingles, component_id, n_links): one row per document; text_hash tells apart rows that share an id; with it the tables that it is read from."""
    lean_batches(docs.sparkSession)
    signed = materialize(signatures(docs, percent, k), "jaccard-signatures")
    some = signed.filter("n > 0 AND doc_id IS NOT NULL")
    classes = some.groupBy("class", "n", "group").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("docs"))
    classes = materialize(classes, "jaccard-classes")
    one = F.min("class") == F.max("class")  # a prefix is the same in all of a group, a sketch only where it holds one class
    groups = materialize(some.groupBy("group", "n").agg(F.first("prefix").alias("prefix"), F.when(one, F.first("sketch")).alias("sketch"), F.min("cold").alias("cold")), "jaccard-groups")
    listed = candidate_groups(groups, percent)
    forget(groups)
    found = star_components(possible_edges(listed, percent))
    forget(listed)
    several = classes.groupBy("group").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select(F.col("group").alias("node"), F.col("group").alias("component"))
    held = found.unionByName(several.join(found, "node", "left_anti"))
    candidates = materialize(classes.join(held.withColumnRenamed("node", "group"), "group").select("class", "rep", "docs", "n", "component"), "jaccard-candidates")
    possible = star_components(filtered(candidates, some, percent))
    ids = materialize(signed.select("doc_id", "text_hash", "class", "n"), "jaccard-ids")
    forget(candidates)
    forget(signed)
    left = materialize(classes.join(possible.withColumnRenamed("node", "class"), "class").select("class", "rep", "docs", "n", "component"), "jaccard-possible")
    proof = materialize(verified(left, docs, percent, k), "jaccard-links")
    forget(left)
    joined = materialize(star_components(proof.select(F.col("class").alias("a"), F.col("low").alias("b"))), "jaccard-components")
    least = joined.join(classes.select(F.col("class").alias("node"), "rep"), "node").groupBy("component").agg(F.min("rep").alias("_least"))
    named = joined.join(least, "component").select(F.col("node").alias("class"), F.col("component").alias("_component"), "_least")
    links = proof.groupBy("class").agg(F.sum("links").alias("_links"))
    more = classes.join(named, "class", "left").filter("docs > 1 OR _component IS NOT NULL").join(links, "class", "left")
    more = few(more.select(F.col("class").alias("_class"), "rep", "docs", "_component", "_least", "_links"), "jaccard-named")
    every = ids.join(more, (F.col("class") == F.col("_class")) & F.col("doc_id").isNotNull() & (F.col("n") > 0), "left")
    rows = every.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("_least", "rep", "doc_id").alias("component_id"), (F.coalesce("docs", F.lit(1)) - 1 + F.coalesce("_links", F.lit(0))).alias("n_links"))
    return rows, [ids, classes, more]


def link(docs: DataFrame, percent: int = PERCENT, k: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links): one row per document."""
    return linked_rows(docs, percent, k)[0].select("doc_id", "n_shingles", "component_id", "n_links")


def keep_first(docs: DataFrame, percent: int = PERCENT, k: int = WORDS) -> DataFrame:
    """One document of each component, that of the smallest id, with its columns; rows with that id are one document.

    Rows are dropped by id and text, so that a row doesn't go with its namesake.
    """
    rows, made = linked_rows(docs, percent, k)
    rows = rows.filter("doc_id <> component_id").select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"))
    off = few(rows.distinct(), "jaccard-off")
    for table_ in made:
        forget(table_)
    return docs.join(off, (F.col("doc_id").cast("long") == F.col("_d")) & (F.xxhash64("text") == F.col("_h")), "left_anti").select(*docs.columns)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents"))

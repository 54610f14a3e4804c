"""Benchmark decontamination: a BM25 inverted index of test items with block-max WAND, queried by every passage.

The benchmark is the indexed side. Each item's impacts are divided by the score it gets from itself, so one threshold
holds for all: a passage is retrieved with an item when it carries at least that share of the item's BM25 mass. A
passage is a window of two steps of words, begun at every step. Items are indexed by classes of length, whose step is
the power of two that their longest item fits in, so that an item which stands in a document stands whole in one window
and a long item widens the windows of no shorter one. Per document, numpy sums the largest impact of each
distinct indexed word of every window within each of up to RANGES ranges of items (items are ordered by length, so
that the short ones, where a common word weighs much, stand together); only windows and ranges whose sum reaches the
threshold can hold a hit and go to WAND, which looks at the upper bounds of whole posting lists, then of blocks,
before it scores an item. A hit is verified:
the word 3-grams of both the item's question (its first two thirds, unless the benchmark has columns question and
answer) and its answer must be found in the passage.

The index is broadcast. It holds at most ITEMS_A_BLOCK items; a larger benchmark is cut into blocks by digest of the
item, and every document is matched with each block in turn. Item counts, document frequencies and lengths are those of
the whole benchmark, so scores and hits are the same for blocks of any size.

Defined results: ids of items and documents may have any type; null and empty texts and items without words match
nothing; case and punctuation don't count;
items of fewer than three words are verified by shorter n-grams; repeated rows are matched each; an item that occurs
often in a document gives one row, that of its best passage; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .util import lean_batches, materialize, table, without_ids

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, GRAM = 0.6, 0.5, 3
STEP = 64
ITEMS_A_BLOCK = 20_000
POSTINGS_A_BLOCK = 32
RANGES = 32
END = 1 << 40
WORDS = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def grams(words: list[str], n: int) -> set[tuple[str, ...]]:
    return set(zip(*(words[i:] for i in range(n)), strict=False))


@dataclass
class Postings:
    items: list[int]
    impacts: list[float]
    ends: list[int] = field(default_factory=list)
    tops: list[float] = field(default_factory=list)
    top: float = 0.0

    def close(self) -> None:
        for at in range(0, len(self.items), POSTINGS_A_BLOCK):
            self.ends.append(self.items[min(at + POSTINGS_A_BLOCK, len(self.items)) - 1])
            self.tops.append(max(self.impacts[at : at + POSTINGS_A_BLOCK]))
        self.top = max(self.tops)


class Cursor:
    """A place in a posting list."""

    __slots__ = ("list", "at", "item")

    def __init__(self, postings: Postings):
        self.list, self.at, self.item = postings, 0, postings.items[0]

    def seek(self, item: int) -> None:
        """Go to the first posting of `item` or later."""
        items, at = self.list.items, self.at
        while at < len(items) and items[at] < item:
            block = at // POSTINGS_A_BLOCK
            at = at + 1 if self.list.ends[block] >= item else (block + 1) * POSTINGS_A_BLOCK
        self.at, self.item = at, items[at] if at < len(items) else END

    def block(self, item: int) -> tuple[float, int]:
        """The largest impact, and the last item, of the block where `item` would stand."""
        ends = self.list.ends
        block = self.at // POSTINGS_A_BLOCK
        while block < len(ends) and ends[block] < item:
            block += 1
        return (self.list.tops[block], ends[block]) if block < len(ends) else (0.0, END)


@dataclass
class Whole:
    """Of all items with words: how many, their words; df of the words of one block among all items."""

    items: int
    words: int
    df: dict[str, int]


def step_for(words: int) -> int:
    """The step of the class of items of so many words."""
    return max(STEP, 1 << (words - 1).bit_length())


class ItemIndex:
    """The inverted index of a block of items."""

    def __init__(self, items: list[tuple[int, list[str], list[str]]], whole: Whole | None = None):
        """items: id, words of the question, words of the answer; `whole`: statistics of all blocks, if there are others."""
        items = sorted((i for i in items if i[1] or i[2]), key=lambda i: (len(i[1]) + len(i[2]), str(i[0])))
        self.ids = [i[0] for i in items]
        self.checks = [(n := min(GRAM, len(q) or GRAM), grams(q, n), m := min(GRAM, len(a) or GRAM), grams(a, m)) for _, q, a in items]
        counts = [Counter(q + a) for _, q, a in items]
        sizes = [sum(c.values()) for c in counts]
        whole = whole or Whole(len(items), sum(sizes), Counter(w for c in counts for w in c))
        mean = whole.words / max(whole.items, 1)
        self.step = step_for(max(sizes, default=1))
        df = dict.fromkeys(w for c in counts for w in c)
        idf = {w: float(np.log1p((whole.items - whole.df[w] + 0.5) / (whole.df[w] + 0.5))) for w in df}
        self.terms = {w: k for k, w in enumerate(df)}
        self.postings = [Postings([], []) for _ in df]
        for k, (c, size) in enumerate(zip(counts, sizes, strict=True)):
            impact = {w: idf[w] * n * (K1 + 1) / (n + K1 * (1 - B + B * size / mean)) for w, n in c.items()}
            own = sum(impact.values())
            for w, x in impact.items():
                self.postings[self.terms[w]].items.append(k)
                self.postings[self.terms[w]].impacts.append(x / own)
        for p in self.postings:
            p.close()
        self.width = max(1, -(-len(items) // RANGES))
        self.tops = np.zeros((len(df), max(1, -(-len(items) // self.width))))
        for t, p in enumerate(self.postings):
            np.maximum.at(self.tops[t], np.array(p.items) // self.width, p.impacts)

    def search(self, terms: list[int], first: int = 0, stop: int = END, threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """Every item in [first, stop) that the terms score at the threshold or above, by block-max WAND."""
        threshold -= 1e-9  # sums in another order
        cursors = [Cursor(self.postings[t]) for t in terms]
        if first:
            for c in cursors:
                c.seek(first)
        cursors = [c for c in cursors if c.item < stop]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c.item)
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                if c.item >= stop:
                    break
                bound += c.list.top
                if bound >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot].item
            while pivot + 1 < len(cursors) and cursors[pivot + 1].item == item:
                pivot += 1
            blocks = [c.block(item) for c in cursors[: pivot + 1]]
            if sum(b[0] for b in blocks) < threshold:
                to = min([b[1] + 1 for b in blocks] + ([cursors[pivot + 1].item] if pivot + 1 < len(cursors) else []))
                to = max(to, item + 1)
                for c in cursors[: pivot + 1]:
                    c.seek(to)
            elif cursors[0].item == item:
                got = fsum(c.list.impacts[c.at] for c in cursors[: pivot + 1])  # the same in any order
                if got >= threshold:
                    found.append((item, got))
                for c in cursors[: pivot + 1]:
                    c.seek(item + 1)
            else:
                for c in cursors[:pivot]:
                    if c.item < item:
                        c.seek(item)
            cursors = [c for c in cursors if c.item < stop]
        return found

    def windows(self, words: list[str]) -> Iterator[tuple[int, int, list[int]]]:
        """First word, range of items and distinct indexed words of each window and range whose bound reaches the threshold."""
        get, step, n = self.terms.get, self.step, len(words)
        ids = np.array([get(w, -1) for w in words], np.int64)
        pos = np.flatnonzero(ids >= 0)
        if not len(pos):
            return
        term = ids[pos]
        for k in range(max(1, -(-n // step) - 1)):
            a, b = np.searchsorted(pos, (k * step, (k + 2) * step))
            held = np.unique(term[a:b])
            for r in np.flatnonzero(self.tops[held].sum(axis=0) >= THRESHOLD - 1e-9):
                yield k * step, int(r), held.tolist()

    def leaks(self, text: str | None) -> list[tuple[int, float, float, float, int]]:
        """(item, score, share of question found, share of answer found, first word of the passage), the best of each item."""
        words, best = words_of(text), {}
        for at, r, terms in self.windows(words):
            hits = self.search(terms, r * self.width, (r + 1) * self.width)
            passage = words[at : at + 2 * self.step] if hits else []
            seen: dict[int, set] = {}
            for item, got in hits:
                n, question, m, answer = self.checks[item]
                shares = [len(part & seen.setdefault(k, grams(passage, k))) / len(part) if part else 1.0 for k, part in ((n, question), (m, answer))]
                if min(shares) >= OVERLAP and (item not in best or (got, -at) > (best[item][0], -best[item][3])):
                    best[item] = (got, *shares, at)
        return [(self.ids[k], *v) for k, v in sorted(best.items())]


def by_length(items: list[tuple[int, list[str], list[str]]], whole: Whole | None = None) -> list[ItemIndex]:
    """An index for each class of length, with the statistics of all items."""
    items = [i for i in items if i[1] or i[2]]
    if whole is None:
        whole = Whole(len(items), sum(len(q) + len(a) for _, q, a in items), Counter(w for _, q, a in items for w in {*q, *a}))
    classes: dict[int, list] = {}
    for i in items:
        classes.setdefault(step_for(len(i[1]) + len(i[2])), []).append(i)
    return [ItemIndex(part, whole) for _, part in sorted(classes.items())]


def item_statistics(items: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(items, words) in one row, and (block, word, n): the words of each block with their df among all items; `items` has block."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [[w for t in texts for w in words_of(t)] for texts in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array([sorted(set(w)) for w in words], pa.list_(pa.string()))], names=["block", "size", "held"])

    sized = materialize(items.select("block", *columns).mapInArrow(cut, "block long, size long, held array<string>"), "items").filter("size > 0")
    totals = sized.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum("size"), F.lit(0)).alias("words"))
    held = sized.select("block", F.explode("held").alias("word")).groupBy("block", "word").agg(F.count(F.lit(1)).alias("k"))
    every = held.groupBy("word").agg(F.sum("k").alias("n"))
    return totals, materialize(held.join(every, "word").select("block", "word", "n"), "items-df")


def indexes(benchmark: DataFrame, items_a_block: int = ITEMS_A_BLOCK) -> Iterator[list[ItemIndex]]:
    """The indexes of each block of items; each block is collected alone."""
    columns = ["question", "answer"] if {"question", "answer"} <= set(benchmark.columns) else ["text"]
    items = benchmark.select("item_id", *columns)
    blocks = -(-items.count() // items_a_block)
    if blocks > 1:
        items = items.withColumn("block", F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(blocks)).cast("long"))
        totals, df = item_statistics(items, columns)
        totals = totals.first()
    for k in range(blocks):
        part = items if blocks == 1 else items.filter(F.col("block") == k)
        rows = []
        for r in part.toLocalIterator():
            if columns == ["text"]:
                words = words_of(r["text"])
                cut = -(-2 * len(words) // 3)
                rows.append((r["item_id"], words[:cut], words[cut:]))
            else:
                rows.append((r["item_id"], words_of(r["question"]), words_of(r["answer"])))
        yield by_length(rows, None if blocks == 1 else Whole(*totals, {r["word"]: r["n"] for r in df.filter(F.col("block") == k).toLocalIterator()}))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, first_word): the verified leaks."""
    types, kind = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id {types}, item_id {kind}, score double, question_overlap double, answer_overlap double, first_word long"
    lean_batches(docs.sparkSession)
    item_type = to_arrow_type(benchmark.schema["item_id"].dataType)
    found = docs.sparkSession.createDataFrame([], schema)
    for k, index in enumerate(indexes(benchmark)):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def match(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"]
            for b in batches:
                rows, hits = [], []
                for i, text in enumerate(b.column(1)):
                    value = text.as_py()
                    for one in sent.value:
                        for hit in one.leaks(value):
                            rows.append(i)
                            hits.append(hit)
                ids = b.column(0).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([h[0] for h in hits], item_type), *[pa.array([h[j] for h in hits], pa.float64()) for j in (1, 2, 3)], pa.array([h[4] for h in hits], pa.int64())], names=names)

        part = docs.select("doc_id", "text").mapInArrow(match, schema)
        found = part if not k else found.unionByName(part)
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no test item was found; those without an id stay."""
    return without_ids(docs, find_leaks(docs, benchmark))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

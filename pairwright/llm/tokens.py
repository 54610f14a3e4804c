"""Token counts by a two-tier lookup on the map side; no pre-token is ever shuffled.

A text is cut at white space, where no pre-token of the tokenizer crosses, into raw words. The first tier is a table of
the corpus' most frequent words: every task counts its words in bounded memory and sends its TASK_WORDS most frequent
ones at most, the sums of these give the TABLE_WORDS of the table, whatever their language. It is broadcast as sorted
64-bit hashes with the words' bytes and lengths in flat arrays, a few MB at most. Words that it lacks go, in batches, to
the tokenizer itself; the second tier, in the worker, keeps the lengths of words that were looked up for the next texts
and is emptied when it is full. Counting only decides what the table holds: every length comes from the library, so
normalisation, lower case and special strings inside texts follow its defaults.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each; a word of any length
is encoded whole; an empty table gives an empty result; further columns of the input are left out.
"""

from __future__ import annotations

import heapq
import os
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import lean_batches, table

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Words that a worker remembers.
CACHE_WORDS = 400_000
#: Words of the broadcast table, words that a task counts at a time, and words that it sends.
TABLE_WORDS, COUNTED_WORDS, TASK_WORDS = 1 << 16, 250_000, 1 << 13
#: Python's split() also cuts at these four, which the tokenizer keeps as signs of a word.
KEPT_SIGNS = "\x1c\x1d\x1e\x1f"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass
class FrequentTable:
    """Lengths of words in tokens, by sorted hashes; the words' bytes tell apart words of equal hash."""

    hashes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    text: bytes

    @classmethod
    def of(cls, words: list[str], sizes: list[int]) -> FrequentTable:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        h = np.array([xxhash.xxh3_64_intdigest(w) for w in raw], np.uint64)
        order = np.argsort(h)
        return cls(h[order], np.cumsum([0] + [len(raw[i]) for i in order]), np.array(sizes, np.uint32)[order], b"".join(raw[i] for i in order))

    def find(self, words: list[str]) -> dict[str, int]:
        """The lengths of those words that the table has."""
        if not len(self.hashes):
            return {}
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, raw), np.uint64, len(raw))
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        same = np.flatnonzero(self.hashes[at] == h)
        return {words[i]: int(self.lengths[at[i]]) for i in same.tolist() if self.text[self.starts[at[i]] : self.starts[at[i] + 1]] == raw[i]}


class WordLengths(dict):
    """Lengths of raw words in tokens: this worker's cache, filled from the frequent table, then from the tokenizer."""

    def __init__(self, path: str, frequent: FrequentTable | None = None):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        super().__init__()
        self.frequent, self.tokenizer = frequent, Tokenizer.from_file(path)
        self.held: dict[str, int] = {}  # words of the table that have come up; they stay when the cache is emptied
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def total(self, text: str) -> int:
        words = cut(text)
        try:
            return sum(map(self.__getitem__, words))
        except KeyError:
            missed = list({w for w in words if w not in self})
            if len(self) + len(missed) > CACHE_WORDS:
                self.clear()
                self.update(self.held)
                missed = [w for w in set(words) if w not in self]
            if self.frequent:
                found = self.frequent.find(missed)
                self.held.update(found)
                self.update(found)
                missed = [w for w in missed if w not in self]
            self.update(zip(missed, lengths(self.tokenizer, missed), strict=True))
            return sum(map(self.__getitem__, words))


def cut(text: str) -> list[str]:
    if any(c in text for c in KEPT_SIGNS):
        import re

        return re.findall(r"[^\t-\r \x85\xa0  -     　]+", text)
    return text.split()


def lengths(tokenizer, words: list[str]) -> list[int]:
    return [len(e) for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]


def count_words(docs: DataFrame, most: int = TABLE_WORDS) -> list[str]:
    """The words that the tasks' counts have most often, at most `most`; equal counts in order of the words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def send() -> pa.RecordBatch:
            top = heapq.nlargest(TASK_WORDS, ((n, w) for w, n in counts.items() if n > 1))
            return pa.RecordBatch.from_arrays([pa.array([w for _, w in top], pa.string()), pa.array([n for n, _ in top], pa.int64())], names=["word", "n"])

        for b in batches:
            for text in b.column(0):
                if words := text.as_py():
                    counts.update(cut(words))
                if len(counts) > COUNTED_WORDS:
                    rare = [w for w, n in counts.items() if n == 1]
                    for w in rare:
                        del counts[w]
                    if len(counts) > COUNTED_WORDS // 2:
                        yield send()
                        counts.clear()
        yield send()

    counted = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = counted.orderBy(F.desc("n"), "word").limit(most).select("word").toArrow()  # at most `most` words
    return rows["word"].to_pylist()


def frequent_words(path: str, words: list[str] | None = None) -> FrequentTable:
    """The table of the words given, or of the tokenizer's own whole words."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    if words is None:
        words = [w.removesuffix("</w>") for w in tokenizer.get_vocab() if w.endswith("</w>") and w != "</w>" and not w.removesuffix("</w>").isspace()]
        words = [w for w in dict.fromkeys(words) if cut(w) == [w]]
    return FrequentTable.of(words, lengths(tokenizer, words))


#: A worker's caches; lengths depend on the tokenizer alone, so they serve every table.
_workers: dict[str, WordLengths] = {}


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit): one row per document."""
    path = path or vocabulary_path()
    lean_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(frequent_words(path, count_words(docs)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _workers:
            _workers[path] = WordLengths(path, sent.value)
        total = _workers[path].total
        for batch in batches:
            n = pa.array((total(t) if (t := x.as_py()) else 0 for x in batch.column(2)), pa.int64(), size=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], names=["doc_id", "n_bytes", "n_tokens"])

    facts = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    counted = facts.mapInArrow(count, f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))

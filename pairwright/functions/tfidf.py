"""Character n-gram TF-IDF inside word bounds, as a distributed estimator.

The vocabulary is a table (ngram, df, idf), fitted on the unique training records alone and never refitted at
transform. Vectors are made once for each distinct text, normalised, and kept packed: 64-bit digests of the n-grams in
order, then their weights. The similarity of a pair is the dot product of two of them, taken in Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import fold, pieces, strip

SHORTEST, LONGEST = 3, 5
#: N-grams of a vocabulary that every worker holds, of about 200 bytes each there.
MOST_SHARED = 500_000


def ngrams(text: Column) -> Column:
    """All n-grams of 3 to 5 signs of each word, a blank on both sides of it; a text without words has none."""

    def of_word(word: Column) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        starts = lambda n: F.sequence(F.lit(1), F.length(padded) - n + 1)
        lengths = F.filter(F.sequence(F.lit(SHORTEST), F.lit(LONGEST)), lambda n: n <= F.length(padded))
        return F.flatten(F.transform(lengths, lambda n: F.transform(starts(n), lambda i: F.substr(padded, i, n))))

    return F.flatten(F.transform(pieces(text), of_word))


def prepared(text: Column) -> Column:
    return strip(fold(text))


def spread(texts: DataFrame, *by: str) -> DataFrame:
    """The rows dealt over all cores: texts are few bytes, and adaptive execution would leave their n-grams to one task."""
    spark = texts.sparkSession
    return texts.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *by)


def document_frequencies(texts: DataFrame, column: str) -> DataFrame:
    """(ngram, df): in how many rows each n-gram stands."""
    return spread(texts.select(column)).select(F.explode(F.array_distinct(ngrams(prepared(F.col(column))))).alias("ngram")).groupBy("ngram").agg(F.count(F.lit(1)).alias("df"))


@dataclass
class TfIdf:
    """A fitted vocabulary: n-grams with their inverse document frequencies, and the number of training records."""

    vocabulary: DataFrame
    records: int
    held: Broadcast | None = None

    @classmethod
    def fit(cls, texts: DataFrame, column: str, records: int | None = None) -> TfIdf:
        """Empty texts count as records; a vocabulary without n-grams is an error. `records` is their number where it is known."""
        n = texts.count() if records is None else records
        vocabulary = document_frequencies(texts, column).withColumn("idf", F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1)
        vocabulary = vocabulary.persist(StorageLevel.MEMORY_AND_DISK)  # read for every side and field; a lost part is made again
        if not vocabulary.count():  # fills the stored table
            raise ValueError(f"The training records have no character n-grams in {column}.")
        return cls(vocabulary, n)

    def shared(self) -> Broadcast | None:
        """n-gram: (place, idf) for all workers; none for a vocabulary of more than MOST_SHARED n-grams."""
        if self.held is None and self.vocabulary.count() <= MOST_SHARED:
            table = self.vocabulary.select("ngram", "idf").toArrow()
            known = zip(table["ngram"].to_pylist(), enumerate(table["idf"].to_pylist()), strict=True)
            self.held = self.vocabulary.sparkSession.sparkContext.broadcast(dict(known))
        return self.held

    def vectors(self, texts: DataFrame, column: str, out: str) -> DataFrame:
        """(column, out): the normalised vector of each distinct text, a map; unknown n-grams are left out.

        Vocabulary and n-grams meet in an equi-join on the n-gram, so the vocabulary may be larger than memory.
        """
        distinct = spread(texts.select(column).distinct(), column)
        counted = distinct.select(column, F.explode(ngrams(prepared(F.col(column)))).alias("ngram")).groupBy(column, "ngram").agg(F.count(F.lit(1)).alias("tf"))
        weighed = counted.join(self.vocabulary, "ngram").select(column, "ngram", (F.col("tf") * F.col("idf")).alias("w"))
        found = weighed.groupBy(column).agg(F.array_sort(F.collect_list(F.struct(F.xxhash64("ngram").alias("k"), "w"))).alias("v"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
        return found.select(column, F.arrow_udf(packed, "binary")(F.transform("v", lambda e: F.struct(e["k"], (e["w"] / F.col("norm")).alias("w")))).alias(out))


def packed(vectors: pa.Array) -> pa.Array:
    """Lists of (k, w) as bytes: all k of a list, then all its w."""
    sizes = np.diff(vectors.offsets.to_numpy())
    starts, flat = np.cumsum(sizes) - sizes, vectors.flatten()
    words = np.empty(2 * len(flat), np.int64)
    at = np.arange(len(flat)) + np.repeat(starts, sizes)
    words[at] = flat.field("k").to_numpy()
    words[at + np.repeat(sizes, sizes)] = flat.field("w").to_numpy().view(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32) * 16
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(words.tobytes())])


def unpacked(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eight-byte words of packed vectors, where each vector starts, and its number of n-grams; null has none."""
    vectors = vectors.cast(pa.binary())
    _, offsets, data = vectors.buffers()
    bounds = np.frombuffer(offsets, np.int32)[vectors.offset : vectors.offset + len(vectors) + 1]
    words = np.frombuffer(data, np.int64, (bounds[-1] - bounds[0]) // 8, bounds[0]) if bounds[-1] > bounds[0] else np.zeros(0, np.int64)
    return words, (bounds[:-1] - bounds[0]) // 8, np.diff(bounds) // 16


def dots(a: pa.Array, b: pa.Array) -> pa.Array:
    """Dot products of packed vectors, row by row. Rows with the same `a` are compared at once."""
    known = a.dictionary_encode()
    codes = known.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    words, starts, sizes = unpacked(known.dictionary)
    others, begins, counts = unpacked(b)
    begins, counts = begins[order], counts[order]
    ends = np.cumsum(counts)
    at = np.arange(counts.sum()) + np.repeat(begins - ends + counts, counts)
    keys, weights = others[at], others.view(np.float64)[at + np.repeat(counts, counts)]
    parts = np.zeros(len(at))
    codes = codes[order]
    edges = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1], [True]])) if len(codes) else np.zeros(1, int)
    for first, past in zip(edges[:-1], edges[1:], strict=True):
        c, low, high = codes[first], ends[first] - counts[first], ends[past - 1]
        if c < 0 or not sizes[c] or low == high:
            continue
        own = words[starts[c] : starts[c] + sizes[c]]
        place = np.minimum(np.searchsorted(own, keys[low:high]), sizes[c] - 1)
        hit = np.flatnonzero(own[place] == keys[low:high])
        parts[low + hit] = words[starts[c] + sizes[c] + place[hit]].view(np.float64) * weights[low + hit]
    sums = np.zeros(len(codes))
    sums[order] = np.bincount(np.repeat(np.arange(len(codes)), counts), parts, len(codes))
    return pa.array(sums)


def cosine(a: Column, b: Column) -> Column:
    """Dot product of two normalised vectors; 0 where either text has none."""
    return F.arrow_udf(dots, "double")(a, b)

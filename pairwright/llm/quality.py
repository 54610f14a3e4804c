"""Quality classifier: histogram gradient-boosted trees over document statistics.

A document's statistics come from its bytes and words alone. The trees are grown level by level on features binned by
quantiles, with logistic loss, and flattened into arrays (feature, threshold bin, value), so that scoring walks all
documents of a batch and all trees at once in numpy. The model is fitted on at most FIT_ROWS labelled rows, those with
the smallest digest of their id: that bound is a parameter and the only bound; every document is scored.

Defined results: null and empty texts have the statistics of a text without words and get a score like any other;
labels without a quality or without a document are left out in fitting, repeated ones count once; of documents that
share a labelled id one counts, that of the largest statistics; without any label to
learn from every score is 0.5; repeated rows get equal scores; an empty table gives an empty result; `score` passes
further columns of the input through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .util import lean_batches, table

FIT_ROWS = 20_000
BINS, ROUNDS, DEPTH, RATE, LEAST_WEIGHT, SHRINK = 64, 60, 4, 0.2, 2.0, 1.0
FEATURES = (
    "log_bytes", "log_words", "mean_word", "spaces", "line_feeds", "upper", "digits", "stops", "commas", "pipes",
    "exclamations", "hashes", "other_signs", "high_bytes", "distinct_words", "top_word", "runs", "one_byte_words",
    "long_words", "distinct_lines", "words_a_line", "words_a_stop", "capital_words", "sign_words",
)


def _classes() -> np.ndarray:
    """A column for each class of byte, so that byte counts @ columns gives the counts by class."""
    signs = [b" ", b"\n", bytes(range(65, 91)), bytes(range(48, 58)), b".", b",", b"|", b"!", b"#$%&*@^~", b"\"'()-/:;<=>?[\\]_`{}+", bytes(range(128, 256))]
    columns = np.zeros((256, len(signs)))
    for i, s in enumerate(signs):
        columns[list(s), i] = 1
    return columns


_CLASSES = _classes()


def statistics(text: str | None) -> np.ndarray:
    """The features of a text, in the order of FEATURES."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    n = len(raw)
    sign = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES
    words, lines = text.split(), text.count("\n") + 1
    k = len(words)
    out = np.zeros(len(FEATURES))
    out[0], out[1] = np.log1p(n), np.log1p(k)
    if not n:
        return out
    out[2] = n / max(k, 1)
    out[3:14] = sign / n
    if not k:
        return out
    sizes = np.fromiter(map(len, words), np.int64, k)
    seen = dict.fromkeys(words, 0)
    if len(seen) < k:
        for w in words:
            seen[w] += 1
        out[15] = max(seen.values()) / k
        out[16] = sum(map(str.__eq__, words, words[1:])) / k
    else:
        out[15] = 1 / k
    out[14] = len(seen) / k
    out[17], out[18] = np.count_nonzero(sizes == 1) / k, np.count_nonzero(sizes > 16) / k
    out[19] = len(set(text.split("\n"))) / lines
    out[20], out[21] = k / lines, k / (sign[4] + 1)
    out[22] = sum(map(str.isupper, words)) / k
    out[23] = sum(1 for w in words if not w[-1].isalnum()) / k
    return out


@dataclass
class Forest:
    """Trees as arrays: `feature` and `bin` by tree and inner node, `value` by tree and leaf; a full tree of DEPTH levels."""

    cuts: list[np.ndarray]
    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    base: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(self.cuts)], axis=1).astype(np.int16)

    def scores(self, x: np.ndarray) -> np.ndarray:
        n = len(x)
        if not n:
            return np.zeros(0)
        bins, total = self.binned(x), np.full(n, self.base)
        rows = np.arange(n)[:, None]
        if len(self.feature):
            trees = np.arange(len(self.feature))[None, :]
            node = np.zeros((n, len(self.feature)), np.int32)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (bins[rows, self.feature[trees, node]] > self.bin[trees, node])
            total = total + self.value[trees, node - (2**DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Histogram gradient boosting; the same rows in any order give the same trees up to rounding."""
    order = np.lexsort((*x.T, y))
    x, y = x[order], y[order].astype(float)
    d = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(d)]
    p = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    forest = Forest(cuts, np.zeros((0, 2**DEPTH - 1), np.int32), np.zeros((0, 2**DEPTH - 1), np.int16), np.zeros((0, 2**DEPTH)), float(np.log(p / (1 - p))))
    if p < 1e-5 or p > 1 - 1e-5:
        return forest
    bins, margin = forest.binned(x).astype(np.int64), np.full(len(y), forest.base)
    features, borders, values = [], [], []
    flat = bins + np.arange(d) * BINS
    for _ in range(ROUNDS):
        q = 1 / (1 + np.exp(-margin))
        g, h = q - y, q * (1 - q)
        feature, border, node = np.zeros(2**DEPTH - 1, np.int32), np.full(2**DEPTH - 1, BINS, np.int16), np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (d * BINS) + flat).ravel()
            sums = [np.bincount(at, np.repeat(w, d), width * d * BINS).reshape(width, d, BINS).cumsum(axis=2) for w in (g, h)]
            (gl, hl), (gt, ht) = sums, (sums[0][:, :, -1:], sums[1][:, :, -1:])
            gain = gl**2 / (hl + SHRINK) + (gt - gl) ** 2 / (ht - hl + SHRINK) - gt**2 / (ht + SHRINK)
            gain[(hl < LEAST_WEIGHT) | (ht - hl < LEAST_WEIGHT)] = 0
            best = gain.reshape(width, -1)
            top = best.argmax(axis=1)
            for k in range(width):
                if best[k, top[k]] > 1e-9:
                    feature[first + k], border[first + k] = divmod(top[k], BINS)
            node = 2 * node + 1 + (bins[np.arange(len(y)), feature[node]] > border[node])
        leaf = node - (2**DEPTH - 1)
        value = -RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + SHRINK)
        margin = margin + value[leaf]
        features.append(feature), borders.append(border), values.append(value)
    return Forest(cuts, np.array(features), np.array(borders), np.array(values), forest.base)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Forest:
    """Fit on the labelled rows that aren't held out, at most `fit_rows` of them."""
    learn = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    learn = learn.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id", "quality").limit(fit_rows)
    lean_batches(docs.sparkSession)
    chosen = docs.select("doc_id", "text").join(F.broadcast(learn), "doc_id").select(learn["doc_id"], "text", "quality")  # at most fit_rows rows

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t.as_py()) for t in b.column(0)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "quality", "x"])

    measured = chosen.select("text", "doc_id", "quality").mapInArrow(measure, f"doc_id {dict(labels.dtypes)['doc_id']}, quality int, x array<double>")
    rows = measured.groupBy("doc_id", "quality").agg(F.max("x").alias("x")).toArrow()  # a row for each of learn
    y = np.array(rows["quality"].to_pylist(), float)
    x = np.array(rows["x"].to_pylist()).reshape(-1, len(FEATURES))
    return fit(x, y) if len(y) else fit(np.zeros((2, len(FEATURES))), np.array([0.0, 1.0]))


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """The rows of `docs` with score, for 0 to 1."""
    names = docs.columns
    text = names.index("text")
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                x = np.array([statistics(t.as_py()) for t in part.column(text)]).reshape(-1, len(FEATURES))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sent.value.scores(x))], names=[*names, "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents whose score reaches the threshold, with their columns."""
    scored = score(docs.withColumnRenamed("score", "_score_"), train(docs, labels)) if "score" in docs.columns else score(docs, train(docs, labels))
    kept = scored.filter(F.col("score") >= threshold).drop("score")
    return kept.withColumnRenamed("_score_", "score") if "score" in docs.columns else kept


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    facts = docs.select("text", "doc_id")
    scored = score(facts, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

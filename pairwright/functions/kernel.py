"""The twelve features of pairs in Arrow batches, from records that are packed as JSON once each.

A batch names its records by their packs, or by the places of these in a list that all workers hold; each distinct pack
is read once, each distinct pair of names, of addresses and of places (codes and country) is compared once. The n-grams
of a text are weighed by a vocabulary that all workers hold, so only packs or their places move with the pairs.
`features.pair_features` has the same features as expressions.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import FEATURE_NAMES, record_features
from .text import fold, pieces
from .tfidf import LONGEST, SHORTEST, TfIdf, prepared

#: Texts that a worker keeps read; entries of a table of signs by text; signs that one word of bits has.
MOST_KEPT, MOST_SIGNS, BITS = 50_000, 2_000_000, 64
SCHEMA = "struct<" + ",".join(f"{n}:double" for n in FEATURE_NAMES) + ">"


def record_packs(records: DataFrame, mask_multiple_codes: bool = False, folded=fold) -> DataFrame:
    """(entity_id, pack): what the features need of each record, with the words of name and address, as JSON."""
    words = lambda c: pieces(prepared(F.col(c)))
    return record_features(records, mask_multiple_codes, folded).select("entity_id", F.to_json(F.struct("f.*", words("f.name").alias("name_words"), words("f.address").alias("address_words"))).alias("pack"))


def held_packs(*sides: DataFrame) -> tuple[list[DataFrame], Broadcast]:
    """Of sides (key, pack): (key, place) of each, and all their packs by place, which all workers hold."""
    spark, found, packs = sides[0].sparkSession, [], []
    for side in sides:
        table = side.toArrow()
        places = pa.array(np.arange(len(packs), len(packs) + len(table), dtype=np.int32))
        found.append(spark.createDataFrame(pa.table({side.columns[0]: table[0], "place": places})))
        packs += table["pack"].to_pylist()
    return found, spark.sparkContext.broadcast(packs)


class Text:
    """A name or an address: its signs, its sets, and its normalised vector (places in the vocabulary, weights)."""

    def __init__(self, text: str, tokens: list, numbers: list, words: list, vocabulary: dict | None):
        self.signs, self.tokens, self.numbers = np.frombuffer(text.encode("utf-32-le"), np.uint32), frozenset(tokens), frozenset(numbers)
        counts: dict[str, int] = {}
        for word in words if vocabulary else ():
            padded = f" {word} "
            for n in range(SHORTEST, min(LONGEST, len(padded)) + 1):
                for i in range(len(padded) - n + 1):
                    gram = padded[i : i + n]
                    counts[gram] = counts.get(gram, 0) + 1
        known = [(*vocabulary[g], k) for g, k in counts.items() if g in vocabulary] if vocabulary else []
        self.places = np.array([p for p, _, _ in known], np.int64)
        weights = np.array([idf * k for _, idf, k in known], float)
        self.weights = weights / np.sqrt((weights * weights).sum()) if len(known) else weights


class Reader:
    """The packs that a worker has read: numbers of their name, address and place, and what these are.

    Where it holds a list of packs, batches have places in it.
    """

    def __init__(self, names: dict | None, addresses: dict | None, held: list | None = None):
        self.vocabularies, self.held = (names, addresses), held
        self.forget()

    def forget(self) -> None:
        self.packs, self.keys, self.parts = {}, ({}, {}, {}), ([], [], [])
        self.table = None if self.held is None else np.full((len(self.held), 4), -1)

    def number(self, kind: int, key: tuple, make) -> int:
        n = self.keys[kind].get(key)
        if n is None:
            n = self.keys[kind][key] = len(self.parts[kind])
            self.parts[kind].append(make())
        return n

    def read(self, pack: str) -> tuple[int, int, int, bool]:
        """Numbers of name, address and place, and whether the address has a digit."""
        if (known := self.packs.get(pack)) is not None:
            return known
        f = json.loads(pack)
        names, addresses = self.vocabularies
        name = self.number(0, (f["name"], *f["name_tokens"], None, *f["name_words"]), lambda: Text(f["name"], f["name_tokens"], [], f["name_words"], names))
        key = (f["address"], *f["address_tokens"], None, *f["numbers"], None, *f["address_words"])
        address = self.number(1, key, lambda: Text(f["address"], f["address_tokens"], f["numbers"], f["address_words"], addresses))
        codes, country = f["codes"], f.get("country")
        place = self.number(2, (country, *codes), lambda: (frozenset(codes), country))
        self.packs[pack] = found = (name, address, place, f["numeric"])
        return found

    def side(self, packs: pa.Array) -> tuple[np.ndarray, ...]:
        """By row: name, address, place, digit."""
        if self.held is not None:
            places = packs.to_numpy(zero_copy_only=False)
            for i in np.unique(places[self.table[places, 0] < 0]):
                self.table[i] = self.read(self.held[i])
            return tuple(self.table[places].T)
        known = packs.dictionary_encode()
        table = np.array([self.read(p) for p in known.dictionary.to_pylist()], np.int64).reshape(-1, 4)
        return tuple(table[known.indices.to_numpy(zero_copy_only=False)].T)

    def features(self, left: pa.Array, right: pa.Array) -> pa.StructArray:
        if len(self.packs) > MOST_KEPT:
            self.forget()
        a, b = self.side(left), self.side(right)
        tables = [distinct(a[kind], b[kind]) for kind in range(3)]
        name, address = (self.compare(kind, *tables[kind][:2]) for kind in (0, 1))
        place = self.places(*tables[2][:2])
        spread = lambda kind, columns: [c[tables[kind][2]] for c in columns]
        (nj, nl, nc, _), (aj, al, ac, an) = spread(0, name), spread(1, address)
        columns = [nj, nl, nc, aj, al, ac, an, (a[3] & b[3]).astype(float), *spread(2, place)]
        return pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in columns], list(FEATURE_NAMES))

    def compare(self, kind: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of distinct pairs of texts, in order of `a`: overlap of tokens, likeness of signs, cosine, overlap of numbers."""
        texts = self.parts[kind]
        left, right = [texts[i] for i in a.tolist()], [texts[i] for i in b.tolist()]
        numbers = np.zeros(len(a)) if kind == 0 else overlap([t.numbers for t in left], [t.numbers for t in right])
        return overlap([t.tokens for t in left], [t.tokens for t in right]), likeness(texts, a, b), cosines(texts, a, b), numbers

    def places(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        parts, rows = self.parts[2], []
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            (codes, country), (others, other) = parts[i], parts[j]
            both = country is not None and other is not None
            rows.append((not codes.isdisjoint(others), bool(codes) and bool(others), both and country == other, both))
        return tuple(np.array(rows, float).reshape(-1, 4).T)


def distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs in order, and the place of each row's pair among them."""
    wide = int(b.max()) + 1 if len(b) else 1
    found, at = np.unique(a * wide + b, return_inverse=True)
    return found // wide, found % wide, at


def overlap(a: list, b: list) -> np.ndarray:
    """Common members over all members of two sets; 0 where either is empty."""
    common = np.array([len(x & y) for x, y in zip(a, b, strict=True)], float)
    x, y = np.array([len(s) for s in a], float), np.array([len(s) for s in b], float)
    return np.divide(common, x + y - common, out=np.zeros(len(a)), where=(x > 0) & (y > 0))


def cosines(texts: list, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of the vectors, `a` in order: each left vector is laid out once and met by all its right ones."""
    sums = np.zeros(len(a))
    if not len(a):
        return sums
    used, at = np.unique(b, return_inverse=True)
    sizes = np.array([len(texts[i].places) for i in used])
    starts, places, weights = np.cumsum(sizes) - sizes, np.concatenate([texts[i].places for i in used]), np.concatenate([texts[i].weights for i in used])
    edges = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1], [True]]))
    lefts = [texts[a[i]] for i in edges[:-1]]
    dense = np.zeros(1 + max((int(x.max()) for x in (places, *(t.places for t in lefts)) if len(x)), default=0))
    for t, low, high in zip(lefts, edges[:-1], edges[1:], strict=True):
        if not len(t.places):
            continue
        counts, ends = sizes[at[low:high]], None
        ends = np.cumsum(counts)
        rows = np.arange(ends[-1]) + np.repeat(starts[at[low:high]] - ends + counts, counts)
        dense[t.places] = t.weights
        sums[low:high] = np.bincount(np.repeat(np.arange(high - low), counts), dense[places[rows]] * weights[rows], high - low)
        dense[t.places] = 0
    return sums


def likeness(texts: list, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 less the edit distance over the longer length; 0 where either text is empty."""
    m, n = np.array([len(texts[i].signs) for i in a.tolist()], np.int64), np.array([len(texts[i].signs) for i in b.tolist()], np.int64)
    found = np.zeros(len(a), np.int64)
    some = (m > 0) & (n > 0)
    for rows, x, y in ((some & (m <= BITS), a, b), (some & (m > BITS) & (n <= BITS), b, a)):
        if rows.any():
            found[rows] = distances(texts, x[rows], y[rows])
    for i in np.flatnonzero(some & (m > BITS) & (n > BITS)):
        found[i] = long_distance(texts[a[i]].signs, texts[b[i]].signs)
    return np.where(some, 1 - found / np.maximum(np.maximum(m, n), 1), 0.0)


def distances(texts: list, short: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Edit distances of texts of 1 to 64 signs to others, by words of bits (Myers), all rows at once."""
    lefts, of_left = np.unique(short, return_inverse=True)
    rights, of_right = np.unique(other, return_inverse=True)
    n_left, n_right = np.array([len(texts[i].signs) for i in lefts]), np.array([len(texts[i].signs) for i in rights])
    signs, codes = np.unique(np.concatenate([texts[i].signs for i in [*lefts, *rights]]), return_inverse=True)
    own = codes[: n_left.sum()]
    table = np.zeros((int(n_right.max()), len(rights)), np.int64)  # sign by place and text
    text_of = np.repeat(np.arange(len(rights)), n_right)
    table[np.arange(len(text_of)) - np.repeat(np.cumsum(n_right) - n_right, n_right), text_of] = codes[n_left.sum() :]
    own_left = np.repeat(np.arange(len(lefts)), n_left)
    bit = np.uint64(1) << (np.arange(len(own)) - np.repeat(np.cumsum(n_left) - n_left, n_left)).astype(np.uint64)
    out = np.zeros(len(short), np.int64)
    step = max(1, MOST_SIGNS // len(signs))
    for first in range(0, len(lefts), step):
        inside = (own_left >= first) & (own_left < first + step)
        equal = np.zeros((min(step, len(lefts) - first), len(signs)), np.uint64)
        np.bitwise_or.at(equal, (own_left[inside] - first, own[inside]), bit[inside])
        rows = np.flatnonzero((of_left >= first) & (of_left < first + step))
        rows = rows[np.argsort(-n_right[of_right[rows]], kind="stable")]  # the longest first, so rows that go on lie together
        out[rows] = swept(equal.reshape(-1), (of_left[rows] - first) * len(signs), n_left[of_left[rows]], table, of_right[rows], n_right[of_right[rows]])
    return out


def swept(equal: np.ndarray, base: np.ndarray, m: np.ndarray, table: np.ndarray, right: np.ndarray, n: np.ndarray) -> np.ndarray:
    one, top = np.uint64(1), (m - 1).astype(np.uint64)
    plus, minus, score = np.full(len(m), ~np.uint64(0)), np.zeros(len(m), np.uint64), m.copy()
    going = np.searchsorted(-n, -np.arange(1, n[0] + 1), side="right")  # rows of at least j + 1 signs
    for j, k in enumerate(going.tolist()):
        eq = equal[base[:k] + table[j, right[:k]]]
        pv, mv = plus[:k], minus[:k]
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv), pv & xh
        score[:k] += ((ph >> top[:k]) & one).astype(np.int64) - ((mh >> top[:k]) & one).astype(np.int64)
        ph = (ph << one) | one
        plus[:k], minus[:k] = (mh << one) | ~(xv | ph), ph & xv
    return score


def long_distance(a: np.ndarray, b: np.ndarray) -> int:
    """The edit distance of two texts, a row of the table at a time."""
    places = np.arange(len(b) + 1)
    row = places.copy()
    for i, sign in enumerate(a, 1):
        step = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (b != sign))])
        row = np.minimum.accumulate(step - places) + places  # insertions, from left to right
    return int(row[-1])


#: One reader for the vocabularies in use, in each worker.
_READERS: dict[tuple, Reader] = {}


def features_of(left: Column, right: Column, name: TfIdf | None, address: TfIdf | None, packs: Broadcast | None = None) -> Column:
    """A struct of the features of two packs, or of two places in `packs`. Both vocabularies must be shared ones."""
    held = (*(None if v is None else v.shared() for v in (name, address)), packs)
    key = tuple(None if h is None else h._jbroadcast.id() for h in held)

    def compared(a: pa.Array, b: pa.Array) -> pa.Array:
        from pairwright.functions import kernel

        if key not in kernel._READERS:
            kernel._READERS.clear()
            kernel._READERS[key] = kernel.Reader(*[None if h is None else h.value for h in held])
        return kernel._READERS[key].features(a, b)

    return F.arrow_udf(compared, SCHEMA)(left, right)

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairwright.functions import postal, text
from pairwright.functions.features import FEATURE_NAMES, feature_columns, record_features, with_vectors
from pairwright.functions.tfidf import TfIdf, dots, packed

RECORD = "entity_id string, name string, address string, country string, postal_codes array<string>"
STRASSE = ("Straße Textiles", "12 Gandhi Road", "India", ["AB-12"])
KUMAR = ("Kumar Shop", "45 Market Street", "France", ["600001"])


def grams(s):
    out = []
    for w in s.split():
        w = f" {w} "
        for n in (3, 4, 5):
            if n <= len(w):
                out += [w[i : i + n] for i in range(len(w) - n + 1)]
    return out


class Reference:
    """The features from their definitions, in plain Python."""

    def __init__(self, training):
        docs = [set(grams((t or "").casefold().strip())) for t in training]
        df = Counter(g for d in docs for g in d)
        self.idf = {g: math.log((1 + len(docs)) / (1 + n)) + 1 for g, n in df.items()}

    def vector(self, s):
        tf = Counter(g for g in grams(s) if g in self.idf)
        v = {g: n * self.idf[g] for g, n in tf.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {g: x / norm for g, x in v.items()} if norm else {}

    def cosine(self, a, b):
        a, b = self.vector(a), self.vector(b)
        return sum(x * b.get(g, 0) for g, x in a.items())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def expected(a, b, names, addresses):
    fold = lambda s: (s or "").casefold()
    lev = lambda x, y: 1 - distance(x, y) / max(len(x), len(y)) if x and y else 0.0
    na, nb, aa, ab = fold(a[0]).strip(), fold(b[0]).strip(), fold(a[1]).strip(), fold(b[1]).strip()
    numbers = lambda s: set(re.findall(r"\b\d+[a-z]?\b", fold(s)))
    codes = lambda r: {re.sub(r"[\s-]+", "", fold(c)) for c in r[3]} - {""}
    country = lambda s: " ".join(fold(s).split())
    return [
        jaccard(set(na.split()), set(nb.split())), lev(na, nb), names.cosine(na, nb),
        jaccard(set(re.findall(r"\w+", aa)), set(re.findall(r"\w+", ab))), lev(aa, ab), addresses.cosine(aa, ab),
        jaccard(numbers(a[1]), numbers(b[1])), int(bool(re.search(r"\d", a[1] or "") and re.search(r"\d", b[1] or ""))),
        int(bool(codes(a) & codes(b))), int(bool(codes(a) and codes(b))),
        int(bool(country(a[2])) and country(a[2]) == country(b[2])), int(bool(country(a[2]) and country(b[2]))),
    ]


def features(spark, pairs, training):
    records = spark.createDataFrame([(f"{i}{s}", *r) for i, p in enumerate(pairs) for s, r in zip("ab", p, strict=True)], RECORD)
    fit = spark.createDataFrame([(f"t{i}", *r) for i, r in enumerate(training)], RECORD)
    ready = with_vectors(record_features(records), TfIdf.fit(fit, "name"), TfIdf.fit(fit, "address")).withColumn("i", F.regexp_extract("entity_id", r"\d+", 0).cast("int"))
    packed = F.struct("f", "name_vector", "address_vector")
    left = ready.filter("entity_id like '%a'").select("i", packed.alias("left"))
    right = ready.filter("entity_id like '%b'").select("i", packed.alias("right"))
    return [list(r)[1:] for r in left.join(right, "i").select("i", *feature_columns()).orderBy("i").collect()]


def test_known_answers(spark):
    folded = ("strasse textiles", "12 gandhi road", "india", ["ab12"])
    none = (None, "", " ", [])
    unseen = ("zzzz", "qqqq", "x", [])
    got = features(spark, [(STRASSE, folded), (none, none), (unseen, STRASSE)], [STRASSE, KUMAR])
    assert got[0] == pytest.approx([1] * 12)
    assert got[1] == [0] * 12
    assert got[2][2] == got[2][5] == 0


def test_random_records_match_the_definitions(spark):
    rng = random.Random(3)
    words = ["Straße", "shop", "12a", "Road", "7", "गांधी", "A B", "x1y", "-", "123", "9b", "O'Neil", "ÉCOLE", "école"]
    some = lambda k: rng.choice(["", None, " "]) if rng.random() < 0.1 else " ".join(rng.choices(words, k=rng.randint(1, k)))
    record = lambda: (some(4), some(6), rng.choice(["India", " india ", None, "United  States", "united states"]), rng.choices(["AB-12", "ab 12", "600001", ""], k=rng.randint(0, 2)))
    pairs = [(record(), record()) for _ in range(120)]
    training = [record() for _ in range(30)]
    names, addresses = Reference([r[0] for r in training]), Reference([r[1] for r in training])
    for got, (a, b) in zip(features(spark, pairs, training), pairs, strict=True):
        assert got == pytest.approx(expected(a, b, names, addresses), abs=1e-9), (a, b, FEATURE_NAMES)


@pytest.mark.parametrize(("a", "b", "match", "available"), [
    ([], [], 0, 0), ([""], ["00123"], 0, 0), ([None, " - "], ["00123"], 0, 0), (["00123"], ["00123"], 1, 1),
    (["00123", "600001"], ["600001", "600002"], 1, 1), (["00123"], ["600001", "600002"], 0, 1),
    (["12345-6789"], ["123456789"], 1, 1), (["641 001"], ["641001"], 1, 1),
])
def test_postal_table(spark, a, b, match, available):
    row = spark.createDataFrame([(a, b)], "a array<string>, b array<string>").select(postal.code_set(F.col("a")).alias("a"), postal.code_set(F.col("b")).alias("b")).select(postal.codes_match(F.col("a"), F.col("b")), postal.codes_available(F.col("a"), F.col("b"))).first()
    assert list(row) == [match, available]


def test_postal_conflict_and_precedence(spark):
    rows = lambda scalar, codes: spark.createDataFrame([(scalar, codes)], "s string, c array<string>").select(postal.record_codes(F.col("s"), F.col("c"))).first()[0]
    assert rows("AB 12", ["ab-12"]) == ["ab12"]
    assert rows("AB 12", None) == ["ab12"]
    assert rows(None, []) == []
    with pytest.raises(Exception, match="conflicts"):
        rows("AB 12", ["x"])


def test_white_space_is_unicode(spark):
    row = spark.createDataFrame([(" \t a　b \x1f",)], "t string").select(text.strip(F.col("t")), text.pieces(F.col("t")), text.is_blank(F.lit("  \n"))).first()
    assert list(row) == ["a　b", ["a", "b"], True]


def test_empty_vocabulary_fails(spark):
    with pytest.raises(ValueError, match="n-grams"):
        TfIdf.fit(spark.createDataFrame([("a", " ", None, None, [])], RECORD), "name")


def test_exact_fold(spark):
    row = spark.createDataFrame([("ẞﬁ",)], "t string").select(text.exact_fold(F.col("t"))).first()
    assert row[0] == "ẞﬁ".casefold()


def test_dots_equal_plain_sums():
    rng = random.Random(3)
    made = [[{"k": k, "w": rng.random()} for k in sorted(rng.sample(range(-40, 40), rng.randrange(30)))] for _ in range(20)]
    vectors = packed(pa.array(made, pa.list_(pa.struct([("k", pa.int64()), ("w", pa.float64())])))).to_pylist()
    rows = [(rng.randrange(20), rng.randrange(20)) for _ in range(300)]
    a, b = (pa.array([None if n % m == 0 else vectors[r[side]] for n, r in enumerate(rows)], pa.binary()) for side, m in ((0, 7), (1, 11)))
    want = [0.0 if n % 7 == 0 or n % 11 == 0 else sum(x["w"] * y["w"] for x in made[i] for y in made[j] if x["k"] == y["k"]) for n, (i, j) in enumerate(rows)]
    assert dots(a, b).to_pylist() == pytest.approx(want) and dots(a[5:90], b[5:90]).to_pylist() == pytest.approx(want[5:90]) and len(dots(a[:0], b[:0])) == 0

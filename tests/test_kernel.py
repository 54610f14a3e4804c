"""The features in Arrow batches: equal to those as expressions, and only packs move with the pairs."""

import random

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from pairwright.functions import kernel, storage, tfidf
from pairwright.functions.features import FEATURE_NAMES
from pairwright.functions.text import SPACES, is_blank, strip
from pairwright.functions.tfidf import TfIdf
from pairwright.plans import queries, scoring, views
from pairwright.sources.lines import numbered_lines

LONG = "Gesellschaft mit beschränkter Haftung zu Groß-Gerau an der Straße der langen Namen und 12a "
TEXTS = ["Acme Ltd", "ACME  limited", "", None, "   ", "Straße 12b 7", "STRASSE 12B", "日本 株式会社 3", "x", LONG, LONG[5:] + LONG, LONG + "zwei", "a\tb 😀 4", "İstanbul 9 9a"]


def edit(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def odd_tables(spark):
    make = lambda n, k: (f"S{n}-{k}", TEXTS[k % len(TEXTS)], TEXTS[(k * n + 3) % len(TEXTS)], [None, "India", " france ", ""][k % 4], [[], ["1-2"], ["12", "A"], None][(k + n) % 4])
    records = spark.createDataFrame([make(n, k) for n in (1, 2, 3) for k in range(len(TEXTS))], "entity_id string, name string, address string, country string, postal_codes array<string>")
    ids = [(f"S1-{i}", f"S{n}-{j}") for i in range(len(TEXTS)) for n in (2, 3) for j in range(len(TEXTS))]
    return spark.createDataFrame(ids, "source1_entity_id string, candidate_entity_id string"), records


def test_batches_equal_expressions(spark, monkeypatch):
    pairs, records = odd_tables(spark)
    half = records.filter("entity_id LIKE '%2' OR entity_id LIKE '%5'")
    rows = []
    for most in (tfidf.MOST_SHARED, -1):
        monkeypatch.setattr(tfidf, "MOST_SHARED", most)
        names, addresses = TfIdf.fit(half, "name"), TfIdf.fit(half, "address")
        assert (names.shared() is None) == (most < 0)
        found = scoring.featurize(pairs, records, names, addresses)
        rows.append({r[:2]: r[2:] for r in found.select("source1_entity_id", "candidate_entity_id", *FEATURE_NAMES).collect()})
    assert rows[0].keys() == rows[1].keys() and len(rows[0]) == pairs.count()
    for k, v in rows[0].items():
        assert v == pytest.approx(rows[1][k], abs=1e-12), k


def test_edit_distances_of_any_length(monkeypatch):
    draw = random.Random(3)
    made = ["".join(draw.choices("ab é😀", k=n)) for n in [*range(1, 12), 63, 64, 65, 66, 130, 131] for _ in range(3)]
    texts = [kernel.Text(t, [], [], [], None) for t in made]
    a, b = (m.ravel() for m in np.meshgrid(range(len(texts)), range(len(texts)), indexing="ij"))
    want = [1 - edit(made[i], made[j]) / max(len(made[i]), len(made[j])) for i, j in zip(a, b, strict=True)]
    assert np.allclose(kernel.likeness(texts, a, b), want)
    monkeypatch.setattr(kernel, "MOST_SIGNS", 12)  # a few texts at a time
    assert np.allclose(kernel.likeness(texts, a, b), want)


def test_a_reader_forgets_and_reads_again(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(kernel, "MOST_KEPT", 2)
    pack = lambda n: '{"name":"%s","name_tokens":["%s"],"address":"","address_tokens":[],"numbers":[],"numeric":false,"codes":[],"name_words":[],"address_words":[]}' % (n, n)
    reader, names = kernel.Reader(None, None), ["a", "b", "c", "a", "d"]
    for _ in range(3):
        got = reader.features(pa.array(map(pack, names)), pa.array([pack("a")] * 5))
        assert got.field("name_token_jaccard").to_pylist() == [1, 0, 0, 1, 0]


def test_pairs_move_without_vectors(spark):
    """Vectors aren't even made, so nothing beside packs is copied a pair."""
    text = queries.QUERIES["score_pairs"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in text and "_vector" not in text


def test_labelled_pairs_are_not_joined_by_row(spark):
    """Sides of pairs come by content; a pair isn't shuffled to meet its own records."""
    names = TfIdf.fit(spark.createDataFrame([("ab cd",)], "name string"), "name")
    from pairwright.plans.training import synthetic_pairs

    rows = scoring.pairs_score(synthetic_pairs(spark), queries.DEMO, names, names)
    assert "row_index" not in "".join(line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line)
    assert rows.count() == 40


def test_a_report_makes_scores_once(spark):
    from pairwright.operators import metrics

    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def scored(k):
        made.add(1)
        return k / 40

    report = metrics.evaluate(spark.range(40).select((F.col("id") % 2).cast("int").alias("label"), scored("id").alias("probability")))
    assert report["count"] == 40 and report["positives"] == 20 and made.value == 40


def test_blank_is_what_strip_empties(spark):
    rows = spark.createDataFrame([(t,) for t in [*TEXTS, "\x1c　", "\n", "​", " .\n"]], "t string")
    assert all(r.a == r.b for r in rows.select(is_blank(F.col("t")).alias("a"), F.coalesce(strip(F.col("t")) == "", F.lit(True)).alias("b")).collect())
    assert "^[" not in rows.select(is_blank(F.col("t")))._jdf.queryExecution().analyzed().toString() and SPACES


@pytest.mark.parametrize("blanks", [(), (3, 4, 950), (0, 999)])
def test_lines_are_numbered_in_their_tasks(spark, tmp_path, blanks):
    lines = ["  " if i in blanks else f"line {i} " + "x" * (i % 7) for i in range(1000)]
    for part, (low, high) in enumerate([(0, 400), (400, 401), (401, 1000)]):
        (tmp_path / f"part-{part}.txt").write_text("".join(f"{t}\n" for t in lines[low:high]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        found = numbered_lines(spark, str(tmp_path))
        got = sorted((r.line_no, r.filled_no, r.value) for r in found.collect())
        want, filled = [], 0
        for n, t in enumerate(lines, 1):
            want.append((n, filled, t))
            filled += bool(t.strip())
        assert got == want
        if not blanks:  # no line is shuffled
            assert not any(node.strip(" :+-").startswith("Exchange") and "value" in node for node in found._jdf.queryExecution().executedPlan().toString().splitlines())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("rows", [1, 40])
def test_order_is_that_of_partitions(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(storage, "ROWS", rows)
    numbers = list(range(0, 3000, 7)) * 2 + [5] * 300
    random.Random(1).shuffle(numbers)
    table = spark.createDataFrame([(n, i) for i, n in enumerate(numbers)], "n long, i long").repartition(5)
    found = storage.in_order(table, "n", "i")
    assert [tuple(r) for r in found.collect()] == sorted((n, i) for i, n in enumerate(numbers))
    assert found.rdd.getNumPartitions() > 1 and "rangepartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    assert storage.in_order(table.limit(0), "n", "i").collect() == []
    monkeypatch.setattr(storage, "ROWS", 1)
    spark.conf.set("spark.sql.shuffle.partitions", "200")  # more cuts than one step
    try:
        assert [r.n for r in storage.in_order(table, "n", "i").collect()] == sorted(numbers)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")

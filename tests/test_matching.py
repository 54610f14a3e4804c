"""Joins, labels, splits, sampling, preparation, on the small fixtures."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pairwright.functions.checks import InputError
from pairwright.operators import audits, joins, sampling
from pairwright.operators.candidates import batches, with_row_index
from pairwright.operators.records import all_records, ml_pairs
from pairwright.plans.preparation import estimate_memory, prepare_training_data
from pairwright.sources.candidates import read_candidates
from pairwright.sources.truth import read_split, truth_frame

RAW = "entity_id string, business_name_normalized string, business_address_normalized string, country_normalized string, postal_codes string"


def table(spark, rows):
    return spark.createDataFrame(rows, RAW)


@pytest.fixture(scope="module")
def small(spark):
    s1 = table(spark, [("S1-001", "alpha shop", "12 road", "india", "600001 600002"), ("S1-002", "", "  ", None, "")])
    s2 = table(spark, [("S2-001", "alpha shop", "12 road", "india", "600002")])
    s3 = table(spark, [("S3-001", "other shop", "1 street", "france", "00123")])
    pairs = spark.createDataFrame([(0, "p-validation", "S1-002", "S3-001", "source3"), (1, "p-positive", "S1-001", "S2-001", "source2"), (2, "p-negative", "S1-001", "S3-001", "source3")], "row_index long, pair_id string, source1_entity_id string, candidate_entity_id string, candidate_source string")
    split = read_split(spark, {"train_source1_entity_ids": ["S1-001"], "validation_source1_entity_ids": ["S1-002"]})
    truth = truth_frame(spark, {"S1-001": {"S2-001"}, "S1-002": set()})
    return all_records(s1, s2, s3), pairs, split, truth


def test_join_labels_and_partitions(small):
    records, pairs, split, truth = small
    joined = joins.join_candidates(pairs, records, split, truth, require_labels=True)
    rows = joined.orderBy("row_index").collect()
    assert [r.label for r in rows] == [0, 1, 0]
    assert [r.source1.name for r in rows] == [None, "alpha shop", "alpha shop"]
    train, valid = joins.partition_candidates(joined)
    assert [r.pair_id for r in train.orderBy("row_index").collect()] == ["p-positive", "p-negative"]
    assert [r.pair_id for r in valid.collect()] == ["p-validation"]


def test_broken_joins_fail_whole(spark, small):
    records, pairs, split, truth = small
    cases = [
        (dict(records=records.filter("entity_id <> 'S3-001'")), "Missing record join: S3-001"),
        (dict(truth=truth.filter("source1_entity_id <> 'S1-002'")), "coverage for S1-002"),
        (dict(split=split.filter("source1_entity_id <> 'S1-002'")), "No saved split assignment for S1-002"),
        (dict(pairs=pairs.selectExpr("*", "1 AS label")), "conflicts with ground truth"),
        (dict(pairs=pairs.selectExpr("*", "'train' AS split")), "conflicts with saved split"),
    ]
    for change, message in cases:
        args = dict(pairs=pairs, records=records, split=split, truth=truth) | change
        with pytest.raises(InputError, match=message):
            joins.join_candidates(**args)
    with pytest.raises(InputError, match="Labeled candidates"):
        joins.join_candidates(pairs, records, split, require_labels=True)


def test_postal_policy(small):
    records, pairs, split, truth = small
    joined = joins.join_candidates(pairs, records, split, truth)
    masked = ml_pairs(joined, mask_multiple_codes=True).orderBy("row_index").collect()
    assert [r.source1.postal_code for r in masked] == [None, None, None]
    assert [r.source2.postal_code for r in masked] == ["00123", "600002", "00123"]
    kept = ml_pairs(joined, collection_aware=True).orderBy("row_index").collect()
    assert kept[1].source1.postal_codes == ["600001", "600002"] and kept[1].source1.postal_code is None
    with pytest.raises(Exception, match="multiple postal codes"):
        ml_pairs(joined).collect()
    with pytest.raises(ValueError, match="both"):
        ml_pairs(joined, True, True)


def test_duplicate_records_fail(spark):
    one = table(spark, [("S1-1", "a", "b", "c", "")])
    none = table(spark, [])
    with pytest.raises(InputError, match="duplicate S1-1"):
        all_records(one.union(one), none, none)
    with pytest.raises(InputError, match="Invalid ID"):
        all_records(none, one, none)


def runs_of(spark, groups):
    """groups: (entity, split, positives, negatives) in order."""
    rows = []
    for line, (entity, split, pos, neg) in enumerate(groups):
        labels = [1] * pos + [0] * neg
        random.Random(line).shuffle(labels)
        rows += [(line, k, line * 1000 + k, f"{entity}::{line}-{k}", entity, y, split) for k, y in enumerate(labels)]
    return spark.createDataFrame(rows, "source1_row_index long, candidate_rank int, row_index long, pair_id string, source1_entity_id string, label int, split string")


def python_sample(rows, ratio, zero, seed):
    """The sampler from its definition, run by run."""
    out, group = [], []

    def close():
        if not group:
            return
        if group[0].split == "validation" or ratio is None:
            out.extend(group)
            return
        neg = [r for r in group if r.label == 0]
        pos = len(group) - len(neg)
        want = pos * ratio if pos else zero
        kept = neg if len(neg) <= want else [neg[i] for i in sorted(random.Random(f"{seed}-{group[0].source1_entity_id}").sample(range(len(neg)), want))]
        ids = {r.pair_id for r in kept}
        out.extend(r for r in group if r.label == 1 or r.pair_id in ids)

    for r in rows:
        if group and group[0].source1_entity_id != r.source1_entity_id:
            close()
            group = []
        group.append(r)
    close()
    return [r.pair_id for r in out]


GROUPS = [("S1-a", "train", 3, 30), ("S1-b", "validation", 1, 49), ("S1-c", "train", 0, 40), ("S1-a", "train", 0, 9), ("S1-a", "train", 1, 4), ("S1-d", "train", 2, 3)]


@pytest.mark.parametrize(("ratio", "zero", "seed"), [(2, 7, 42), (1, 0, 7), (None, 10, 42), (10, 10, 1)])
def test_exact_sampler_draws_as_python_does(spark, ratio, zero, seed):
    pairs = sampling.entity_runs(runs_of(spark, GROUPS))
    got = [r.pair_id for r in sampling.sample_exact(pairs, ratio, zero, seed).orderBy("row_index").collect()]
    assert got == python_sample(pairs.orderBy("row_index").collect(), ratio, zero, seed)


def test_hashed_sampler_keeps_the_same_counts(spark):
    pairs = sampling.entity_runs(runs_of(spark, GROUPS))
    exact, hashed = (f(pairs, 2, 7).groupBy("run", "label").count().collect() for f in (sampling.sample_exact, sampling.sample_hashed))
    assert sorted(exact) == sorted(hashed)


def test_sampler_rejects_what_it_must(spark):
    for ratio, zero in ((0, 1), (1.5, 1), (1, -1), (True, 1)):
        with pytest.raises(ValueError):
            sampling.sample_hashed(None, ratio, zero)
    pairs = sampling.entity_runs(runs_of(spark, [("S1-a", "train", 1, 1)])).withColumn("label", __import__("pyspark").sql.functions.lit(None).cast("int"))
    with pytest.raises(Exception, match="Unlabeled candidate"):
        sampling.sample_hashed(pairs).collect()


def test_runs_are_not_keys(spark):
    rows = sampling.entity_runs(runs_of(spark, GROUPS)).orderBy("row_index").collect()
    by_line = defaultdict(set)
    for r in rows:
        by_line[r.source1_row_index].add(r.run)
    assert [len(by_line[i]) for i in range(6)] == [1] * 6
    assert len({tuple(v) for v in by_line.values()}) == 5
    assert by_line[3] == by_line[4]


CANDIDATES = ["S1-001\tS2-001,S2-002,S3-003,S2-004,S3-005,S2-006", "S1-002\tS3-001,S3-002,S2-005,S3-006,S2-007,S3-008", "S1-003\tS2-003,S2-001,S3-001", "S1-004\tS2-002,S3-002,S3-003"]


def prepared(spark, **options):
    record = lambda i: (i, f"name {i}", f"{i[-1]} road", "india", "")
    s1, s2, s3 = (table(spark, [record(f"S{s}-00{i}") for i in ids]) for s, ids in ((1, range(1, 5)), (2, range(1, 8)), (3, range(1, 9))))
    split = read_split(spark, {"train_source1_entity_ids": ["S1-001", "S1-002"], "validation_source1_entity_ids": ["S1-003", "S1-004"]})
    truth = truth_frame(spark, {"S1-001": {"S2-001"}, "S1-002": {"S3-001", "S3-002"}, "S1-003": {"S2-003"}, "S1-004": set()})
    return prepare_training_data(spark, CANDIDATES, all_records(s1, s2, s3), split, truth, negative_ratio=2, **options)


def test_preparation_counts(spark, tmp_path):
    report = prepared(spark, out=str(tmp_path / "out"))
    raw, kept = report["raw_candidates"], report["prepared_candidates"]
    assert (raw["total"], raw["train"]["positives"], raw["train"]["negatives"], raw["validation"]["positives"], raw["validation"]["negatives"]) == (18, 3, 9, 1, 5)
    assert (report["total_pairs_written"], kept["train"]["positives"], kept["train"]["negatives"], kept["train"]["dropped_negatives"]) == (15, 3, 6, 3)
    assert spark.read.text(str(tmp_path / "out")).count() == 15
    assert report["output_sha256"] == prepared(spark, out=str(tmp_path / "again"))["output_sha256"]
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        prepared(spark, out=str(tmp_path / "out"))


def test_dry_run_writes_nothing(spark, tmp_path):
    report = prepared(spark, dry_run=True)
    assert report["mode"] == "dry_run" and report["output_path"] is None and report["total_pairs_written"] == 15
    with pytest.raises(ValueError, match="output path"):
        prepared(spark)


def test_memory_estimate():
    small, large = estimate_memory(100, 50), estimate_memory(6_000_000, 2_000_000)
    assert small["status"] == "SAFE" and small["identified_bottlenecks"] == []
    assert large["status"] == "UNSAFE_EXCEEDS_16GB" and len(large["identified_bottlenecks"]) == 3


def test_batches_are_bounded(spark):
    pairs = with_row_index(read_candidates(spark, CANDIDATES))
    assert [r.rows for r in batches(pairs, 7).orderBy("batch").collect()] == [7, 7, 4]
    with pytest.raises(ValueError):
        batches(pairs, 0)


def test_batches_take_the_number_of_pairs_alone(spark):
    pairs = spark.range(10_001).select(F.col("id").alias("source1_row_index"), F.lit(0).alias("candidate_rank"), F.lit(None).cast("string").alias("source1_entity_id"))
    rows = batches(pairs, 2).orderBy("batch").collect()
    assert len(rows) == 5_001 and tuple(rows[-1]) == (5_000, 1, 10_000, 10_000) and all(tuple(r) == (k, 2, 2 * k, 2 * k + 1) for k, r in enumerate(rows[:-1]))
    assert batches(pairs.limit(0), 2).count() == 0
    assert "Window" not in batches(pairs, 2)._jdf.queryExecution().toString()


def test_recall(spark):
    truth = spark.createDataFrame([("S1-001", "S2-001"), ("S1-001", "S2-999")], "source1_entity_id string, candidate_entity_id string")
    pairs = read_candidates(spark, CANDIDATES)
    assert audits.missed_matches(truth, pairs).collect()[0].candidate_entity_id == "S2-999"
    assert list(audits.recall(truth, pairs).first()) == [2, 1, 0.5]

"""Splits, metrics, trees, training, scoring, streams."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairwright.functions.checks import InputError
from pairwright.functions.features import FEATURE_NAMES
from pairwright.operators import audits, metrics
from pairwright.operators.splits import group_split
from pairwright.plans.ensemble import Ensemble, Tree
from pairwright.plans.mapping import InputMapping, default_mapping, predict_file
from pairwright.plans.queries import DEMO
from pairwright.plans.training import PairModel, TrainingConfig, synthetic_pairs, train_classifier

CONSTANT = "tree\nversion=v4\nobjective=binary sigmoid:1\nfeature_names=" + " ".join(FEATURE_NAMES) + "\n\nTree=0\nnum_leaves=1\nnum_cat=0\nsplit_feature=\nthreshold=\nleft_child=\nright_child=\nleaf_value=0\n\nend of trees\n"


def scored(spark, labels, probabilities):
    return spark.createDataFrame(list(zip(labels, probabilities, strict=True)), "label int, probability double")


def test_metrics(spark):
    assert metrics.evaluate(scored(spark, [0, 0], [0.1, 0.2]))["brier_score"] == pytest.approx(0.025)
    one = metrics.evaluate(scored(spark, [0, 0], [0.1, 0.2]))
    assert one["roc_auc"] is None and one["average_precision"] is None
    half = metrics.evaluate(scored(spark, [0, 1] * 4, [0.5] * 8))
    assert [half[k] for k in ("log_loss", "brier_score", "roc_auc", "average_precision")] == pytest.approx([0.6931471805599453, 0.25, 0.5, 0.5])
    for labels, p, message in (([], [], "nonempty"), ([2], [0.5], "Invalid"), ([1], [float("nan")], "Invalid"), ([1], [1.5], r"\[0, 1\]")):
        with pytest.raises(InputError, match=message):
            metrics.evaluate(scored(spark, labels, p))


def test_ranking_metrics_match_brute_force(spark):
    rng = np.random.default_rng(5)
    y, p = rng.integers(0, 2, 300), rng.integers(0, 40, 300) / 39
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    ap, last = 0.0, 0
    for t in sorted(set(p), reverse=True):
        hit = int(((p >= t) & (y == 1)).sum())
        ap += (hit - last) / len(pos) * hit / (p >= t).sum()
        last = hit
    got = metrics.evaluate(scored(spark, y.tolist(), p.tolist()))
    assert (got["roc_auc"], got["average_precision"]) == pytest.approx((auc, ap))


def test_group_split_of_the_synthetic_set(spark):
    pairs = synthetic_pairs(spark).withColumnRenamed("source1_id", "source1_entity_id")
    valid = {r[0] for r in group_split(pairs).filter("split = 'validation'").select("source1_entity_id").collect()}
    assert valid == {"s1-0", "s1-1", "s1-5", "s1-7"}


def test_trees_read_write_and_agree(spark):
    assert spark.range(1).select(Ensemble.from_text(CONSTANT).probability([F.lit(0.0)] * 12)).first()[0] == 0.5
    again = Ensemble.from_text(DEMO.to_text())
    assert again == DEMO
    rng = np.random.default_rng(1)
    x = rng.random((50, 12))
    frame = spark.createDataFrame([[i, *map(float, r)] for i, r in enumerate(x)], ["i", *FEATURE_NAMES])
    small = [r[0] for r in frame.orderBy("i").select(DEMO.probability()).collect()]
    large = Ensemble(FEATURE_NAMES, DEMO.trees + [Tree([0.0])] * 400)
    assert [r[0] for r in frame.orderBy("i").select(large.probability()).collect()] == pytest.approx(small)
    with pytest.raises(ValueError, match="Categorical"):
        Ensemble.from_text(CONSTANT.replace("num_cat=0", "num_cat=1"))


def test_config_bounds():
    for bad in (dict(num_leaves=1), dict(learning_rate=0), dict(learning_rate=float("nan")), dict(random_state=-1), dict(validation_fraction=1), dict(num_boost_round=True)):
        with pytest.raises(ValueError):
            TrainingConfig(**bad)


@pytest.fixture(scope="module")
def trained(spark):
    return train_classifier(synthetic_pairs(spark, 60), TrainingConfig(num_boost_round=5), data_kind="synthetic")


def test_training_report_and_round_trip(spark, trained, tmp_path):
    report = trained.report
    assert report["train_pairs"] + report["validation_pairs"] == 120
    assert report["validation_metrics"]["roc_auc"] == 1.0
    trained.save(str(tmp_path / "m"))
    model = PairModel.load(spark, str(tmp_path / "m"))
    again = model.score_pairs(synthetic_pairs(spark, 60)).orderBy("row_index").select("probability").collect()
    assert again == trained.model.score_pairs(synthetic_pairs(spark, 60)).orderBy("row_index").select("probability").collect()
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        trained.save(str(tmp_path / "m"))


def test_the_query_trains_on_all_pairs_with_the_defaults(spark, monkeypatch):
    from dataclasses import replace

    from conftest import SMALL

    from pairwright.plans import queries, training, views

    asked, real = [], training.train_classifier

    def one_round(pairs, config=None, **more):
        asked.append((config, pairs.count()))
        return real(pairs, replace(config, num_boost_round=1), **more)

    monkeypatch.setattr(training, "train_classifier", one_round)
    got = [r.pair_id for r in queries.QUERIES["train_and_score"](spark, SMALL).collect()]
    every = views.labelled(spark, SMALL)
    assert asked == [(TrainingConfig(), every.count())]
    assert sorted(got) == sorted(r.pair_id for r in every.filter("split = 'validation'").collect())
    assert any("::S3-" in p for p in got)


def test_training_rejects(spark):
    pairs = synthetic_pairs(spark, 6)
    with pytest.raises(ValueError, match="saved_split"):
        train_classifier(pairs.withColumn("split", F.lit("train")))
    with pytest.raises(InputError, match="Duplicate"):
        train_classifier(pairs.union(pairs))
    with pytest.raises(ValueError, match="both classes"):
        train_classifier(pairs.filter("label = 1"))
    with pytest.raises(InputError, match="Labels"):
        train_classifier(pairs.withColumn("label", F.lit(3)))


def test_vocabulary_comes_from_training_records_alone(trained):
    valid = {"s1-" + str(i) for i in range(60)} - {r.source1_id for r in trained.validation_predictions.select("source1_id").distinct().collect()}
    assert trained.model.name.records == 2 * len(valid) + len(valid)


def test_inconsistent_records(spark):
    pairs = synthetic_pairs(spark, 3)
    moved = pairs.withColumn("source1_id", F.lit("s1-x"))
    assert audits.inconsistent_records(moved).select("side", "entity_id", "versions").collect() == [(1, "s1-x", 3)]


def test_fingerprint_is_the_hash_of_the_json(spark):
    import hashlib

    pairs = synthetic_pairs(spark, 2)
    keys = ("name", "address", "postal_code", "country")
    rows = [r.asDict(True) for r in pairs.orderBy("row_index").collect()]
    facts = [{k: r[k] for k in ("pair_id", "source1_id", "source2_id", "label")} | {s: {k: r[s][k] for k in keys} for s in ("source1", "source2")} for r in rows]
    assert audits.input_fingerprint(pairs, keys) == hashlib.sha256(json.dumps(facts, sort_keys=True).encode()).hexdigest()
    assert audits.distributed_fingerprint(pairs).collect() == audits.distributed_fingerprint(pairs.orderBy(F.desc("row_index"))).collect()


def nested(i, source="S2", **changes):
    r = {"name": f"shop {i}", "address": "1 road", "postal_code": "1", "country": None}
    return json.dumps({"pair_id": f"p{i}", "source1_id": "a", "target_id": f"t{i % 2}", "target_source": source, "source1": r | {"name": "shop"}, "target": r} | changes)


def test_predict_file(spark, trained, tmp_path):
    lines = [nested(0), "", nested(1), nested(2, "S3", target={"name": None, "address": None, "postal_code": None, "country": None})]
    assert predict_file(spark, lines, default_mapping(), trained.model, str(tmp_path / "o")) == 3
    rows = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "o")).collect()]
    assert [r["pair_id"] for r in rows] == ["p0", "p1", "p2"] and all(0 <= r["probability"] <= 1 for r in rows)
    with pytest.raises(InputError, match="Missing mapped input path"):
        predict_file(spark, [json.dumps({"pair_id": "p"})], default_mapping(), trained.model, str(tmp_path / "n"))
    with pytest.raises(InputError, match="Duplicate"):
        predict_file(spark, [nested(0), nested(0)], default_mapping(), trained.model, str(tmp_path / "n"))
    assert not (tmp_path / "n").exists()


def test_mapping_rules():
    fields = {k: None for k in ("name", "address", "postal_code", "country")}
    good = dict(pair_id=["p"], source1_id=["s"], target_id=["t"], source1_fields=fields, target_fields=fields)
    InputMapping(**good, target_source_value="S2")
    for bad in ({}, dict(target_source=["x"], target_source_value="S2"), dict(target_source_value="S4"), dict(target_source=[""]), dict(target_source_value="S2", source1_fields={})):
        with pytest.raises(ValueError):
            InputMapping(**(good | bad))


def test_stream_scores_each_pair_once(spark, tmp_path):
    from pairwright.operators.records import all_records
    from pairwright.streaming.scoring import score_stream

    raw = "entity_id string, business_name_normalized string, business_address_normalized string, country_normalized string, postal_codes string"
    table = lambda s: spark.createDataFrame([(f"S{s}-{i}", f"shop {i}", "1 road", "x", "1") for i in range(4)], raw)
    records = all_records(table(1), table(2), table(3))
    source = tmp_path / "in"
    source.mkdir()
    row = lambda s1, c, k: json.dumps({"source1_entity_id": s1, "candidate_entity_id": c, "source1_row_index": k, "candidate_rank": 0})
    go = lambda: score_stream(spark, str(source), records, DEMO, str(tmp_path / "out"), str(tmp_path / "ck"), files_a_batch=1)
    (source / "a.json").write_text(row("S1-0", "S2-0", 0))
    (source / "b.json").write_text(row("S1-1", "S3-1", 1))
    go().awaitTermination()
    assert {r.pair_id for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"S1-0::S2-0", "S1-1::S3-1"}
    (source / "c.json").write_text(row("S1-0", "S2-0", 2))
    with pytest.raises(Exception, match="duplicate candidate pair S1-0::S2-0"):
        go().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_score_file_keeps_order(spark, tmp_path):
    from pairwright.operators.records import all_records
    from pairwright.plans.scoring import score_file
    from pairwright.sources.truth import read_split

    raw = "entity_id string, business_name_normalized string, business_address_normalized string, country_normalized string, postal_codes string"
    table = lambda s: spark.createDataFrame([(f"S{s}-{i}", f"shop {i}", "1 road", "x", "1 2") for i in range(4)], raw)
    split = read_split(spark, {"train_source1_entity_ids": ["S1-1"], "validation_source1_entity_ids": ["S1-0"]})
    n = score_file(spark, ["S1-1\tS3-2,S2-1", "S1-0\tS2-3"], all_records(table(1), table(2), table(3)), split, DEMO, str(tmp_path / "o"))
    rows = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "o")).collect()]
    assert n == 3 and [(r["pair_id"], r["source1_row_index"], r["candidate_rank"]) for r in rows] == [("S1-1::S3-2", 0, 0), ("S1-1::S2-1", 0, 1), ("S1-0::S2-3", 1, 0)]


RAW = "entity_id string, business_name_normalized string, business_address_normalized string, country_normalized string, postal_codes string"


def shop_records(spark):
    from pairwright.operators.records import all_records

    return all_records(*[spark.createDataFrame([(f"S{s}-{i}", f"shop {i}", "1 road", "x", "1") for i in range(4)], RAW) for s in (1, 2, 3)])


def test_a_pair_without_its_record_is_never_dropped(spark, tmp_path):
    from pairwright.operators.candidates import enrich, with_row_index
    from pairwright.plans.scoring import score
    from pairwright.sources.truth import read_split
    from pairwright.streaming.scoring import scored_batch

    records = shop_records(spark)
    batch = lambda *rows, more="": spark.createDataFrame([(s1, c, k, 0, *x) for k, (s1, c, *x) in enumerate(rows)], "source1_entity_id string, candidate_entity_id string, source1_row_index long, candidate_rank int" + more)
    good, bad = batch(("S1-0", "S2-0"), ("S1-1", "S3-1")), batch(("S1-0", "S2-0"), ("S1-1", "S3-9"))
    assert scored_batch(good, records, DEMO, None).count() == 2
    with pytest.raises(InputError, match="Missing record join: S3-9"):
        scored_batch(bad, records, DEMO, None)
    with pytest.raises(Exception, match="Missing record join: S3-9"):
        score(enrich(with_row_index(bad)), records, DEMO).collect()
    split = read_split(spark, {"train_source1_entity_ids": ["S1-0"], "validation_source1_entity_ids": []})
    with pytest.raises(InputError, match="No saved split assignment for S1-1"):
        scored_batch(good, records, DEMO, None, split=split)
    both = read_split(spark, {"train_source1_entity_ids": ["S1-0"], "validation_source1_entity_ids": ["S1-1"]})
    truth = spark.createDataFrame([("S1-0", ["S2-0"]), ("S1-1", [])], "source1_entity_id string, matched array<string>")
    assert scored_batch(good, records, DEMO, None, split=both, truth=truth, require_labels=True).count() == 2
    for row, message in ((("S1-1", "S3-1", 1, None), "label conflicts"), (("S1-1", "S3-1", None, "train"), "split assignment conflicts"), (("S1-2", "S3-1", None, None), "No saved split")):
        with pytest.raises(InputError, match=message):
            scored_batch(batch(("S1-0", "S2-0", 1, None), row, more=", label int, split string"), records, DEMO, None, split=both, truth=truth)


def test_unsupported_trees_raise(spark):
    one = CONSTANT.replace("num_leaves=1", "num_leaves=2").replace("split_feature=\n", "split_feature=0\n").replace("threshold=\n", "threshold=0.5\ndecision_type={}\n").replace("left_child=\n", "left_child=-1\n").replace("right_child=\n", "right_child=-2\n").replace("leaf_value=0", "leaf_value=-1 1\nis_linear=0")
    for kind in (0, 2, 8, 10):
        assert Ensemble.from_text(one.replace("{}", str(kind))).trees[0].threshold == [0.5]
    for text, message in ((one.replace("{}", "1"), "Categorical"), (one.replace("{}", "6"), "zero as missing"), (one.replace("{}", "2").replace("is_linear=0", "is_linear=1"), "Linear")):
        with pytest.raises(ValueError, match=message):
            Ensemble.from_text(text)


def test_trees_keep_to_num_leaves(spark):
    rng = np.random.default_rng(3)
    rows = [(f"p{i}", f"a{i % 40}", f"b{i}", int(rng.integers(0, 2))) for i in range(400)]
    word = lambda: F.concat(F.lit("w"), (F.rand(7) * 9).cast("int"), F.lit(" x"), (F.rand(8) * 30).cast("int"))
    record = F.struct(word().alias("name"), word().alias("address"), F.lit("1").alias("postal_code"), F.lit("x").alias("country"), F.lit(None).cast("array<string>").alias("postal_codes"))
    pairs = spark.createDataFrame(rows, "pair_id string, source1_id string, source2_id string, label int").withColumn("row_index", F.substring("pair_id", 2, 9).cast("long")).withColumn("source2", record).withColumn("split", F.lit(None).cast("string"))
    fixed = F.struct(F.lit("w1 x2").alias("name"), F.lit("w3 x4").alias("address"), F.lit("1").alias("postal_code"), F.lit("x").alias("country"), F.lit(None).cast("array<string>").alias("postal_codes"))
    pairs = spark.createDataFrame(pairs.withColumn("source1", fixed).collect(), pairs.withColumn("source1", fixed).schema)
    model = train_classifier(pairs, TrainingConfig(num_boost_round=3, num_leaves=5, min_data_in_leaf=2)).model
    sizes = [len(t.leaf_value) for t in model.ensemble.trees]
    assert max(sizes) == 5 and all(len(t.split_feature) == len(t.leaf_value) - 1 for t in model.ensemble.trees)
    assert Ensemble.from_text(model.ensemble.to_text()) == model.ensemble


def test_prefix_sums_of_many_blocks(spark):
    from pairwright.operators import blocks

    rng = np.random.default_rng(2)
    at = sorted(rng.choice(60_000, 900, replace=False).tolist())
    sums = spark.createDataFrame([(int(b), int(b) % 7, f"v{b}") for b in at], "b long, n long, v string")
    got = {r.b: r.s for r in blocks.starts(sums, "b", "n", "s").collect()}
    assert got == {b: sum(x % 7 for x in at[:i]) for i, b in enumerate(at)}
    before = {r.b: r.p for r in blocks.previous(sums, "b", F.col("v"), "p").collect()}
    assert before == {b: f"v{at[i - 1]}" if i else None for i, b in enumerate(at)}


def test_a_dealt_batch_is_not_moved(spark):
    """Pairs of a batch that lie by entity are scored where they lie, with the batches before in view, and doubles still fail."""
    from pairwright.streaming.scoring import scored_batch

    records = shop_records(spark)
    table = lambda *rows: spark.createDataFrame([(s1, c, k, 0) for k, (s1, c) in enumerate(rows)], "source1_entity_id string, candidate_entity_id string, source1_row_index long, candidate_rank int")
    batch = table(("S1-0", "S2-0"), ("S1-1", "S3-1"), ("S1-1", "S2-1")).repartition(3, "source1_entity_id").cache()
    split = spark.createDataFrame([("S1-0", "train"), ("S1-1", "validation")], "source1_entity_id string, split string")
    seen = table(("S1-1", "S3-0"), ("S1-2", "S2-0"))
    scores = scored_batch(batch, records, DEMO, seen, split=split)
    plan = [line.strip(" :+-") for line in scores._jdf.queryExecution().executedPlan().toString().splitlines()]
    above = plan[: next(i for i, node in enumerate(plan) if node.startswith("InMemoryTableScan"))]
    assert scores.count() == 3 and not any(node.startswith(("Exchange", "Sort")) for node in above)
    with pytest.raises(ValueError, match="duplicate candidate pair S1-1::S2-1"):
        scored_batch(batch, records, DEMO, table(("S1-1", "S2-1")), split=split)
    for rows in ((("S1-0", "S2-0"), ("S1-1", "S3-1"), ("S1-0", "S2-0")), (("S1-0::S2-0", "S2-1"), ("S1-0", "S2-0::S2-1"))):
        with pytest.raises(InputError, match="duplicate (edge S1-0, S2-0|pair_id S1-0::S2-0::S2-1)"):
            scored_batch(table(*rows), records, DEMO, None, split=split)


def test_a_batch_writes_a_file_a_bucket(spark, tmp_path):
    from pairwright.streaming.scoring import score_stream

    records, source = shop_records(spark), tmp_path / "in"
    source.mkdir()
    for n in range(3):
        (source / f"{n}.json").write_text("".join(json.dumps({"source1_entity_id": "S1-0", "candidate_entity_id": f"S{s}-{n}", "source1_row_index": n, "candidate_rank": s}) + "\n" for s in (2, 3)))
    score_stream(spark, str(source), records, DEMO, str(tmp_path / "out"), str(tmp_path / "ck"), files_a_batch=3).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).select("batch", "pair_id").count() == 6
    assert len(list((tmp_path / "out-edges").rglob("*.parquet"))) == 1 and spark.read.parquet(str(tmp_path / "out-edges")).count() == 6

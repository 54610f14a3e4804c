"""The command line and the reports around scoring, on files."""

import json

import pytest

from pairwright import cli
from pairwright.functions.tfidf import TfIdf
from pairwright.plans import profile, views
from pairwright.plans.queries import DEMO
from pairwright.plans.training import PairModel
from pairwright.sources.records import COLUMNS


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    for s in (1, 2, 3):
        rows = [[f"S{s}-00{i}", "", "", "", f"shop {i}", "[]", f"{i} road", "[]", "", "1 2" if i == 1 else "3", "india"] for i in range(1, 5)]
        (folder / f"source{s}.tsv").write_text("\n".join("\t".join(r) for r in [COLUMNS, *rows]) + "\n")
    (folder / "candidates.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-001\tS2-001,S3-002,S2-003\nS1-002\t\nS1-003\tS2-003,S3-001\n")
    (folder / "truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-001\tS2-001\nS1-002\t[]\nS1-003\tS2-003\n")
    (folder / "split.json").write_text(json.dumps({"train_source1_entity_ids": ["S1-001", "S1-002"], "validation_source1_entity_ids": ["S1-003"]}))
    texts = spark.createDataFrame([("shop road",)], "t string")
    PairModel(TfIdf.fit(texts, "t"), TfIdf.fit(texts, "t"), DEMO).save(str(folder / "model"))
    return folder


def common(files):
    return [x for s in (1, 2, 3) for x in (f"--source{s}", str(files / f"source{s}.tsv"))] + ["--candidates", str(files / "candidates.tsv"), "--split", str(files / "split.json")]


def test_prepare(files, capsys):
    cli.main(["prepare", *common(files), "--truth", str(files / "truth.tsv"), "--dry-run", "--negative-ratio", "1"])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["total_pairs_written"] == 4 and report["prepared_candidates"]["train"]["dropped_negatives"] == 1


def test_score(spark, files, capsys):
    cli.main(["score", *common(files), "--model", str(files / "model"), "--out", str(files / "scores")])
    assert capsys.readouterr().out.strip().splitlines()[-1] == "5"
    rows = [json.loads(r.value) for r in spark.read.text(str(files / "scores")).collect()]
    assert [r["pair_id"] for r in rows] == ["S1-001::S2-001", "S1-001::S3-002", "S1-001::S2-003", "S1-003::S2-003", "S1-003::S3-001"]


def test_profile_and_pilot(spark, files):
    sf = "/root/testdata/sf0.001"
    pairs, records = views.pairs(spark, sf), views.records(spark, sf)
    assert set(profile.profile(pairs, records, DEMO)) >= {"candidates", "join", "record_features", "features", "score"}
    report = profile.pilot(views.lists(spark, sf), pairs, records, views.truth(spark, sf), PairModel.load(spark, str(files / "model")), str(files / "table"))
    assert report["failed_lookups"] == 0 and report["pairs"] == pairs.count() and report["coverage"]["total_source1_entities"] > 0
    assert spark.read.csv(str(files / "table"), sep="\t", header=True).count() == report["pairs"]


def test_pilot_and_profile_commands(spark, files, capsys):
    assert cli.main(["pilot", *common(files), "--truth", str(files / "truth.tsv"), "--model", str(files / "model"), "--report", str(files / "report")]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["pairs"] == 5 and report["failed_lookups"] == 0 and report["candidate_recall"]["recall"] == 1.0 and report["coverage"]["empty_entities"] == 1
    assert json.loads("\n".join(r.value for r in spark.read.text(str(files / "report")).collect()))["pairs"] == 5
    assert cli.main(["profile", *common(files), "--model", str(files / "model")]) == 0
    assert {"score", "own_score"} <= set(json.loads(capsys.readouterr().out.strip().splitlines()[-1]))
    with pytest.raises(SystemExit):
        cli.main(["score", *common(files), "--model", str(files / "model")])


def test_public_names():
    import pairwright

    assert all(getattr(pairwright, name) is not None for name in pairwright.__all__) and len(pairwright.__all__) > 40
    with pytest.raises(AttributeError):
        pairwright.nothing

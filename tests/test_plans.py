"""What moves: pairs lie by their entity, and where lists and targets are enough no exchange stands above the join that makes them."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from pairwright.operators import audits, sampling
from pairwright.plans import queries, scoring, views
from pairwright.sources.lines import numbered_lines


def plan(df) -> list[tuple[int, str]]:
    """(depth, operator) of the plan's nodes, in the order of explain."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [(len(line) - len(line.lstrip(" :+-")), line.lstrip(" :+-")) for line in text.splitlines()]


def moved(df) -> list[str]:
    """Exchanges of whole pairs: those above the join by group, but for sums that were taken in part before."""
    nodes, found = plan(df), []
    assert any(re.search(r"Join \[_group", node) for _, node in nodes)
    for i, (depth, node) in enumerate(nodes):
        if not node.startswith("Exchange") or "partial_" in nodes[i + 1][1] or re.match(r"HashAggregate\(keys=\[[^]]+\], functions=\[\]", nodes[i + 1][1]):
            continue
        below = []
        for d, n in nodes[i + 1 :]:
            if d <= depth:
                break
            below.append(n)
        if any(re.search(r"Join \[_group", n) for n in below) and not any("partial_" in n for n in below):
            found.append(node)
    return found


@pytest.mark.parametrize("name", ["assign_split", "brier_score", "duplicate_edges", "batch_summary", "candidate_order", "batches", "average_precision", "sample_exact", "sample_hash"])
def test_pairs_are_not_moved(spark, name):
    assert moved(queries.QUERIES[name](spark, SMALL)) == []


def test_later_occurrences_sort_once(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "a")], "n long, k string")
    found = audits.later_occurrences(rows, ["k"], ["n"])
    assert sorted(r.n for r in found.collect()) == [3, 4]
    assert not any("Join" in node for _, node in plan(found))


def test_a_summary_is_added_up_by_entity(spark):
    rows = spark.createDataFrame([("S1-1", "source2", 1, "train"), ("S1-1", "source2", None, "train"), ("S1-2", "source3", 0, None)], "source1_entity_id string, candidate_source string, label int, split string")
    summary = audits.batch_summary(rows)
    assert summary.first().asDict() == {"total_candidates": 3, "unique_source1_entities": 2, "candidate_sources": ["source2", "source3"], "labeled_count": 2, "unlabeled_count": 1, "train_count": 2, "validation_count": 0, "unassigned_count": 1}
    assert audits.batch_summary(rows.limit(0)).first().total_candidates == 0
    assert not any("collect_set" in node for _, node in plan(summary)[-4:])


def test_scores_are_made_once(spark):
    assert any(node.startswith("InMemoryTableScan") for _, node in plan(queries.QUERIES["average_precision"](spark, SMALL)))


def test_sides_other_than_training_keep_their_rules(spark):
    """Negatives of a run that no side has are drawn away, as before; validation stays."""
    rows = [(1, i, "S1-1", f"p{i}", 0, None) for i in range(4)] + [(2, 9 + i, "S1-2", f"q{i}", 0, "validation") for i in range(3)]
    pairs = spark.createDataFrame(rows, "run long, row_index long, source1_entity_id string, pair_id string, label int, split string")
    assert sorted(r.pair_id for r in sampling.sample_exact(pairs, 1, 1).collect()) == ["q0", "q1", "q2"]


def test_the_first_lines_are_taken_before_their_records(spark):
    nodes = [node for _, node in plan(queries.QUERIES["average_line_bytes"](spark, SMALL))]
    first = max(i for i, node in enumerate(nodes) if node.startswith("TakeOrdered"))
    assert any(re.search(r"Join \[.*source1_entity_id", node) for node in nodes[:first])


def test_scored_pairs_are_not_moved(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert moved(scoring.featurize(views.pairs(spark, SMALL), views.records(spark, SMALL))) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_members_are_those_of_the_pairs(spark):
    found = views.heads(spark, SMALL).filter("source1_row_index % 7 = 0")
    pairs = views.expand(found, spark, SMALL)
    want = {r[0] for r in pairs.select("source1_entity_id").union(pairs.select("candidate_entity_id")).distinct().collect()}
    assert sorted(r.entity_id for r in views.members(found, spark, SMALL).collect()) == sorted(want)


def test_scores_are_written_where_their_lists_lie(spark, tmp_path, monkeypatch):
    """Lists are dealt in order, workers hold the packs: no pair moves, and lines are in order in packed files."""
    monkeypatch.setattr(views, "SORTED_PAIRS_A_TASK", 20)
    records = views.records(spark, SMALL)
    assert scoring.stays(records)
    scores = scoring.score(views.pairs(spark, SMALL, ordered=True), records, queries.DEMO)
    assert moved(scores) == [] and scores.rdd.getNumPartitions() > 4
    n = scoring.write_scores(scores, tmp_path / "out", dealt=True, packed=True)
    assert n == scores.count() and list((tmp_path / "out").glob("*.txt.gz"))
    got = [(r.s.source1_row_index, r.s.candidate_rank) for r in numbered_lines(spark, tmp_path / "out").select("line_no", F.from_json("value", "source1_row_index long, candidate_rank long").alias("s")).orderBy("line_no").collect()]
    assert got == sorted(got) and len(set(got)) == n
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        scoring.write_scores(scores, tmp_path / "out", dealt=True)
    assert list((tmp_path / "out").glob("*.txt.gz"))
    with pytest.raises(Exception, match="Missing record join: S"):
        scoring.write_scores(scoring.score(views.pairs(spark, SMALL, ordered=True), records.filter("entity_id NOT LIKE '%7'"), queries.DEMO), tmp_path / "failed", dealt=True)
    assert not (tmp_path / "failed").exists()


def test_packs_beyond_what_workers_hold_come_with_their_pairs(spark, monkeypatch):
    pairs, records = views.pairs(spark, SMALL), views.records(spark, SMALL)
    held = scoring.score(pairs, records, queries.DEMO)
    monkeypatch.setattr(scoring, "MOST_PACKS", 1)
    assert not scoring.stays(records)
    assert sorted(held.collect()) == sorted(scoring.score(pairs, records, queries.DEMO).collect())


def test_kept_pairs_are_not_moved_to_become_lines(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert moved(queries.QUERIES["prepared_lines"](spark, SMALL)) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_labelled_lines_are_packed_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "shared_path", lambda _, label: str(tmp_path / label))
    rows = queries.QUERIES["labelled_file"](spark, SMALL).count()
    packed = list((tmp_path / "labelled").glob("*.txt.gz"))
    assert rows and packed and not list((tmp_path / "labelled").glob("*.txt"))


def test_order_is_numbered_from_sizes_of_lists(spark):
    """No window or sort of pairs: the only windows are over lists, below the join that makes pairs."""
    from pairwright.operators import candidates

    found = queries.QUERIES["candidate_order"](spark, SMALL)
    nodes = plan(found)
    first = next(i for i, (_, node) in enumerate(nodes) if re.search(r"Join \[_group", node))
    assert not any(re.match("Window|Sort", node) for _, node in nodes[:first])
    want = candidates.numbered(views.pairs(spark, SMALL)).select("pair_id", "seq")
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()


def test_lists_that_share_a_row_are_numbered_without_gaps(spark, tmp_path):
    for table in ("customer", "supplier", "part"):
        rows = spark.read.parquet(f"{SMALL}/{table}.parquet")
        (rows.unionByName(rows.filter("c_custkey < 9")) if table == "customer" else rows).write.parquet(f"{tmp_path}/{table}.parquet")
    seq = [r.seq for r in queries.QUERIES["candidate_order"](spark, str(tmp_path)).collect()]
    assert sorted(seq) == list(range(len(seq)))


def test_heads_of_files_are_not_counted_nor_shuffled(spark, tmp_path):
    spark.range(0, 40, 1, 4).selectExpr("cast(id as string) AS pair_id").sortWithinPartitions(F.col("pair_id").cast("int")).write.csv(str(tmp_path / "t"), header=True)
    found = numbered_lines(spark, tmp_path / "t", F.col("value") == "pair_id")
    assert not any(node.startswith("Window") for _, node in plan(found))
    assert [(r.filled_no, r.value) for r in found.filter("value <> 'pair_id'").orderBy("line_no").collect()] == [(i, str(i)) for i in range(40)]


def test_table_of_scores_is_written_where_its_lists_lie(spark):
    found = queries.QUERIES["score_table_file"](spark, SMALL)
    assert not any(node.startswith("Window") for _, node in plan(found))
    want = queries.QUERIES["score_pairs"](spark, SMALL).orderBy("source1_row_index", "candidate_rank").collect()
    assert [r.line.split("\t")[0] for r in found.orderBy("place").collect()] == [r.pair_id for r in want]


def test_inference_lines_are_made_in_order(spark, monkeypatch):
    asked = []
    kept = queries._written
    monkeypatch.setattr(queries, "_written", lambda spark, label, lines, *a, **b: asked.append((moved(lines), b.get("dealt"))) or kept(spark, label, lines, *a, **b))
    path = queries._inference_file(spark, SMALL)
    assert asked == [([], True)]
    want = [r.pair_id for r in views.pairs(spark, SMALL).orderBy("row_index").collect()]
    assert [r.p for r in numbered_lines(spark, path).orderBy("line_no").select(F.get_json_object("value", "$.pair_id").alias("p")).collect()] == want


def test_rows_are_read_once_for_checks_and_scores(spark, monkeypatch, tmp_path):
    """A broken row fails by the stored table, and pairs that workers can hold the packs of aren't moved to them."""
    from pairwright.functions.checks import InputError
    from pairwright.functions.tfidf import TfIdf
    from pairwright.plans import mapping, training
    from pairwright.sources.jsonl import read_jsonl

    def row(i, name="Acme"):
        one = {"name": name, "address": f"{i} Main", "postal_code": None, "country": "India", "postal_codes": None}
        return {"pair_id": f"p{i}", "source1_id": f"s{i}", "target_id": f"t{i}", "target_source": "S2", "source1": one, "target": one}

    import json

    texts = spark.createDataFrame([("Acme", "1 Main")], "name string, address string")
    model = training.PairModel(TfIdf.fit(texts, "name"), TfIdf.fit(texts, "address"), queries.DEMO)
    lines = [json.dumps(row(i)) for i in range(5)]
    scores = mapping.score_rows(read_jsonl(spark, lines), mapping.default_mapping(), model, str(tmp_path / "kept"))
    plain = mapping.score_rows(read_jsonl(spark, lines), mapping.default_mapping(), model)
    assert sorted(map(tuple, scores.collect())) == sorted(map(tuple, plain.collect())) and scores.count() == 5
    assert not any("variant" in node for _, node in plan(scores))
    assert not any(node.startswith("Exchange") for _, node in plan(scores) if "hashpartitioning(_left" in node or "hashpartitioning(_right" in node)
    with pytest.raises(InputError, match="Candidate row 1: "):
        mapping.score_rows(read_jsonl(spark, [lines[0], json.dumps(row(1) | {"target_source": "S9"}), json.dumps(row(2, 7))]), mapping.default_mapping(), model, str(tmp_path / "bad"))
    with pytest.raises(InputError, match="line 2: expected a JSON object"):
        mapping.predict_file(spark, [json.dumps({"pair_id": "p"}), " [1]"], mapping.default_mapping(), model, str(tmp_path / "none"))
    assert mapping.predict_file(spark, [lines[0], "", "\t" + lines[1]], mapping.default_mapping(), model, str(tmp_path / "some")) == 2

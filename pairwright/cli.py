"""Command line: train, predict, prepare, score, pilot, profile."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pairwright", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    t = sub.add_parser("train", help="labelled pairs to a model directory")
    t.add_argument("--pairs", help="JSON lines; synthetic pairs without it")
    t.add_argument("--split", help="saved split, .json or delimited")
    t.add_argument("--out", required=True)
    p = sub.add_parser("predict", help="JSON lines of any shape to scores")
    for name in ("input", "mapping", "model", "out"):
        p.add_argument(f"--{name}", required=True)
    for command, text in (("prepare", "candidates to training data"), ("score", "candidates to scores"), ("pilot", "score candidates and report coverage, recall and speed"), ("profile", "seconds of each stage of a scoring run")):
        s = sub.add_parser(command, help=text)
        for name in ("candidates", "source1", "source2", "source3", "split"):
            s.add_argument(f"--{name}", required=True)
        s.add_argument("--out", required=command == "score")
    prepare = sub.choices["prepare"]
    for command in ("prepare", "pilot"):
        sub.choices[command].add_argument("--truth", required=True)
    sub.choices["pilot"].add_argument("--report", help="a new file for the report, as JSON")
    prepare.add_argument("--negative-ratio", type=int, default=10)
    prepare.add_argument("--max-zero-match-negatives", type=int, default=10)
    prepare.add_argument("--seed", type=int, default=42)
    for flag in ("--dry-run", "--overwrite", "--collection-aware"):
        prepare.add_argument(flag, action="store_true")
    for command in ("score", "pilot", "profile"):
        sub.choices[command].add_argument("--model", required=True)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("pairwright").getOrCreate()
    from .operators.records import all_records
    from .plans.training import PairModel
    from .sources.records import read_source
    from .sources.truth import read_split, read_truth

    if args.command == "train":
        from .plans.training import synthetic_pairs, train_classifier
        from .sources.jsonl import read_pairs

        pairs = read_pairs(spark, args.pairs) if args.pairs else synthetic_pairs(spark)
        result = train_classifier(pairs, data_kind="real" if args.pairs else "synthetic", saved_split=read_split(spark, args.split) if args.split else None)
        result.save(args.out)
        print(json.dumps(result.report["validation_metrics"]))
        return 0
    if args.command == "predict":
        from .plans.mapping import InputMapping, predict_file

        print(predict_file(spark, args.input, InputMapping.load(args.mapping), PairModel.load(spark, args.model), args.out))
        return 0
    records = all_records(*[read_source(spark, getattr(args, f"source{i}")) for i in (1, 2, 3)])
    split = read_split(spark, args.split)
    if args.command == "prepare":
        from .plans.preparation import prepare_training_data

        report = prepare_training_data(spark, args.candidates, records, split, read_truth(spark, args.truth), args.out, args.negative_ratio, args.max_zero_match_negatives, args.seed, collection_aware=args.collection_aware, dry_run=args.dry_run, overwrite=args.overwrite)
        print(json.dumps(report))
        return 0
    from .plans.scoring import score_file

    if args.command in ("pilot", "profile"):
        return reports(spark, args, records, split)
    model = PairModel.load(spark, args.model)
    print(score_file(spark, args.candidates, records, split, model.ensemble, args.out, model.name, model.address))
    return 0


def reports(spark: SparkSession, args: argparse.Namespace, records, split) -> int:
    """The pilot's report or the stages' seconds, printed as JSON; scores go to --out, if it is given."""
    from .operators.candidates import with_row_index
    from .operators.joins import join_candidates
    from .plans import profile
    from .plans.training import PairModel
    from .sources.candidates import CandidateFile
    from .sources.truth import read_truth

    found, model = CandidateFile.read(spark, args.candidates), PairModel.load(spark, args.model)
    found.check()
    pairs = with_row_index(found.pairs().drop("line_no"))
    if args.command == "profile":
        report = profile.profile(pairs, records, model.ensemble, model.name, model.address)
    else:
        truth = read_truth(spark, args.truth)
        join_candidates(pairs, records, split, truth, require_labels=True)
        report = profile.pilot(found.rows, pairs, records, truth, model, args.out)
        if args.report:
            spark.createDataFrame([(json.dumps(report, indent=1),)], "value string").coalesce(1).write.mode("errorifexists").text(args.report)
    print(json.dumps(report))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

"""A PySpark-native engine for record matching and for preparing training corpora.

The names below are the engine's public ones; each is loaded when it is first asked for.
"""

from __future__ import annotations

from importlib import import_module

#: Public name -> (module, name there).
PUBLIC = {
    "SOURCES": ("operators.records", "SOURCES"), "SOURCE_PREFIXES": ("sources.candidates", "SOURCE_PREFIXES"), "VALID_CANDIDATE_SOURCES": ("sources.candidates", "VALID_CANDIDATE_SOURCES"),
    "REQUIRED_CANDIDATE_FIELDS": ("sources.candidates", "REQUIRED_CANDIDATE_FIELDS"), "VALIDATED_OPTIONAL_FIELDS": ("sources.candidates", "VALIDATED_OPTIONAL_FIELDS"), "FEATURE_NAMES": ("functions.features", "FEATURE_NAMES"),
    "adapt_record": ("operators.records", "adapt_records"), "read_source": ("sources.records", "read_source"), "all_records": ("operators.records", "all_records"), "inference_mapping": ("plans.mapping", "default_mapping"), "InputMapping": ("plans.mapping", "InputMapping"),
    "join_candidates": ("operators.joins", "join_candidates"), "partition_candidates": ("operators.joins", "partition_candidates"), "load_ground_truth_tsv": ("sources.truth", "read_truth"), "parse_ground_truth_matches": ("sources.truth", "matches"),
    "load_saved_split": ("sources.truth", "read_split"), "load_split_dict": ("sources.truth", "read_split"), "CandidateFile": ("sources.candidates", "CandidateFile"), "parse_member2_tsv": ("sources.candidates", "read_candidates"), "read_member2_tsv": ("sources.candidates", "read_candidates"),
    "generate_pair_id": ("sources.candidates", "pair_id"), "enrich_candidates": ("operators.candidates", "enrich"), "enrich_candidate_batch": ("operators.candidates", "enrich"), "validate_candidate_batch": ("operators.candidates", "validate"), "candidate_batch_summary": ("operators.audits", "batch_summary"),
    "source1_coverage": ("operators.audits", "coverage"), "sample_training_candidates": ("operators.sampling", "sample_exact"), "sampling_summary": ("operators.sampling", "sampling_summary"), "split_pairs": ("operators.splits", "group_split"),
    "estimate_model_fitting_memory": ("plans.preparation", "estimate_memory"), "prepare_training_data": ("plans.preparation", "prepare_training_data"), "read_jsonl": ("sources.jsonl", "read_jsonl"), "read_pairs": ("sources.jsonl", "read_pairs"),
    "TrainingConfig": ("plans.training", "TrainingConfig"), "PairwiseModel": ("plans.training", "PairModel"), "train_classifier": ("plans.training", "train_classifier"), "synthetic_pairs": ("plans.training", "synthetic_pairs"), "evaluate_probabilities": ("operators.metrics", "evaluate"),
    "predict_file": ("plans.mapping", "predict_file"), "score_file": ("plans.scoring", "score_file"), "score_candidates": ("plans.scoring", "score"), "score_stream": ("streaming.scoring", "score_stream"), "stream_joined_batches": ("streaming.scoring", "joined_batch"),
    "normalize_postal_code": ("functions.postal", "normal_code"), "normalize_postal_code_collection": ("functions.postal", "code_set"), "record_postal_codes": ("functions.postal", "record_codes"),
}
__all__ = sorted(PUBLIC)


def __getattr__(name: str):
    if name not in PUBLIC:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    module, there = PUBLIC[name]
    return getattr(import_module(f".{module}", __name__), there)


def __dir__() -> list[str]:
    return __all__

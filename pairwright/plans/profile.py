"""Wall time by stage of a scoring run; each stage is forced by writing its rows nowhere."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame

from ..functions.features import record_features
from ..operators.joins import join_records
from .ensemble import Ensemble
from .scoring import featurize, score


def run(df: DataFrame) -> float:
    began = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def profile(pairs: DataFrame, records: DataFrame, ensemble: Ensemble, name=None, address=None) -> dict[str, float]:
    """Seconds of reading, joining, preparing records, features, and scoring; later stages include earlier ones.

    "own_" has what a stage takes beyond those that it includes.
    """
    found = {
        "candidates": run(pairs),
        "join": run(join_records(pairs, records)),
        "record_features": run(record_features(records, True)),
        "features": run(featurize(pairs, records, name, address, True)),
        "score": run(score(pairs, records, ensemble, name, address)),
    }
    before = {"join": ("candidates",), "features": ("join", "record_features"), "score": ("features",)}
    return found | {f"own_{k}": max(0.0, found[k] - sum(found[b] for b in parts)) for k, parts in before.items()}


def pilot(candidates_lists: DataFrame, pairs: DataFrame, records: DataFrame, truth: DataFrame, model, out: str | None = None) -> dict:
    """Audit and performance of one scoring run: entities, pairs, recall of the candidates, lookups that failed, pairs a second.

    With `out` the scores are written as tab-separated text within the timed region.
    """
    from ..operators.audits import coverage, coverage_totals, recall
    from ..operators.joins import join_violations
    from ..sources.truth import truth_edges
    from .scoring import write_score_table

    totals = coverage_totals(coverage(candidates_lists)).first().asDict()
    failed = join_violations(join_records(pairs, records)).count()
    began = time.perf_counter()
    scores = score(pairs, records, model.ensemble, model.name, model.address)
    if out is None:
        run(scores)
    else:
        write_score_table(scores, out)
    seconds = time.perf_counter() - began
    n = pairs.count()
    return {"coverage": totals, "candidate_recall": recall(truth_edges(truth), pairs).first().asDict(), "failed_lookups": failed, "pairs": n, "seconds": round(seconds, 3), "pairs_per_second": round(n / seconds, 1)}

"""Queries of the corpus operators and, where SQL can express them, the same rows in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import OP1_SQL, op1_chat_format
from .decontam import op9_decontaminate
from .html_text import op3_html_text
from .jaccard import op5_ngram_jaccard
from .licenses import op6_license_scan
from .media import op8_media_columns
from .mixing import OP7_SQL, op7_mix_sources
from .quality import op4_quality
from .shards import op10_kd_shards
from .tokens import op2_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_token_counts": op2_token_counts,
    "op3_html_text": op3_html_text,
    "op4_quality": op4_quality,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_license_scan": op6_license_scan,
    "op7_mix_sources": op7_mix_sources,
    "op8_media_columns": op8_media_columns,
    "op9_decontaminate": op9_decontaminate,
    "op10_kd_shards": op10_kd_shards,
}

ORACLES: dict[str, str] = {
    "op1_chat_format": OP1_SQL,
    "op7_mix_sources": OP7_SQL,
}

"""All queries of the subpackage, with the SQL of those that SQL can express."""

from __future__ import annotations

from tomeworks.llm import (  # noqa: F401
    attention_lm,
    bpe,
    centroids,
    chunk_dedup,
    decontaminate,
    divergence,
    language_id,
    line_dedup,
    near_dup,
    quality_rules,
    secret_scan,
    sentence_pieces,
    shards,
)
from tomeworks.llm.common import QUERIES

ORACLES: dict[str, str] = {
    "op11_centroids": centroids.SQL,
    "op12_source_divergence": divergence.SQL,
}

__all__ = ["ORACLES", "QUERIES"]

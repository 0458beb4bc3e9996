"""Queries of this subpackage: one for each operator, and the pipeline."""

from __future__ import annotations

import corpus_pipeline
from tidemark.llm import bpe, cotraining, language, mixing, nearest, neardup, pages, repeats, rules, toxicity

QUERIES = {
    "op1_rules": rules.query,
    "op2_language": language.query,
    "op3_repeats": repeats.query,
    "op4_neardup": neardup.query,
    "op5_toxicity": toxicity.query,
    "op6_cotraining": cotraining.query,
    "op7_nearest": nearest.query,
    "op8_mixing": mixing.query,
    "op9_bpe": bpe.query,
    "op10_pages": pages.query,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {"op8_mixing": mixing.SQL}

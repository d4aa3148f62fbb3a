"""The queries of the corpus operators by name, next to their SQL where there is one."""

from __future__ import annotations

import corpus_pipeline
from txnlens.llm import (
    compression,
    exact_dedup,
    layout,
    merkle,
    mixing,
    near_dedup,
    pieces,
    ranked,
    secrets,
    sharding,
    suffix_tree,
    toxicity,
    vantage,
)

MODULES = (suffix_tree, vantage, toxicity, exact_dedup, secrets, near_dedup, layout, sharding, pieces, mixing, ranked, compression, merkle)


def entries() -> dict:
    found = {name: entry for module in MODULES for name, entry in module.ENTRIES.items()}
    return {**found, "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)}

"""All registered queries of the subpackage."""

from __future__ import annotations

from newsloom.llm import (  # noqa: F401
    centroids,
    chat,
    decision_list,
    fingerprints,
    html_main,
    jaccard_join,
    language,
    mixing,
    packing,
    quality,
    token_files,
    toxicity,
    whitening,
)
from newsloom.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

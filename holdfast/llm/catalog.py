"""Imports every module of this subpackage that registers a query."""

from __future__ import annotations

import corpus_pipeline  # noqa: F401
from holdfast.llm import chat, decontaminate, language, lexical, spelling, licenses, mixing, packing, quality, sharding, simhash, substrings, topk  # noqa: F401
from holdfast.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""The queries of this subpackage and their SQL, gathered from its modules."""

from __future__ import annotations

from packetloom.llm import (
    chat, decontaminate, divergence, language, lines, merkle, ngram_join, pieces, quality, substrings, suffixes, tokenfiles, toxicity)

MODULES = (chat, lines, language, suffixes, tokenfiles, toxicity, quality, pieces, ngram_join, decontaminate,
           substrings, merkle, divergence)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
SQL = {name: q for m in MODULES for name, q in m.SQL.items()}

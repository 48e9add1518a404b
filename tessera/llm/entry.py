"""Queries of the training-data operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from tessera.llm import bloomlm, huffman, langid, matroska, mixing, packing, quality, search, simhash, warc

_MODULES = (langid, packing, mixing, search, quality, warc, matroska, bloomlm, simhash, huffman)


def queries() -> dict:
    return {name: q for m in _MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}

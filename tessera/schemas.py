"""Explicit schemas of files that are read; nothing is inferred."""

CHUNKS = "chunk_id string, domain string, source_kind string, file string, line_start int, line_end int, text string"
VECTORS = "chunk_id string, model string, embedding array<float>"
GOLD = "qid string, question string, type string, expect array<string>"
MANIFEST = "name string, url string, sha string"

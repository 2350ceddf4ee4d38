"""Operators of a training-data pipeline (packing, near-duplicates, quality
rules, token counts, language ID, URL filters, mixing, LM scoring, WARC,
conversation repair, centroid clustering, byte-level BPE).

Nothing outside this subpackage imports it; ``queries`` registers one thin
query per operator and ``oracles`` the DuckDB SQL where SQL can express it.
"""

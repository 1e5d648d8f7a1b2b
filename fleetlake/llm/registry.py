"""The registered queries of this subpackage and their DuckDB forms."""

from __future__ import annotations

import importlib

# query name -> module that defines it (with ORACLE_SQL where SQL can express it)
QUERIES = {
    "op1_toxicity": "op1_toxicity",
    "op2_warc": "op2_warc",
    "op3_license": "op3_license",
    "op4_bpe": "op4_bpe",
    "op5_order_minhash": "op5_order_minhash",
    "op6_packing": "op6_packing",
    "op7_language": "op7_language",
    "op8_line_dedup": "op8_line_dedup",
    "op9_quality": "op9_quality",
    "op10_fingerprint": "op10_fingerprint",
    "op11_divergence": "op11_divergence",
    "op12_sharding": "op12_sharding",
    "op13_centroids": "op13_centroids",
}


def _module(name: str):
    return importlib.import_module(f"fleetlake.llm.{name}")


def queries() -> dict:
    return {name: getattr(_module(mod), name) for name, mod in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(_module(mod), "ORACLE_SQL", None) for name, mod in QUERIES.items()}
    return {name: sql for name, sql in found.items() if sql}

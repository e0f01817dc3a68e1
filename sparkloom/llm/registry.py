"""The corpus queries and the SQL of those that SQL can express."""

from __future__ import annotations

from sparkloom.llm import (importance, language, lexical, licenses, manifest, mixing, near_dedup, neighbours, packing, quality_rules,
                           repeats, secrets, token_file)

MODULES = (mixing, token_file, packing, secrets, importance, near_dedup, licenses, repeats, quality_rules, neighbours,
           language, lexical, manifest)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}

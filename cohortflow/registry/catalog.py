"""All named queries."""

from __future__ import annotations

from cohortflow.registry import gold_queries, growth_queries, learning_queries, profile_queries, rule_queries, semantic_queries, source_queries

_ALL = {}
for _module in (gold_queries, profile_queries, semantic_queries, rule_queries, source_queries, learning_queries, growth_queries):
    _ALL.update(_module.QUERIES)

QUERIES = {name: run for name, (run, _) in _ALL.items()}
ORACLES = {name: sql for name, (_, sql) in _ALL.items() if sql}

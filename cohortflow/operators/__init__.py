"""Relational operators: reports, joins, latest rows, quality rules, profiling."""

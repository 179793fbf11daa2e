"""Shared building blocks of physical strategy: lineage cuts, size checks, ordered totals."""

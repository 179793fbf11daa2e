"""Column expressions: scalars, rule scores."""

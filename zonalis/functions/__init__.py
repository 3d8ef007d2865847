"""Column expressions: scalar projections and predicates."""

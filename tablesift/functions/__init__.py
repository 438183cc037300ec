"""Column expressions: kinds, predicates, languages."""

"""Column expressions: cleaning, layouts, predicates, order keys, token arrays."""

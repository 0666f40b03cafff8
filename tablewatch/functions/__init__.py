"""Column expressions: names, predicates, status labels, bands and text."""

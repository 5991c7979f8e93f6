"""Column builders: attribute lookups, predicates, literals, JSON values, quantiles."""
